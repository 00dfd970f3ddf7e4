"""Training samples: a repeated id sends one text to the driver."""

from retailflow.llm import common, html_extract


def collected(monkeypatch, df):
    """Lengths of what ``collect`` returns from now on."""
    sizes, run = [], type(df).collect

    def noted(self):
        rows = run(self)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(df), "collect", noted)
    return sizes


def test_repeated_documents(spark, monkeypatch):
    rows = [(1, f"text {n:03}") for n in range(200)] + [(2, "other"), (2, None), (3, "not chosen"), (None, "lost")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = collected(monkeypatch, docs)
    assert sorted(common.texts_of(docs, [(1, 0), (2, 1)], "int")) == [("other", 1), ("text 000", 0)]
    assert sizes == [2]


def test_repeated_pages(spark, monkeypatch):
    html = "<html><body><article><p>words of page {}</p></article></body></html>"
    pages = spark.createDataFrame([(1, html.format(n)) for n in range(200)], "page_id long, html string")
    sizes = collected(monkeypatch, pages)
    monkeypatch.setattr(html_extract, "TreeModel", len)
    assert html_extract.train(pages) == len(html_extract.built_pages()) + 1
    assert max(sizes) == 1
