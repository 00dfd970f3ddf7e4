"""HTML extraction: parsing, exact marginals, held-out layouts, every kind of row."""

import itertools

import numpy as np
import pytest

from retailflow.llm import html_extract as he


@pytest.fixture(scope="module")
def model():
    return he.TreeModel(he.built_pages())


def texts(page):
    return [" ".join("".join(p).split()) for n in he.parse(page) for _, p in n.runs]


def test_parse_blocks():
    assert texts("<p>a <b>b</b>&amp;c<p>d<br>e</p>f") == ["f", "a b&c", "d e"]
    assert texts('<script>var t="</p>";</script><p>x</p><!-- <p>no</p> -->') == ["x"]
    assert texts("<ul><li>one<li>two<ul><li>in</ul></ul>") == ["one", "two", "in"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<p>5 &lt; 6 & 7 < 8") == ["5 < 6 & 7 < 8"]
    assert texts("<div>a<p>b</p>c</div>") == ["a", "c", "b"]
    assert texts("<title>t</title><style>p{}</style>") == []
    assert texts("<p title='a>b'>x<span class=\"q\">y</span>") == ["xy"]
    assert texts("") == [] and texts("plain") == ["plain"] and texts("<div") == []


def test_marginals_equal_enumeration(model):
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        parent = np.array([-1] + [int(rng.integers(0, i)) if rng.random() < 0.9 else -1 for i in range(1, n)])
        kinds = rng.integers(0, len(he.EDGES), n)
        own = rng.normal(size=(n, 2)) * 2
        total, on = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            log = sum(own[i, y] for i, y in enumerate(labels))
            log += sum(model.edges[kinds[i], labels[parent[i]], labels[i]] for i in range(n) if parent[i] >= 0)
            total += np.exp(log)
            on += np.exp(log) * np.array(labels)
        assert np.allclose(model.sum_product(parent, kinds, own), on / total)


def test_unseen_pages(model):
    wrong = seen = 0
    for page in he.built_pages(150, seed=77):
        nodes = he.parse(page)
        he.spread_labels(nodes)
        for node, content in zip(nodes, model.marginals([nodes])[0]):
            if node.chars:
                seen += 1
                wrong += (content > 0.5) != node.label
    assert wrong <= 0.01 * seen


def test_given_pages(spark):
    import html as entities
    import re

    from retailflow.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in queries.op3_html_extraction(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside)
        lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        want = "\n".join(x for x in lines if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_rows_of_every_kind(spark, model):
    article = "<nav><a href='/'>Home</a></nav><article><h1>T</h1><p>Some words &eacute; here.</p></article>"
    long = "<article>" + "<p>More than a few words stand here.</p>" * 20000 + "</article>"
    deep = "<div>" * 3000 + "<p>Some words are here.</p>"
    rows = [(1, "u", None, 5), (2, None, "", 5), (3, "u", article, 5), (3, "u", article, 5), (None, "u", long, 5), (4, "u", deep, 5), (5, "u", "<p>" * 50, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = he.extract(pages, model).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == by_id[5] == ""
    assert by_id[3] == "T\nSome words é here."
    assert by_id[None] == "\n".join(["More than a few words stand here."] * 20000)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    empty = pages.limit(0)
    assert he.extract(empty, he.train(empty)).count() == 0


ASIDE = [
    '<svg width="1" height="1"/>', "<template/>", '<iframe src="x">', '<object data="x">', "<canvas>", "<video src=x>",
    "<select><option>a</option>", "<noscript>", "<math/>", "<audio controls>", "<svg><title>t</title></svg>",
    "<canvas>none</canvas>", "<template><p>x</p><template>y</template></template>", "<svg><svg/><g/></svg>",
]


@pytest.mark.parametrize("element", ASIDE)
def test_no_text_is_lost_after_an_element_without_end(element):
    page = f"<html><body><article><p>one two</p>{element}<p>three four</p></article><p>five</p></body></html>"
    texts = ["".join(t for _, run in n.runs for t in run) for n in he.parse(page)]
    kept = [t.strip() for t in texts if t.strip()]
    assert [t for t in kept if t != "a"] == ["one two", "three four", "five"]


def test_an_end_tag_beyond_the_parent_or_of_another_does_not_count():
    page = "<article><p>one</p><video src=a><p>two</p></article><p>three</p><video>no</video><p>four</p>"
    texts = ["".join(t for _, run in n.runs for t in run) for n in he.parse(page)]
    assert [t for t in texts if t] == ["one", "two", "three", "four"]
    page = "<div>a<select><option>x</option></select>b<iframe>c<p>d</p><iframe>no</iframe>e</div>"
    kept = [t for n in he.parse(page) for _, run in n.runs for t in run]
    assert "x" not in "".join(kept) and "no" not in "".join(kept) and {"c", "d", "e"} <= set("".join(kept))
