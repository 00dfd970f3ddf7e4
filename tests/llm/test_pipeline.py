"""The pipeline's stages against plain versions on the small table."""

import corpus_pipeline
import public_tokenizers
from retailflow.llm import quality, toxicity
from tests.llm.brute import smallest_reachable
from tests.llm.test_simhash import brute_print

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    model = toxicity.train(docs, labels)
    rows = docs.collect()
    want = [r for r, s in zip(rows, model.scores([r["text"] for r in rows])) if s < 0.7]
    docs = stages["toxicity"](spark, docs, SF_DIR)
    assert sorted(docs.collect()) == sorted(want) and len(want) < len(rows)

    model = quality.train(docs, labels)
    want = [r for r, s in zip(want, model.scores([r["text"] for r in want])) if s >= 0.3]
    docs = stages["quality"](spark, docs, SF_DIR)
    assert sorted(docs.collect()) == sorted(want)

    prints = {r["doc_id"]: brute_print(r["text"]) for r in want}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = smallest_reachable(prints, links)
    want = [r for r in want if roots[r["doc_id"]] == r["doc_id"]]
    docs = stages["simhash_near_dedup"](spark, docs, SF_DIR)
    assert sorted(docs.collect()) == sorted(want) and links

    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in want}
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_extra_columns_nulls_and_empty_tables(spark):
    rows = [
        (1, "the cat sat here", "en", "a", 9, 0.5, "x"),
        (1, "the cat sat here", "en", "a", 9, 0.5, "x"),
        (None, None, None, None, None, None, None),
        (2, "", "en", "a", 0, 0.1, "y"),
        (3, "you idiot", "en", "b", 9, 0.1, "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, fp string")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF_DIR)
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, table, SF_DIR).columns[0] == "doc_id"
    toxic_gone = corpus_pipeline.remove_toxic(spark, docs, SF_DIR).collect()
    assert len(toxic_gone) == 4
    kept = corpus_pipeline.remove_near_copies(spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(1, "the cat sat here"), (2, ""), (3, "you idiot")]


def test_tokenizer_is_not_copied():
    assert public_tokenizers.path("word_bpe_49k.json").startswith("/opt")
