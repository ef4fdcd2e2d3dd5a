"""The pipeline's stages, one after another, against plain versions; odd rows and columns; an empty table."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerspark.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from ledgerspark.llm.common import ARROW_ROWS, MOST_ROWS, documents, drop_table, fresh, materialize
from ledgerspark.session import table
from tests.conftest import SF_SMALL
from tests.llm import brute

CLASHES = {"fp": "long", "kept": "string", "n": "int", "_row": "string", "_tie": "int", "_size": "int", "_copies": "int", "copies": "int", "_k0": "string", "_k1": "int", "_tied": "int", "_lang": "string", "did": "int",
           "rows": "int", "least": "string", "tied": "int", "A b": "int", "size": "int", "row": "int"}
BASE = "doc_id long, text string, lang string, source string"


def odd_documents(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "en", "a"), (2, words, "en", "a"), (2, words, "en", "a"), (3, words + " tail", "en", "b"), (None, words + " tail", None, None), (4, None, None, "b"), (5, "", "de", None),
            (None, None, None, None), (6, "x " * 30000, "fr", "a"), (7, "other words entirely here now", "en", "c")]
    schema = BASE + ", " + ", ".join(f"`{c}` {t}" for c, t in CLASHES.items()) + ", facts map<string,int>, deep array<struct<m: map<int,string>>>"
    more = tuple(None if i % 4 == 3 else (str(i) if t == "string" else i) for i, t in enumerate(CLASHES.values()))
    return spark.createDataFrame([(*r, *more, {"k": i % 2}, [({i % 2: "v"},)]) for i, r in enumerate(rows)], schema)


def key(rows):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows)


def test_stages_keep_odd_columns_and_rows(spark):
    docs = odd_documents(spark)
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    every = key(docs.collect())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema and key(kept.collect()) == every
    once = exact_dedup.drop_exact_copies(docs)
    assert once.columns == docs.columns
    texts = Counter((r["text"] or "") for r in once.collect())
    assert set(texts) == {(t or "") for _, t, _, _ in every} and set(texts.values()) == {1}
    near = jaccard_join.one_of_each_class(docs)
    assert near.columns == docs.columns and sum((r["text"] or "").startswith("w0 ") for r in near.collect()) == 1
    mixed = mixing.emit(docs)
    assert mixed.columns == docs.columns
    drawn = Counter()
    for r in mixing.mix(docs).collect():
        drawn[r.doc_id, r.source, r.size] += r.copies
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    assert Counter((r.doc_id, r.source, r.s) for r in mixed.select("doc_id", "source", size.alias("s")).collect()) == +drawn


def test_helper_columns_never_clash(spark):
    assert fresh(spark.createDataFrame([], "_K0 int, `_k0_` int, x int"), "_k0", "_k0", "y") == ["_k0__", "_k0___", "y"]


def test_an_empty_table_runs_through(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "empty")
        assert docs.count() == 0


def test_every_stage_against_a_plain_version(spark):
    docs = documents(spark, SF_SMALL)
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    rows = docs.collect()

    after = materialize(stages["toxicity"](spark, docs, SF_SMALL), "t")
    model = toxicity.train(docs, table(spark, SF_SMALL, "labels"), holdout=None)
    rejected = {r.doc_id for r in toxicity.score(docs, model).collect() if r.rejected}
    rows = [r for r in rows if r.doc_id not in rejected]
    assert after.columns == columns and key(after.collect()) == key(rows)

    docs, after = after, materialize(stages["exact_dedup"](spark, after, SF_SMALL), "e")
    last = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        last[r.text or ""] = r
    rows = list(last.values())
    assert after.columns == columns and key(after.collect()) == key(rows)

    docs, after = after, materialize(stages["ngram_jaccard_join"](spark, after, SF_SMALL), "j")
    classes = brute.classes([(r.doc_id, r.text) for r in rows], 5, 80)
    rows = [r for r in rows if classes[r.doc_id][0] == 0 or classes[r.doc_id][1] == r.doc_id]
    assert after.columns == columns and key(after.collect()) == key(rows)

    docs, after = after, materialize(stages["mixing"](spark, after, SF_SMALL), "m")
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    got = Counter(r.doc_id for r in after.collect())
    assert after.columns == columns and got == +Counter(copies) and set(copies) == {r.doc_id for r in rows}
    words = Counter()
    for r in rows:
        words[r.source] += got[r.doc_id] * len(brute.WORD.findall(r.text or ""))
    for r in mixing.mix(docs).select("source", "target").distinct().collect():
        assert abs(words[r.source] - r.target) <= max(len(brute.WORD.findall(x.text or "")) for x in rows if x.source == r.source)

    from ledgerspark.llm.catalog import tokenizer
    want = brute.bpe_rows([(r.doc_id, r.text) for r in rows if got[r.doc_id]], tokenizer("word_bpe_49k.json"))
    out = stages["bpe"](spark, after, SF_SMALL).collect()
    assert Counter(r.doc_id for r in out) == got
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in out)
    run = Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert run == Counter((r.doc_id, r.ids_sha256) for r in out)


def test_dropped_tables_are_gone(spark):
    df = materialize(spark.range(3), "gone")
    assert df.count() == 3
    drop_table(df)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        spark.read.parquet(*{f.rsplit("/", 1)[0] for f in df.inputFiles()}).count()


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """F1 of round 3: batches of Spark's 10,000 rows were held by executors while shingles were counted and stages' results written."""
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "a"), (2, None, None, None)], BASE)
    seen, collect = [], type(docs).collect

    def noted(df):
        seen.append(int(spark.conf.get(ARROW_ROWS)))
        return collect(df)

    monkeypatch.setattr(type(docs), "collect", noted)
    before = spark.conf.get(ARROW_ROWS)
    try:
        spark.conf.set(ARROW_ROWS, "10000")
        jaccard_join._levels(docs, 4, 10)
        assert seen == [MOST_ROWS] and spark.conf.get(ARROW_ROWS) == "10000"
        for name in ("toxicity", "bpe"):  # these run when the caller writes them
            spark.conf.set(ARROW_ROWS, "10000")
            dict(corpus_pipeline.STAGES)[name](spark, docs, SF_SMALL)
            assert int(spark.conf.get(ARROW_ROWS)) == MOST_ROWS
        spark.conf.set(ARROW_ROWS, "70")
        dict(corpus_pipeline.STAGES)["bpe"](spark, docs, SF_SMALL)
        assert spark.conf.get(ARROW_ROWS) == "70"
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_what_a_worker_keeps_of_bpe_is_small():
    """F1 of round 3: workers of the encoder go on into the next stages with their memos."""
    per_entry = 150  # bytes at least: a short string, its ids, their place in a dict
    assert 2 * per_entry * (bpe.WORDS + bpe.PIECES) < 100e6
