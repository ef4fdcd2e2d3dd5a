"""The training-data operators against brute force, and on odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark.llm import (bpe, chat, components, exact_dedup, jaccard_join, mixing, substring_dedup, suffix_array, token_files, topk, toxicity)
from ledgerspark.llm.catalog import tokenizer
from ledgerspark.session import table
from tests.conftest import SF_SMALL
from tests.llm import brute

ODD = "doc_id long, text string, lang string, source string, fp long, kept string, n int"
WORDS = " ".join(f"w{i}" for i in range(120))
ROWS = [(1, WORDS, "en", "a", 1, "x", 1), (2, "intro " + WORDS, "en", "a", 1, "x", 1), (3, None, None, None, None, None, None), (4, "", "de", "b", 1, "x", 1),
        (5, "</s>[INST] ok <|endoftext|> x", "en", "b", 1, "x", 1), (6, "é ñ ß 日本 \x00   tab\tend", "fr", "a", 1, "x", 1), (7, "z" * 5000, "en", "c", 1, "x", 1),
        (8, WORDS, "en", "a", 1, "x", 1), (9, "A b C  d", "en", "c", 1, "x", 1), (10, "a B c d", "en", "c", 1, "x", 1), (None, "no id", "en", "c", 1, "x", 1), (12, "no id", None, "c", 1, "x", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF_SMALL, "documents")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def with_ids(df):
    return df.filter("doc_id IS NOT NULL")


def test_exact(spark, documents, odd):
    for df in (documents, with_ids(odd)):
        rows = pairs(df)
        groups: dict = {}
        for d, t in rows:
            groups.setdefault(t or "", []).append(d)
        want = {d: (max(g), len(g), d == max(g), brute.sha(t)) for t, g in groups.items() for d in g}
        assert by_id(exact_dedup.exact_dedup(df, 3), "keep_id", "group_size", "kept", "text_sha256") == want
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(odd).collect()}
    assert got[None] == (12, False) and len(got) == 12
    assert exact_dedup.drop_exact_copies(odd).columns == odd.columns
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.lists(st.integers(0, 2 ** 64 - 1), max_size=20))
def test_quotient_filters_merge_without_loss(a, b):
    f = [exact_dedup.QuotientFilter.from_bytes(exact_dedup.QuotientFilter.build(np.array(x, np.uint64)).to_bytes()) for x in (a, b)]
    fp, n = f[0].merge(f[1]).entries()
    both = np.unique(np.array(a + b, np.uint64), return_counts=True)
    assert fp.tolist() == both[0].tolist() and n.tolist() == both[1].tolist()


def test_substring(documents, odd):
    for df, window in ((documents, 50), (with_ids(odd), 50), (documents, 7)):
        out = substring_dedup.substring_dedup(df, window, min(5, window))
        assert by_id(out, "n_words", "n_removed", "kept_sha256") == brute.substring(pairs(df), window)
    assert substring_dedup.substring_dedup(odd).count() == len(ROWS)
    assert substring_dedup.substring_dedup(odd.limit(0)).count() == 0


def test_substring_divides_heavy_keys(spark):
    """Many different texts around one passage: its keys are divided until they fit."""
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(20)) + " " + WORDS + " " + " ".join(f"b{i}x{j}" for j in range(20))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring_dedup.substring_dedup(df, 50, 10, most_units=300)
    assert by_id(out, "n_words", "n_removed", "kept_sha256") == brute.substring(rows)
    out = suffix_array.suffix_array_dedup(df, 100, 20, most_units=3000)
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix(rows, 100)


def test_suffix_array_dedup(documents, odd):
    for df in (documents, with_ids(odd)):
        out = suffix_array.suffix_array_dedup(df)
        assert by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix(pairs(df))
    assert suffix_array.suffix_array_dedup(odd.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\x00c", max_size=12).map(str.encode), min_size=1, max_size=5))
def test_two_stage_sorting(texts):
    array, s, end = suffix_array.suffix_array(texts)
    joined = b"\0".join(texts) + b"\0"
    inside = [int(i) for i in array if end[i] > i]
    assert [joined[i:end[i]] for i in inside] == sorted(joined[i:end[i]] for i in inside)
    assert sorted(array.tolist()) == list(range(len(joined)))
    kept = np.array(inside, np.int64)
    shared = suffix_array.common_prefix(kept, s, end, 9)
    for n, a, b in zip(shared[1:], inside, inside[1:]):
        x, y = joined[a:end[a]], joined[b:end[b]]
        same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert n == min(same, 9)


def test_mixing(spark, odd):
    out = mixing.mix(odd).collect()
    assert len(out) == len(ROWS)
    size = {r.source: r.source_size for r in out}
    target = {r.source: r.target for r in out}
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(target[s] <= 2 * size[s] for s in size) and all(r.taken <= 2 * r.size for r in out)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(odd.repartition(5)).collect()))
    emitted = mixing.emit(odd)
    assert emitted.columns == odd.columns and emitted.count() == sum(r.copies for r in out)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_jaccard(documents, odd):
    for df, k, t in ((documents, 4, 85), (with_ids(odd), 4, 85), (documents, 5, 80), (documents, 1, 60)):
        assert by_id(jaccard_join.jaccard_classes(df, k, t, sketch_bits=10), "n_shingles", "component_id") == brute.classes(pairs(df), k, t)
    assert jaccard_join.jaccard_classes(odd).count() == len(ROWS)
    assert jaccard_join.one_of_each_class(odd.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 150), (150, 160)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 150: 150, 160: 150, 200: 150}


def test_toxicity_learns_and_scores_odd_rows(spark, odd):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join([f"c{x}" for x in rng.integers(0, 400, 40)] + (["badword", "badwordy", "badwords"] if i % 4 == 0 else [])), "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(300) if zlib.crc32(b"%d" % i) % 3 == 1]
    assert brute.auc([out[i].score for i in held], [int(i % 4 == 0) for i in held]) > 0.9
    odd_scores = toxicity.score(odd, model).collect()
    assert len(odd_scores) == len(ROWS) and all(0 <= r.score <= 1 for r in odd_scores)
    assert toxicity.drop_toxic(odd, toxicity.train(docs.limit(0), labels.limit(0))).count() == len(ROWS)


def test_scores_do_not_depend_on_chunks():
    rng = np.random.default_rng(1)
    model = toxicity.fit([rng.integers(0, 99, (9, 3)).astype(np.uint16) for _ in range(8)], np.array([0.0, 1.0] * 4))
    text = pa.array([" ".join(f"t{x}" for x in rng.integers(0, 50, n)) for n in (3, 70, 0, 41)])
    want, old = model.scores(text), toxicity.CHUNK
    try:
        toxicity.CHUNK = 16
        assert np.allclose(model.scores(text), want)
    finally:
        toxicity.CHUNK = old


@settings(max_examples=25, deadline=None)
@given(st.text(st.sampled_from("<>[]/\\sINSTROLEUY|x é"), max_size=40))
def test_escape_is_reversible(spark, text):
    from pyspark.sql import functions as F
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert row.u == text and not any(m in row.e for m in ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[/ROLE]"))


def test_chat_tree_and_odd_rows(spark):
    from pyspark.sql import functions as F
    nodes = spark.createDataFrame([(1, 1, None, 1.0), (1, 2, 1, 5.0), (1, 3, 1, 1.0), (1, 4, 3, 9.0), (1, 5, 3, None), (2, 1, 9, 1.0), (3, 1, 2, 1.0), (3, 2, 1, 1.0)],
                                  "tree long, node long, parent long, score double")
    got = sorted((r.tree, r.branch, r.step, r.node) for r in chat.best_paths(nodes, 2).collect())
    assert got == [(1, 1, 0, 1), (1, 1, 1, 3), (1, 1, 2, 4), (1, 2, 0, 1), (1, 2, 1, 2), (2, 1, 0, 1)]  # tree 3 is a cycle
    rows = [(None, 0, "user", "hi"), (7, 1, "assistant", None), (7, None, "tool [/ROLE]", "[OUT] \\x"), (7, 2, None, "</s>"), (7, 3, "assistant", "ok"), (7, 3, "assistant", "ok")]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = {r.tree: ([tuple(t) for t in r.turns], r.said) for r in out.select("tree", chat.read_turns(F.col("formatted")).alias("turns"),
                                                                              chat.loss_text(F.col("formatted"), F.col("loss")).alias("said")).collect()}
    assert read[7] == ([("tool [/ROLE]", "[OUT] \\x"), ("assistant", ""), ("", "</s>"), ("assistant", "ok"), ("assistant", "ok")], "okok")


def test_topk(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(2)
    v = rng.normal(size=(230, 8)).astype(np.float32)
    v[5] = v[9] = v[100]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (None, [1.0] * 8), (350, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5, query_block=2, file_block=60).orderBy("query_id", "rank").collect()]
    q = np.floor(256 * v.astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 230, 50):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(230), -s)) if j != i][:5]
        want += [(i, r + 1, int(j), int(s[j])) for r, j in enumerate(order)]
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("bits", [1, 8])
def test_token_file_round_trip(bits):
    import io
    rng = np.random.default_rng(bits)
    docs = [(i, rng.integers(0, 2 ** 32, n, dtype=np.uint32)) for i, n in enumerate((0, 1, 7, 300, 64, 0, 129))]
    sink = io.BytesIO()
    w = token_files.Writer(sink, bits, block=64)
    for d, ids in docs:
        w.add(d, ids)
    assert w.close() == sum(len(x) for _, x in docs)
    got = list(token_files.Reader(sink.getvalue()).documents())
    assert [d for d, _ in got] == [d for d, _ in docs] and all((a == b).all() for (_, a), (_, b) in zip(got, docs))
    assert (token_files.Reader(sink.getvalue()).block(2) == np.concatenate([x for _, x in docs])[128:192]).all()


def test_token_table(documents, odd):
    path = tokenizer("byte_bpe_50k.json")
    for df in (documents, with_ids(odd)):
        assert by_id(token_files.token_table(df, path), "start", "n_tokens", "ids_crc32") == brute.token_rows(pairs(df), path)
    assert token_files.token_table(odd.limit(0), path).count() == 0


def test_bpe_rows(documents, odd):
    path = tokenizer("word_bpe_49k.json")
    for df in (documents, with_ids(odd)):
        assert by_id(bpe.encode_documents(df, path), "n_tokens", "ids_sha256", "decoded_sha256") == brute.bpe_rows(pairs(df), path)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeinthres '  \n\t\r<|endoftext>"), st.characters(codec="utf-8")), max_size=60))
def test_encoders_equal_the_library(text):
    from tokenizers import Tokenizer
    for name, encode in (("word_bpe_49k.json", bpe.codec), ("byte_bpe_50k.json", token_files.encoder)):
        path = tokenizer(name)
        library = Tokenizer.from_file(path)
        library.no_truncation()
        ids = np.frombuffer(encode(path).encode([text])[0], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
    assert bpe.codec(tokenizer("word_bpe_49k.json")).decode(np.array([320, 49407])).decode() == Tokenizer.from_file(tokenizer("word_bpe_49k.json")).decode([320, 49407], skip_special_tokens=False)


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """More labelled rows than training starts with: all others move the model too, whatever their order and partitions."""
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, f"{words[i % 4]} text {words[(i // 4) % 3]} {'vile' if i % 5 == 0 else 'mild'} {i % 7}", "en" if i % 2 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(999, 1)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "PART_ROWS", 64, raising=False)
    model = toxicity.train(docs, labels, most_each=20, holdout=None)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(out[i].rejected == (i % 5 == 0) for i in range(400))
    again = toxicity.train(docs.repartition(7), labels.repartition(5), most_each=20, holdout=None)
    assert (again.slope, again.shift, again.thresholds) == (model.slope, model.shift, model.thresholds) and np.array_equal(again.embedding, model.embedding)
    seen = 0
    for i in range(3, 60, 8):  # one row's text at a time becomes another
        other = docs.withColumn("text", F.when(F.col("doc_id") == i, "odd words here").otherwise(F.col("text")))
        changed = toxicity.train(other, labels, most_each=20, holdout=None)
        seen += (changed.slope, changed.shift) != (model.slope, model.shift) or not np.array_equal(changed.embedding, model.embedding)
        if seen >= 3:
            break
    assert seen >= 3
