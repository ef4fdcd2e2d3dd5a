"""Rows that an operator once lost or doubled: long texts, null and repeated doc_ids, large components."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import common, exact_dedup, jaccard_join, mixing, repeats, token_files, topk, toxicity
from ledgerspark.llm.catalog import tokenizer

DOCS = "doc_id long, text string, lang string, source string"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_anchors_do_not_depend_on_the_position_in_a_long_text():
    """Positions of 6 bits: a text of 1,000 units crosses them often."""
    rng = np.random.default_rng(3)
    values = rng.integers(1, 2 ** 63, 1000, dtype=np.uint64)
    values[700:900] = values[100:300]
    first, window, k = np.array([0, 400, 1000]), 20, 5
    rolling, text, lo, n, anchor = repeats.anchors(values, first, window, k, bits=6)
    assert [(t, p) for t, a, c in zip(text, lo, n) for p in range(a, a + c)] == [(0, p) for p in range(381)] + [(1, p) for p in range(400, 981)]
    assert ((anchor - lo <= window - k) & (anchor >= lo + n - 1)).all()
    own = {p: int(x) for a, c, x in zip(lo, n, anchor) for p in range(a, a + c)}
    assert all(own[p + 600] == own[p] + 600 for p in range(100, 281))
    whole = repeats.anchors(values, first, window, k)
    assert all((a == b).all() for a, b in zip((text, lo, n, anchor), whole[1:]))


def test_a_toxic_row_takes_no_clean_row_along(spark):
    rng = np.random.default_rng(0)
    bad = " ".join(["badword", "badwordy", "badwords"])
    train = [(i, " ".join([f"c{x}" for x in rng.integers(0, 400, 40)] + ([bad] if i % 4 == 0 else [])), "en", "a") for i in range(300)]
    docs = spark.createDataFrame(train, DOCS)
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int"))
    clean = " ".join(f"c{x}" for x in range(40))
    rows = [(None, f"{clean} {bad}", "en", "a"), (None, clean, "en", "a"), (None, None, None, None), (5, f"{clean} {bad}", "en", "a"), (5, clean, "en", "b"), (6, clean, None, "b")]
    assert rows_of(toxicity.drop_toxic(spark.createDataFrame(rows, DOCS), model)) == Counter(r for r in rows if bad not in (r[1] or ""))


@pytest.mark.parametrize("dim", [3, 200])
def test_topk_keeps_large_components(spark, dim):
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.normal(size=(120, dim)).astype(np.float32).astype(np.float64)) / 256
    v[7] *= 2.0 ** 22
    v[50] *= 2.0 ** 21
    v[51] = v[52] = 2.0 ** 19.5  # below 2**28 after scaling; their product passes 64 bits above 128 dimensions
    v[100, 0], v[3, 0], v[4, 0] = 2.0 ** 90, -2.0 ** 100, 2.0 ** 100
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(300, [float("inf")] * dim), (350, [None] * dim)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = v.astype(np.float32).astype(np.float64)
    exact = [[int(np.floor(256 * c)) for c in x] for x in v.tolist()]
    want = []
    for i in (0, 50, 51, 100):
        scores = sorted((-sum(a * b for a, b in zip(exact[i], exact[j])), j) for j in range(120) if j != i)[:5]
        want += [(i, r + 1, j, -s if -2 ** 63 <= -s < 2 ** 63 else None) for r, (s, j) in enumerate(scores)]
    found = topk.top_k(df, (F.col("vec_id") % 50 == 0) | (F.col("vec_id") == 51), 5, query_block=2, file_block=40)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == want


def test_mix_emits_what_each_row_drew(spark):
    rows = [(None if i % 3 == 0 else i % 40, " ".join(["w"] * (1 + i * 7 % 50)) + f" x{i}", "en", "abc"[i % 5 % 3]) for i in range(300)]
    rows += [(900, "same text here", "en", "a")] * 2 + [(None, "same text there", "en", "b")] * 3
    df = spark.createDataFrame(rows, DOCS)
    drawn = mixing.mix(df).collect()
    size = F.size(F.split("text", " "))
    emitted = mixing.emit(df).withColumn("size", size)
    want = Counter()
    for r in drawn:
        want[r.doc_id, r.source, r.size] += r.copies
    assert Counter((r.doc_id, r.source, r.size) for r in emitted.collect()) == +want
    words = {r.source: r.words for r in emitted.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    for s, target in {r.source: r.target for r in drawn}.items():
        assert abs(words[s] - target) <= max(r.size for r in drawn if r.source == s)
    assert rows_of(mixing.emit(df)) == rows_of(mixing.emit(df.repartition(5)))


def test_near_copies_are_rows_and_not_ids(spark):
    words = [f"w{i}" for i in range(100)]
    near, other, third = " ".join(words), " ".join(f"o{i}" for i in range(100)), " ".join(f"t{i}" for i in range(100))
    rows = [(3, near, "en", "a"), (5, near + " tail", "en", "a"), (5, other, "en", "b"), (None, third, "en", "a"), (None, third + " tail", "en", "a"),
            (None, "quite something else than that", "en", "a"), (None, "", "en", "a"), (None, None, "en", "a"), (8, other + " tail", "en", "a"), (9, other, "en", "a"), (9, other, "en", "a")]
    kept = jaccard_join.one_of_each_class(spark.createDataFrame(rows, DOCS))
    got = rows_of(kept)
    assert sum(got[r] for r in (rows[3], rows[4])) == 1  # of two near copies without an id, one
    assert got - Counter([rows[3], rows[4]]) == Counter([rows[0], rows[2], rows[5], rows[6], rows[7]])
    out = Counter((r.doc_id, r.component_id) for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, DOCS)).collect())
    # both texts of 5 are one document: 3, 5, 8 and 9 hang together
    assert out == Counter({(3, 3): 1, (5, 3): 2, (8, 3): 1, (9, 3): 2, (None, None): 5})


def test_one_row_stays_of_rows_that_repeat_id_and_text(spark):
    rows = [(1, "a", "en", "x"), (2, "a", "en", "x"), (2, "a", "en", "x"), (2, "a", "de", "x"), (None, "b", "en", "x"), (None, "b", "en", "x"),
            (None, "", "en", "x"), (None, None, "en", "x"), (3, "c", "en", "x"), (3, "d", "en", "x")]
    kept = exact_dedup.drop_exact_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.text or "") for r in kept) == Counter([(2, "a"), (None, "b"), (None, ""), (3, "c"), (3, "d")])
    assert all(tuple(r) in rows for r in kept)


def test_possible_misses_no_key_and_leaves_most_others(spark):
    df = spark.range(20000).withColumn("bits", F.lit("x"))
    marked = common.possible(df, F.col("id"), spark.range(0, 20000, 10).select((F.col("id") * F.lit(1)).alias("k")), "flag")
    assert marked.columns == ["id", "bits", "flag"]
    flags = {r.id: r.flag for r in marked.collect()}
    assert len(flags) == 20000 and all(flags[i] for i in range(0, 20000, 10))
    assert sum(flags.values()) < 2100
    assert not any(r.flag for r in common.possible(df, F.col("id"), spark.range(0), "flag").collect())


def test_labelled_texts_move_once_and_meet_every_label(spark):
    docs = spark.createDataFrame([(i % 50 if i % 9 else None, f"text {i}") for i in range(120)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)] + [(3, 0), (6, 0)], "id long, toxic int")
    dealt = toxicity._dealt(docs, labelled, 4)
    want = docs.join(labelled, F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "text")
    rows = dealt.withColumn("task", F.spark_partition_id()).collect()
    assert Counter((r.doc_id, r.toxic, r.text) for r in rows) == rows_of(want)
    assert len({(r.part, r.task) for r in rows}) == len({r.part for r in rows})
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    moves = [x for x in plan.split("\n") if "Exchange hashpartitioning(part" in x]
    assert len(moves) == 1 and "SortMergeJoin" not in plan


def test_only_likely_copies_move(spark):
    rows = [(i, f"some text {i % 90}", "en", "web") for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    odd = spark.createDataFrame([(95, False), (96, False)], "did long, tied boolean")
    out = common.without_copies(docs, odd, [F.coalesce("doc_id", F.lit(common.NULL_ID))])
    assert rows_of(out) == Counter(r for r in rows if r[0] not in (95, 96))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("LeftAnti")  # the rows that cannot be odd are not part of the join


def test_new_words_are_encoded_without_offsets():
    enc = token_files.Encoder(tokenizer("byte_bpe_50k.json"))
    texts = ["Une forêt, zqwxv; Straße naïve\nline end.", "été été! x1y2 mañana?", "", "one"]
    want = [token_files.packed(e.ids) for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]

    class NoOffsets:
        def __init__(self, own):
            self.encode_batch_fast = own.encode_batch_fast

    enc.tokenizer = NoOffsets(enc.tokenizer)
    assert enc.encode(texts) == want


def test_distinct_words_go_to_the_library_once():
    enc = token_files.Encoder(tokenizer("byte_bpe_50k.json"))
    texts = ["Zqwxv, zqwxv vlopt; vlopt: naïveté!\nvlopt end", "Zqwxv vlopt. naïveté's x1y2 zqwxv,", "Zqwxv"]
    want = [token_files.packed(e.ids) for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    seen, tokenize = [], enc.tokenize
    enc.tokenize = lambda piece: (seen.append(piece), tokenize(piece))[1]
    assert enc.encode(texts) == want
    assert sorted(seen) == sorted(["Ġ" + w for w in ("zqwxv", "vlopt", "end", "naÃ¯vetÃ©", "x")])
    ids, sizes = enc.ids(texts)
    assert ids.tobytes() == b"".join(want) and sizes.tolist() == [len(w) // 4 for w in want] and len(seen) == 5
    assert [len(x) for x in enc.ids([])] == [0, 0]


def test_line_ends_behind_spaces_keep_the_space():
    enc = token_files.Encoder(tokenizer("byte_bpe_50k.json"))
    texts = ["the end. \nNext", "a \n b", "a \n", " \nb", "a\nb \nc", "a\n b", "a  b\nc", "a \n\nb", "\nb", "a\n", "a\0b c\nd", "a \1b", " ", "a ",
             "a\x85\nb", "x <|endoftext|> \ny", "é \té\n", "well-known 3,5 «été» l'été it's  so"]
    want = [token_files.packed(e.ids) for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want
    assert [enc.encode([t])[0] for t in texts] == want


def test_letters_sent_to_the_model_are_one_piece():
    import re
    import sys
    enc = token_files.Encoder(tokenizer("byte_bpe_50k.json"))
    letters = re.sub(f"[^{token_files.STABLE}]", "", "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)])))
    assert len(letters) > 30000
    assert len(enc.tokenizer.pre_tokenizer.pre_tokenize_str(" " + letters)) == 1
    for end in re.findall(f"[{token_files.NO_LETTER}]", "".join(map(chr, range(128)))):
        assert enc.tokenizer.pre_tokenizer.pre_tokenize_str("ab" + end)[0][0] == "ab"
