"""The Merkle manifest against a plain tree, on odd rows and at every small size."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, told string, idx int, tree int"


def h(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, n_chars) -> str:
    values = [row[0], row[3], row[2], n_chars, row[1]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of nodes, from leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def walk(levels, i, node):
    """The siblings above leaf ``i`` and the root that ``node`` in its place gives."""
    told = ""
    for level in levels[:-1]:
        other = level[i ^ 1] if i ^ 1 < len(level) else ""
        told += other
        node = h(other + node if i & 1 else node + other)
        i >>= 1
    return told, node


def brute(rows):
    langs: dict = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in order:
        langs[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[x] = tree([leaf(r, r[4]) for r in langs[x]])
    top = tree([trees[x][-1][0] for x in order])
    out = []
    for at, x in enumerate(order):
        for i, r in enumerate(langs[x]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            near, node = walk(trees[x], i, leaf(r, r[4] + 1 if hit else r[4]))
            far, folded = walk(top, at, node)
            out.append((r[0], leaf(r, r[4]), trees[x][-1][0], top[-1][0], h(near + far), folded, folded == top[-1][0]))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("n", [*range(1, 18), 31, 33, 64])
def test_places_follow_from_the_sizes_of_complete_subtrees(n):
    nodes = [h(str(i)) for i in range(n)]
    levels = tree(nodes)
    log = merkle.append_log(nodes, n, len(levels) - 1)
    assert len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    for level, row in enumerate(levels):
        assert [log[i] for i in merkle.place(level, np.arange(len(row)), n)] == row


@pytest.mark.parametrize("height", [1, 2, 12])
def test_proofs_on_odd_rows(spark, height):
    rows = [(i, f"text {i}", "en" if i % 3 else "de", "a", i, "x", 1, "x", 1, 1) for i in range(45)]
    rows += [(None, None, None, None, None, None, None, None, None, None)] * 3 + [(7, "é" * 50, "é", "ñ", 50, "x", 1, "x", 1, 1), (7, "", "", "", 2 ** 63 - 1, "x", 1, "x", 1, 1)]
    rows += [(14, "same", "zz", "a", 4, "x", 1, "x", 1, 1)] * 5 + [(14, "same", "zz", "b", 4, "x", 1, "x", 1, 1), (-3, "long " * 20000, "n", "a", None, "x", 1, "x", 1, 1)]
    out = merkle.tamper_proofs(spark.createDataFrame(rows, DOCS), height)
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert {r[-1] for r in got} == {True, False}


def test_one_row_and_none(spark):
    one = [(3, "a", "en", "s", 1, None, None, None, None, None)]
    assert [tuple(r) for r in merkle.tamper_proofs(spark.createDataFrame(one, DOCS)).collect()] == brute(one)
    none = merkle.tamper_proofs(spark.createDataFrame([], DOCS))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_of_other_columns(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2]) for i in range(10)], "id int, body string, part string")
    manifest = merkle.build(docs, ("id", "body"), tree="part", order="id", height=2)
    out = merkle.proofs(manifest).withColumn("root", merkle.fold(F.col("hash"), F.col("steps")))
    assert {r.root for r in out.collect()} == {manifest.root}
    assert [r.key for r in out.orderBy("key").collect()] == list(range(10))
