"""Substring dedup over words by prefix-partitioned suffix trees.

The suffixes of all documents that can repeat (see ``repeats``) are partitioned by variable-length prefixes into groups that
fit a task's memory. In each group the suffix tree is built: suffixes are ranked by prefix doubling, sorted, and the depths
at which neighbours part (their longest common prefixes) give the tree's internal nodes. The maximal intervals of neighbours
that part at depth ``window`` or deeper are the subtrees below the tree's deep internal nodes: each is one repeat, and its
smallest document keeps it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import flat, keyed, public_id, word_hashes, word_spans
from ledgerspark.llm.repeats import Units, apply_spans, repeated_windows, runs

WINDOW = 50
ANCHOR = 10
GROUP = 1_000_000  # of distinct text per group: words per key, bytes per pack of keys


def _values(texts: pa.Array):
    data, offsets = flat(texts)
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(data, starts, ends), first


def _cut(texts: pa.Array, parts: list) -> list[list[bytes]]:
    data, offsets = flat(texts)
    starts, ends, first = word_spans(data, offsets)
    out = []
    for row, contexts in enumerate(parts):
        own = []
        for c in contexts:
            a = first[row] + c["start"]
            own.append(data[starts[a]:ends[a + c["size"] - 1]].tobytes())
        out.append(own)
    return out


WORDS = Units(_values, _cut)


class SuffixTree:
    """Sorted leaves and internal-node depths of the suffix tree of several word sequences.

    ``order``: suffixes in lexicographic order of their words; ``depth[i]``: words that leaves i - 1 and i share, i.e. the
    depth of their lowest common node (exact up to 2 * ``deep``)."""

    def __init__(self, words: np.ndarray, first: np.ndarray, leaves: np.ndarray, deep: int):
        n = len(words)
        self.levels, step = [], 1
        rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
        end = np.repeat(first[1:], np.diff(first))
        at = np.arange(n)
        while True:
            self.levels.append((step, rank))
            if step >= deep:
                break
            after = np.zeros(n, np.int64)  # 0: the sequence has ended
            inside = at + step < end
            after[inside] = rank[at[inside] + step]
            rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
            step *= 2
        self.order = leaves[np.argsort(rank[leaves], kind="stable")]
        self.depth = np.zeros(len(leaves), np.int64)
        if len(leaves) > 1:
            a, b = self.order[:-1].copy(), self.order[1:].copy()
            enda, endb = end[a], end[b]
            shared = np.zeros(len(a), np.int64)
            for step, rank in reversed(self.levels):
                alive = (a < enda) & (b < endb)
                same = np.zeros(len(a), bool)
                same[alive] = rank[a[alive]] == rank[b[alive]]
                # a rank of a suffix shorter than the step also holds where it ended
                most = np.minimum(step, np.minimum(enda - a, endb - b))
                gain = np.where(same, most, 0)
                shared, a, b = shared + gain, a + gain, b + gain
            self.depth[1:] = shared

    def subtrees(self, depth: int) -> np.ndarray:
        """First leaf of each subtree whose leaves all share ``depth`` words (single leaves included)."""
        return np.flatnonzero(np.append(True, self.depth[1:] < depth)) if len(self.order) else np.empty(0, np.int64)


def _solve(window: int):
    def solve(group: pa.Table) -> pa.Table:
        data, offsets = flat(group.column("text"))
        starts, ends, first = word_spans(data, offsets)
        size = np.diff(first)
        words = word_hashes(data, starts, ends)
        owner = np.repeat(np.arange(len(size)), size)
        leaves = np.flatnonzero(np.arange(len(words)) + window <= first[1:][owner])
        tree = SuffixTree(words, first, leaves, window)
        least = group.column("least").to_numpy()
        heads = tree.subtrees(window)
        lowest = np.minimum.reduceat(least[owner[tree.order]], heads) if len(heads) else np.empty(0, np.int64)
        mine = np.empty(len(words), np.int64)
        mine[tree.order] = np.repeat(lowest, np.diff(np.append(heads, len(tree.order))))
        # consecutive windows of a context that the same document holds first
        text, value = owner[leaves], mine[leaves]
        new = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1])) if len(leaves) else np.empty(0, bool)
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(leaves)) - 1
        t = text[at]
        take = lambda c: group.column(c).to_numpy()[t]
        return pa.table({"key": take("key"), "cid": take("cid"), "lo": (leaves[at] - first[t]).astype(np.int32),
                         "hi": (leaves[stop] - first[t] + window).astype(np.int32), "keeper": value[at]})
    return solve


def repeated_words(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, most_units: int = GROUP) -> DataFrame:
    """did, rid, lo, hi: word ranges covered by windows that also start in a document of smaller id. ``docs``: ``keyed`` rows."""
    rows, summary, solved = repeated_windows(docs, WORDS, window, k, True, most_units, _solve(window), "lo int, hi int, keeper long")
    plain = summary.filter("contexts = 1").select("key", "cid", F.lit(0).alias("lo"), F.col("rep.size").alias("hi"), F.col("least").alias("keeper"))
    hits = rows.join(solved.unionByName(plain), ["key", "cid"]).filter("keeper < did")
    return hits.select("did", "rid", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))


def _kept(part: pa.RecordBatch, spans: list) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"))
    starts, ends, first = word_spans(data, offsets)
    blob = data.tobytes()
    gone, texts = [], []
    for row, own in enumerate(spans):
        a, n = int(first[row]), int(first[row + 1] - first[row])
        keep = np.ones(n, bool)
        for lo, hi in own:
            keep[lo:hi] = False
        gone.append(n - int(keep.sum()))
        texts.append(b" ".join([blob[starts[i]:ends[i]] for i in (a + np.flatnonzero(keep)).tolist()]))
    return pa.RecordBatch.from_arrays(
        [part.column("did"), pa.array(np.diff(first)), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()),
         pa.array([hashlib.sha256(t).hexdigest() for t in texts])], ["did", "n_words", "n_removed", "kept", "kept_sha256"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, most_units: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept, kept_sha256 for each row of ``docs`` (doc_id, text).

    Removes each word covered by ``window`` consecutive words that also start in a document with a smaller doc_id; windows are
    judged on the input. A null text has no words; a null doc_id is smaller than any other; rows that repeat a doc_id
    are one document to each other, so none removes the other's words. Empty table: empty result; other columns are ignored.
    """
    rows = keyed(docs)
    out = apply_spans(rows, repeated_words(rows, window, k, most_units), _kept,
                      "did long, n_words long, n_removed long, kept string, kept_sha256 string")
    return out.select(public_id("did").alias("doc_id"), "n_words", "n_removed", "kept", "kept_sha256")
