"""Suffix-array dedup over bytes by two-stage sorting.

Groups of contexts (see ``repeats``) are put into one suffix array each. Stage one sorts directly only the suffixes that are
smaller than their successor; stage two scans the buckets of first bytes in ascending order and induces the others: when the
scan meets suffix i, suffix i - 1 - if larger than i - is the next one of its bucket. Common prefixes of neighbours then
say which suffixes share ``window`` bytes with another one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import byte_values, flat, keyed, public_id
from ledgerspark.llm.repeats import Units, apply_spans, repeated_windows, runs

WINDOW = 400
ANCHOR = 50
GROUP = 1_000_000  # bytes of distinct text per group


def _cut(texts: pa.Array, parts: list) -> list[list[bytes]]:
    data, offsets = flat(texts)
    return [[data[offsets[row] + c["start"]:offsets[row] + c["start"] + c["size"]].tobytes() for c in contexts] for row, contexts in enumerate(parts)]


def _values(texts: pa.Array):
    data, offsets = flat(texts)
    return byte_values(data), offsets


BYTES = Units(_values, _cut)


def suffix_array(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(array, symbols, ends): all suffixes of all texts in order, over the texts joined with end marks.

    ``symbols`` is the joined sequence, bytes plus one, with 0 (smallest) behind each text; a suffix ends with its text.
    Equal suffixes of different texts stand in the order of their positions."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = b"\0".join(texts) + b"\0"
    n = len(joined)
    marks = np.cumsum(sizes + 1) - 1
    s = np.frombuffer(joined, np.uint8).astype(np.int16) + 1
    s[marks] = 0
    end = np.repeat(marks, sizes + 1)
    # a suffix is smaller than its successor if the first byte that differs from its own is larger
    change = np.append(np.flatnonzero(s[1:] != s[:-1]), n - 1)
    stop = change[np.searchsorted(change, np.arange(n))]
    smaller = np.zeros(n, bool)
    inner = stop < n - 1
    smaller[inner] = s[stop[inner] + 1] > s[stop[inner]]
    smaller[marks] = True  # the smallest of all
    direct = np.flatnonzero(smaller)
    direct = direct[s[direct] > 0]
    stops = end.tolist()
    order = np.array(sorted(direct.tolist(), key=lambda i: joined[i:stops[i]]), np.int64)
    first = s[order]
    direct_of = np.searchsorted(first, np.arange(258))  # sorted, so each bucket's are contiguous
    induced: list[list[np.ndarray]] = [[] for _ in range(258)]
    buckets = []

    def scan(found: np.ndarray) -> None:
        """Found suffixes, in order, send their larger predecessors to the ends of their buckets."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            symbol = s[before]
            by = np.argsort(symbol, kind="stable")
            symbol, before = symbol[by], before[by]
            cut = np.flatnonzero(np.diff(symbol)) + 1
            for part, c in zip(np.split(before, cut), symbol[np.append(0, cut)].tolist(), strict=True):
                induced[c].append(part)

    for c in range(257):
        if c == 0:
            own = marks
            scan(own)
        else:
            parts, done = induced[c], 0
            while done < len(parts):  # runs of c: suffixes of this bucket send others into this bucket
                scan(parts[done])
                done += 1
            tail = order[direct_of[c]:direct_of[c + 1]]
            own = np.concatenate([*parts, tail]) if parts or len(tail) else tail
            scan(tail)
        buckets.append(own)
    return np.concatenate(buckets), s, end


def common_prefix(array: np.ndarray, s: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in the array, counted up to ``most``."""
    out = np.zeros(len(array), np.int64)
    if len(array) < 2:
        return out
    padded = np.concatenate([(s - 1).astype(np.uint8), np.zeros(8, np.uint8)])  # no comparison reaches an end mark
    words = padded[:-7].astype(np.uint64)
    for j in range(1, 8):
        words |= padded[j:len(padded) - 7 + j].astype(np.uint64) << np.uint64(8 * j)
    a, b = array[:-1], array[1:]
    room = np.minimum(np.minimum(end[a] - a, end[b] - b), most)
    shared = np.zeros(len(a), np.int64)
    alive = np.flatnonzero(room > 0)
    left, right, most_here = a[alive], b[alive], room[alive]
    done = 0
    while len(alive):  # eight bytes at a time; all that are alive share ``done`` bytes
        differ = words[left + done] ^ words[right + done]
        # the lowest set bit says where they part
        first = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8)
        here = np.minimum(done + first, most_here)
        on = (first == 8) & (here < most_here)
        shared[alive[~on]] = here[~on]
        alive, left, right, most_here = alive[on], left[on], right[on], most_here[on]
        done += 8
    out[1:] = shared
    return out


def _solve(window: int):
    def solve(group: pa.Table) -> pa.Table:
        texts = group.column("text").to_pylist()
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        array, s, end = suffix_array(texts)
        array = array[end[array] - array >= window]  # suffixes that start a window
        shared = common_prefix(array, s, end, window)
        twice = shared >= window
        twice[:-1] |= shared[1:] >= window
        mask = np.zeros(len(s), bool)
        mask[array[twice]] = True
        # a context that occurs more than once repeats as a whole
        for i in np.flatnonzero(group.column("n").to_numpy() > 1).tolist():
            mask[first[i]:first[i] + sizes[i] - window] = True
        found = runs(mask)
        t = np.searchsorted(first, found[:, 0], "right") - 1
        take = lambda c: group.column(c).to_numpy()[t]
        return pa.table({"key": take("key"), "cid": take("cid"), "lo": (found[:, 0] - first[t]).astype(np.int32),
                         "hi": (found[:, 1] - 1 - first[t] + window).astype(np.int32)})
    return solve


def repeated_bytes(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, most_units: int = GROUP) -> DataFrame:
    """did, rid, lo, hi: byte ranges covered by windows that start anywhere else too. ``docs``: ``keyed`` rows."""
    rows, summary, solved = repeated_windows(docs, BYTES, window, k, False, most_units, _solve(window), "lo int, hi int")
    plain = summary.filter("contexts = 1").select("key", "cid", F.lit(0).alias("lo"), F.col("rep.size").alias("hi"))
    hits = rows.join(solved.unionByName(plain), ["key", "cid"])
    return hits.select("did", "rid", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))


def _kept(part: pa.RecordBatch, spans: list) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"))
    gone, texts = [], []
    for row, own in enumerate(spans):
        whole = data[offsets[row]:offsets[row + 1]]
        keep = np.ones(len(whole), bool)
        for lo, hi in own:
            keep[lo:hi] = False
        gone.append(len(whole) - int(keep.sum()))
        texts.append(whole[keep].tobytes())
    return pa.RecordBatch.from_arrays(
        [part.column("did"), pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array([len(x) for x in spans], pa.int64()),
         pa.array(texts, pa.binary()), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
        ["did", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def suffix_array_dedup(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, most_units: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256 for each row of ``docs`` (doc_id, text).

    Removes each byte covered by ``window`` bytes that also start anywhere else, in the same document too; judged on the input,
    so all places of a repeat go. A null text is empty; doc_id may be null; a repeated row is another place. Empty table:
    empty result; other columns are ignored."""
    rows = keyed(docs)
    out = apply_spans(rows, repeated_bytes(rows, window, k, most_units), _kept,
                      "did long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.select(public_id("did").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
