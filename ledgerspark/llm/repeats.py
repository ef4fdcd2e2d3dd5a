"""Finding where windows of W consecutive units (words or bytes) occur more than once.

Shared by substring dedup (words, suffix trees) and suffix-array dedup (bytes). What is common to both:

* Anchors. Every window is assigned to one of its k-grams, the one of smallest hash (leftmost on ties). The choice depends on
  the window's content only, so equal windows have equal anchors at equal distances. Windows of one document that
  share an anchor are consecutive; they and their text are the anchor's context.
* A k-gram is the key of its contexts: a window can only be repeated inside its key. Keys seen once are dropped
  after counting, so text is moved only for contexts whose key repeats.
* Equal contexts are one context: copies cost a small row each, and never meet in a task. A key whose contexts are all equal
  needs no text at all.
* Memory-sized groups. A key with more distinct text than ``most_units`` is divided: the windows of each context are
  split by their distance to the anchor, and each part gets as its key all units that every window of the part holds.
  Keys thus get longer where needed, up to the whole window, when all contexts of a key are equal.
* The remaining keys, packed into groups of bounded size, are solved in memory by the operator's own method.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import (Rolling, drop_table, longs, map_arrow, materialize, scramble, slices, union_length)

POSITION_BITS = 24  # of a gram's 64 bits in the search for anchors; the others order the grams
ROW = "did long, rid long, key long, cid long, start int, size int, off int"


@dataclass(frozen=True)
class Units:
    """How a slice of texts becomes a sequence of units: hash values, and the first unit of each text."""

    values: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    #: raw bytes of units [start, start + size) of one text, for each requested context
    cut: Callable[[pa.Array, list], list[list[bytes]]]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in columns.values()], list(columns))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _window_anchors(grams: np.ndarray, m: int, bits: int) -> np.ndarray:
    """Position of the least of each m consecutive grams (leftmost on ties), for the grams of at most ``1 << bits`` positions:
    a position takes the low bits of the scrambled hash, so that one minimum finds both."""
    low = np.uint64((1 << bits) - 1)
    v = (grams * np.uint64(0x9E3779B97F4A7C15)) & ~low | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= m:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    if width < m:
        v = np.minimum(v[:len(v) - (m - width)], v[m - width:])
    return (v & low).astype(np.int64)


def anchors(values: np.ndarray, first: np.ndarray, window: int, k: int, bits: int = POSITION_BITS):
    """(text, lo, n, anchor) of every context: windows lo .. lo + n - 1, positions in ``values``.

    A text can have any number of units: grams are taken in overlapping pieces of ``1 << bits``, each window in one piece.
    More than ``window - k`` positions have to fit."""
    m = window - k + 1
    rolling = Rolling(values)
    grams = rolling.all(k)
    empty = np.empty(0, np.int64)
    if len(grams) < m:
        return rolling, empty, empty, empty, empty
    step = (1 << bits) - m + 1  # windows of a piece
    if step < 1:
        raise ValueError(f"{m} grams of a window do not fit {bits} bits")
    anchor = np.concatenate([at + _window_anchors(grams[at:at + (1 << bits)], m, bits) for at in range(0, len(grams) - m + 1, step)])
    size = np.diff(first)
    ok = np.zeros(len(values) + 1, np.int8)
    has = size >= window  # windows of a text: first .. first + size - window
    np.add.at(ok, first[:-1][has], 1)
    np.add.at(ok, (first[1:] - window + 1)[has], -1)
    at = np.flatnonzero(np.cumsum(ok[:len(anchor)]) > 0)
    if not len(at):
        return rolling, empty, empty, empty, empty
    text = np.searchsorted(first, at, "right") - 1
    new = np.append(True, (anchor[at[1:]] != anchor[at[:-1]]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(at)))
    return rolling, text[begin], at[begin], n, anchor[at[begin]]


def _context_rows(units: Units, window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values, first = units.values(part.column("text"))
                rolling, text, lo, n, anchor = anchors(values, first, window, k)
                if len(lo):
                    size = n + window - 1
                    yield _batch(did=longs(part, "did")[text], rid=longs(part, "rid")[text],
                                 key=_signed(rolling.ranges(anchor, anchor + k)), cid=_signed(rolling.ranges(lo, lo + size)),
                                 start=(lo - first[text]).astype(np.int32), size=size.astype(np.int32), off=(anchor - lo).astype(np.int32))
    return run


def _divided(units: Units, window: int, width: int):
    """Contexts (listed per document in ``parts``) split into parts of ``width`` distances from the anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values, first = units.values(part.column("text"))
                rolling = Rolling(values)
                out = []
                for row, contexts in enumerate(part.column("parts").to_pylist()):
                    did, rid = part.column("did")[row].as_py(), part.column("rid")[row].as_py()
                    for c in contexts:
                        last = c["off"]                              # distance of the first window
                        least = c["off"] - (c["size"] - window)      # of the last one
                        for s in range(least // width, last // width + 1):
                            near, far = max(least, s * width), min(last, s * width + width - 1)
                            lo = c["start"] + c["off"] - far
                            out.append((did, rid, c["key"], s, lo, window + far - near, far, first[row] + c["start"] + c["off"], first[row] + lo))
                if not out:
                    continue
                did, rid, key, s, start, size, off, anchor, lo = (np.array(x, np.int64) for x in zip(*out))
                shared = rolling.ranges(anchor - s * width, anchor + window - (s * width + width - 1))
                key = scramble(key.view(np.uint64) ^ scramble(shared + s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(width)))
                yield _batch(did=did, rid=rid, key=_signed(key), cid=_signed(rolling.ranges(lo, lo + size)),
                             start=start.astype(np.int32), size=size.astype(np.int32), off=off.astype(np.int32))
    return run


def _summary(rows: DataFrame) -> DataFrame:
    """One row per distinct context, with what its key has in all."""
    each = rows.groupBy("key", "cid").agg(F.count("*").alias("n"), F.min("did").alias("least"), F.max("did").alias("last"),
                                          F.min(F.struct("did", "rid", "start", "size")).alias("rep"))
    whole = each.groupBy("key").agg(F.count("*").alias("contexts"), F.sum("n").alias("rows"), F.min("least").alias("key_least"),
                                    F.max("last").alias("key_last"), F.sum("rep.size").alias("units"))
    return each.join(whole, "key")


def repeated_windows(docs: DataFrame, units: Units, window: int, k: int, across: bool, most_units: int,
                     solve: Callable[[pa.Table], pa.Table], found: str) -> tuple[DataFrame, DataFrame]:
    """(rows, answers): where contexts occur, and for each distinct one (key, cid) which of its windows repeat.

    ``docs``: did, rid, text. ``across``: only repeats between different documents count. ``solve`` gets groups of whole
    keys as a table (key, cid, n, least, text) and returns (key, cid, *found)."""
    repeated = F.col("key_least") < F.col("key_last") if across else F.col("rows") > 1
    every = materialize(map_arrow(docs.select("did", "rid", "text"), _context_rows(units, window, k), ROW), "contexts")
    keys = every.groupBy("key").agg(F.count("*").alias("rows"), F.min("did").alias("key_least"), F.max("did").alias("key_last"))
    # written first: against a plain table Spark can split a key that very many rows share
    keys = materialize(keys.filter(repeated).select("key"), "repeated-keys")
    rows = materialize(every.join(keys, "key", "left_semi"), "repeated-contexts")
    drop_table(every)
    width = window - k + 1
    heavy = (F.col("units") > most_units) & (F.col("contexts") > 1)
    level = rows
    summary = None
    while True:
        own = materialize(_summary(level).filter(repeated), "distinct-contexts")
        light = own if width == 1 else own.filter(~heavy)
        summary = light if summary is None else summary.unionByName(light)
        if width == 1 or own.filter(heavy).isEmpty():
            break
        # contexts of heavy keys stay among the rows, where no answer will meet them; their parts are added
        width = -(-width // 4)
        keys = materialize(own.filter(heavy).select("key").distinct(), "heavy-keys")
        parts = (level.join(keys, "key", "left_semi").groupBy("did", "rid")
                 .agg(F.collect_set(F.struct("key", "start", "size", "off")).alias("parts")))  # bounded by the document's length
        level = materialize(map_arrow(docs.join(parts, ["did", "rid"]), _divided(units, window, width), ROW), "divided-contexts")
        rows = rows.unionByName(level)
    mixed = summary.filter("contexts > 1")
    wanted = (mixed.select("key", "cid", "n", "least", "rep.*").groupBy("did", "rid")
              .agg(F.collect_list(F.struct("key", "cid", "n", "least", "start", "size")).alias("parts")))
    return rows, summary, _solved(docs, wanted, units, most_units, solve, found)


def _solved(docs: DataFrame, wanted: DataFrame, units: Units, most_units: int, solve, found: str) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                parts = part.column("parts").to_pylist()
                texts = units.cut(part.column("text"), parts)
                flat_parts = [c for p in parts for c in p]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[name] for c in flat_parts], pa.int64()) for name in ("key", "cid", "n", "least")]
                    + [pa.array([t for row in texts for t in row], pa.binary())], ["key", "cid", "n", "least", "text"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            at = 0
            keys = longs(batch, "key")
            weight = np.cumsum([len(t) for t in batch.column("text").to_pylist()])
            for i in range(1, batch.num_rows + 1):  # a group ends between keys, once it is large enough
                if i < batch.num_rows and keys[i] != keys[i - 1] and size + weight[i - 1] - (weight[at - 1] if at else 0) >= most_units:
                    yield from solve(pa.Table.from_batches([*held, batch.slice(at, i - at)])).to_batches()
                    held, size, at = [], 0, i
            if held and size >= most_units and batch.num_rows and at == 0 and keys[0] != held[-1].column("key")[-1].as_py():
                yield from solve(pa.Table.from_batches(held)).to_batches()
                held, size = [], 0
            if batch.num_rows:
                held.append(batch.slice(at))
                size += int(weight[-1] - (weight[at - 1] if at else 0))
        if held:
            yield from solve(pa.Table.from_batches(held)).to_batches()

    contexts = map_arrow(docs.select("did", "rid", "text").join(wanted, ["did", "rid"]), cut, "key long, cid long, n long, least long, text binary")
    return map_arrow(contexts.repartition("key").sortWithinPartitions("key"), groups, f"key long, cid long, {found}")


def apply_spans(docs: DataFrame, spans: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(slice, list of merged [start, end) arrays)`` over all documents; ``spans``: did, rid, lo, hi in units."""
    merged = spans.groupBy("did", "rid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # bounded by the document's length
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                column = part.column("spans")
                own = [union_length(np.array([(s["lo"], s["hi"]) for s in row], np.int64).reshape(-1, 2)) if row else np.empty((0, 2), np.int64)
                       for row in column.to_pylist()]
                yield fn(part, own)

    return map_arrow(docs.select("did", "rid", "text").join(merged, ["did", "rid"], "left"), run, schema)


def runs(mask: np.ndarray) -> np.ndarray:
    """[start, end) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)
