"""Hard negatives by BOND: branch and bound over a vertically stored file.

The file holds blocks of rows with one array per dimension, and each dimension's least and greatest value. An anchor reads the
dimensions in descending order of its own components' size and adds up partial scores of the rows in its candidate bitmap.
What the unread dimensions can still add lies between sums of their least and greatest contributions, so every row has a lower
and an upper bound; rows that no longer can be an answer leave the bitmap, and their remaining dimensions are never read.

Two scans follow one another. The first finds each anchor's best rows of its own label, the positives. Each distinct positive
score gives a window of scores; the second finds the best rows of other labels inside each window. A row leaves
when its bounds miss all windows or when enough rows that are certain to lie in a window are better.

A task holds one block of the file and one of anchors, and reports a bounded number of rows per anchor (and window). Anchors
are a stated query set; every row is a candidate of every anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialize, ship_package

SCALE = 256  # a power of two: x * SCALE is exact
STRIDE = 8  # dimensions between two looks at the bounds
NARROW = 2 ** 31  # components below it after scaling are stored as 32-bit integers
PLACE_BITS = 2104  # more than any sum of up to 2 ** 31 products of scaled doubles has
FITS = b"\1"  # place of a score of 64 bits, between the places of those below and above

Resolve = Callable[[np.ndarray, np.ndarray], np.ndarray]


# --- scores of any size --------------------------------------------------------------------------

def place_of(score: int) -> tuple[int | None, bytes]:
    """A score as (long or null, sort key of scores that a long cannot hold)."""
    if -2 ** 63 <= score < 2 ** 63:
        return score, FITS
    return None, (2 ** PLACE_BITS + score).to_bytes(PLACE_BITS // 8 + 1, "big")


def score_of(score: int | None, place: bytes) -> int:
    return score if place == FITS else int.from_bytes(place, "big") - 2 ** PLACE_BITS


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as 64-bit integers, or as Python integers if some are beyond them."""
    if not x.size or np.abs(x).max() < 2.0 ** 45:
        return np.floor(x * SCALE).astype(np.int64)
    return np.array([int(np.floor(c * SCALE)) if abs(c) < 2.0 ** 45 else int(c) * SCALE for c in x.ravel().tolist()], object).reshape(x.shape)


# --- one block -----------------------------------------------------------------------------------

class Block:
    """Rows stored by dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: list[np.ndarray]):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.low, self.high = [c.min() for c in columns], [c.max() for c in columns]
        self.size = max(max(abs(int(a)), abs(int(b))) for a, b in zip(self.low, self.high, strict=True))

    def scan(self, q: np.ndarray, bitmap: np.ndarray, resolve: Resolve, factor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Rows (numbers) of ``bitmap`` that ``resolve(lower, upper)`` keeps to the end, with their exact scores. Scores times
        ``factor`` that may pass 64 bits are computed on Python integers."""
        fits = len(q) * self.size * max(abs(int(c)) for c in q) * factor < 2 ** 63
        kind = np.int64 if fits else object
        q = q.astype(kind)
        order = np.argsort(-np.abs(q.astype(float)), kind="stable")
        a, b = q * np.array(self.low, kind), q * np.array(self.high, kind)
        least, most = np.minimum(a, b)[order], np.maximum(a, b)[order]
        least_left, most_left = least.sum() - np.cumsum(least), most.sum() - np.cumsum(most)
        rows = np.flatnonzero(bitmap)
        score = np.zeros(len(rows), kind)
        for read, d in enumerate(order.tolist(), 1):
            column = self.columns[d]
            score = score + q[d] * (column if len(rows) == len(column) else column[rows]).astype(kind)
            if read % STRIDE == 0 or read == len(order):
                keep = resolve(score + least_left[read - 1], score + most_left[read - 1])
                if not keep.all():
                    rows, score = rows[keep], score[keep]
                if not len(rows):
                    break
        return rows, score


def among_best(k: int) -> Resolve:
    """Keeps what may be one of the k best (all ties with the kth)."""
    def resolve(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]
    return resolve


def in_windows(windows: list[tuple[int, int]], k: int) -> Resolve:
    """Keeps what may be one of the k best in one of ``windows`` (least and greatest score, both inside)."""
    def resolve(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lower), bool)
        for low, high in windows:
            near = (upper >= low) & (lower <= high)
            certain = lower[(lower >= low) & (upper <= high)]
            if len(certain) >= k:
                near &= upper >= np.partition(certain, len(certain) - k)[len(certain) - k]
            out |= near
        return out
    return resolve


def best(ids: np.ndarray, score: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """The k best (id, score): higher scores first, then smaller ids."""
    yield from sorted(zip(ids.tolist(), score.tolist(), strict=True), key=lambda r: (-r[1], r[0]))[:k]


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest integer n with low * positive <= 100 * n <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


# --- Spark ---------------------------------------------------------------------------------------

FILE = "dim int, block int, ids binary, labels binary, wide boolean, columns array<binary>"
FOUND = "aid long, w int, vec_id long, score long, place binary"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x, dim, wide) of the rows that take part: those with an id, a label and a vector of one component or more,
    all finite; ``wide`` marks vectors with a component of ``NARROW`` or more after scaling."""
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
            .filter(F.coalesce(fine, F.lit(False)))
            .select("vec_id", "label", "x", F.size("x").alias("dim"), F.exists("x", lambda c: F.abs(c) >= NARROW / SCALE - 1).alias("wide")))


def vertical_file(rows: DataFrame, file_block: int) -> tuple[DataFrame, int]:
    """The rows of ``usable`` by dimension, in blocks of about ``file_block`` rows of one length and width, and the number of block
    names. Rows go to blocks by their id and number, so that rows that repeat an id spread too."""
    n = {r["wide"]: r["n"] for r in rows.groupBy("wide").agg(F.count("*").alias("n")).collect()}
    narrow, wide = -(-n.get(False, 0) // file_block), -(-n.get(True, 0) // file_block)
    hashed = F.xxhash64("vec_id", F.monotonically_increasing_id())
    block = F.when(F.col("wide"), F.pmod(hashed, F.lit(max(1, wide))) + narrow).otherwise(F.pmod(hashed, F.lit(max(1, narrow))))

    def lay(t: pa.Table) -> pa.Table:
        dim, is_wide = t["dim"][0].as_py(), t["wide"][0].as_py()
        x = t["x"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        x = x if is_wide else np.floor(x * SCALE).astype("<i4")
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([t["block"][0].as_py()], pa.int32()), "ids": [t["vec_id"].to_numpy().astype("<i8").tobytes()],
                         "labels": [t["label"].to_numpy().astype("<i8").tobytes()], "wide": [is_wide],
                         "columns": pa.array([[np.ascontiguousarray(c).tobytes() for c in x.T]], pa.list_(pa.binary()))})

    placed = rows.withColumn("block", block.cast("int"))
    return materialize(placed.groupBy("dim", "block").applyInArrow(lay, FILE), "vertical-file"), narrow + wide


def _block(row: dict) -> Block:
    kind = "<f8" if row["wide"] else "<i4"
    columns = [np.frombuffer(c, kind) for c in row["columns"]]
    return Block(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), [scaled(c) for c in columns] if row["wide"] else columns)


def _scan_all(file: DataFrame, blocks: int, anchors: DataFrame, anchor_block: int, answers: Callable) -> DataFrame:
    """``answers(block, anchor, q)`` gives (w, vec_id, score) of each anchor in each block."""
    a_blocks = max(1, -(-anchors.count() // anchor_block))
    asked = (anchors.withColumn("a_block", F.pmod(F.xxhash64("aid"), F.lit(a_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1)))))
    laid = file.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1))))

    def search(f: pa.Table, q: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if f.num_rows and q.num_rows:
            block = _block(f.to_pylist()[0])
            for anchor in q.to_pylist():
                for w, vec_id, score in answers(block, anchor, scaled(np.array(anchor["x"], float))):
                    out.append((anchor["aid"], w, vec_id, *place_of(int(score))))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["aid", "w", "vec_id", "score", "place"])

    keys = ["dim", "a_block", "block"]
    return laid.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("place"), F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         file_block: int = 8192, anchor_block: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of (vec_id, embedding, label) that
    ``is_anchor`` (over vec_id and label) marks and each of its ``positives`` best other rows of the same label, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score, ranked from 1.

    Scores are inner products of floor(256 * x); higher ones first, ties to smaller vec_id. A row is no candidate of an anchor
    with its own vec_id. Rows that repeat a vec_id are each a candidate and each an anchor (equal ones one anchor). Vectors of different
    lengths do not meet. An anchor without positives, and a positive whose window is empty, has no rows. See ``usable`` for rows
    that take no part; other columns are ignored. A score that 64 bits cannot hold is null, its row and rank are right.
    """
    ship_package(rows.sparkSession)
    fine = usable(rows)
    file, blocks = vertical_file(fine, file_block)
    anchors = materialize(fine.filter(is_anchor).select("vec_id", "label", "x", "dim").dropDuplicates()
                          .withColumn("aid", F.monotonically_increasing_id()), "anchors")

    def same_label(block: Block, anchor: dict, q: np.ndarray):
        bitmap = (block.labels == anchor["label"]) & (block.ids != anchor["vec_id"])
        found, score = block.scan(q, bitmap, among_best(positives))
        return ((0, i, s) for i, s in best(block.ids[found], score, positives))

    first = _first(_scan_all(file, blocks, anchors, anchor_block, same_label), ["aid"], positives)
    per_score = Window.partitionBy("aid").orderBy(F.desc("place"), F.desc("score"))
    first = materialize(first.select("aid", F.col("vec_id").alias("positive_id"), "score", "place", F.dense_rank().over(per_score).alias("w")), "positives")
    windows = first.groupBy("aid").agg(F.collect_set(F.struct("w", "score", "place")).alias("windows"))

    def other_labels(block: Block, anchor: dict, q: np.ndarray):
        spans = {w["w"]: window_of(score_of(w["score"], w["place"]), low, high) for w in anchor["windows"]}
        spans = {w: s for w, s in spans.items() if s[0] <= s[1]}
        if not spans:
            return
        bitmap = (block.labels != anchor["label"]) & (block.ids != anchor["vec_id"])
        found, score = block.scan(q, bitmap, in_windows(list(spans.values()), negatives))
        for w, (least, most) in spans.items():
            inside = (score >= least) & (score <= most)
            for i, s in best(block.ids[found][inside], score[inside], negatives):
                yield w, i, s

    second = _first(_scan_all(file, blocks, anchors.join(windows, "aid"), anchor_block, other_labels), ["aid", "w"], negatives)
    second = second.select("aid", "w", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (first.join(second, ["aid", "w"]).join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"))


def turned_labels(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The rows with the label of every ``every``-th id moved on by one."""
    label = F.col("label").cast("long")
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
      FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
      WHERE p.place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
