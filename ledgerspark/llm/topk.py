"""Exact top-k search by inner product with vector-approximation (VA) files.

The file has two parts: per vector and dimension a small cell number (the quantised
approximation), and the exact integer vector. A search scans the cells only: a cell's edges
bound each coordinate from both sides, so two matrix products give an upper and a lower bound of
every score. Exact vectors are then read in the order of their bounds until the kth exact score
is no lower than the next bound.

Work is laid out in blocks: the query set (a stated share of the rows) in blocks of
``query_block``, the file in blocks of ``file_block``; a task holds one block of each and reports at
most k rows per query and kind of rows, so what reaches the final ranking is a few rows per query and file block.

All finite vectors take part. Those with a component too large for cells (``LIMIT``) are kept as doubles, and blocks whose
scores could pass 64 bits are ranked by float products with an error bound, then by exact integers of any size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialize, ship_package

CELL_BITS = 6
SCALE = 256  # a power of two: x * SCALE is exact
LIMIT = 2 ** 28  # a vector with a component beyond it after scaling has no cells
FITS = b"\1"  # place of a score of 64 bits, between the places of those below and above
PLACE_BITS = 2104  # more than any sum of up to 2 ** 31 products of scaled doubles has


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, v, w): v = floor(SCALE * x) per component, or null where a component is 2**28 or more after scaling; there w has
    floor(SCALE * x) / SCALE as doubles, which is exact. Vectors that are null or empty, or hold a null or non-finite component,
    and rows without an id take no part."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))

    fine = F.forall("embedding", finite)
    small = F.forall("embedding", lambda c: F.abs(c.cast("double")) < LIMIT / SCALE)
    v = F.transform("embedding", lambda c: F.floor(F.lit(SCALE) * c.cast("double")).try_cast("int"))
    # from 2**45 on a double times SCALE is an integer
    w = F.transform("embedding", lambda c: F.when(F.abs(c.cast("double")) < 2.0 ** 45, F.floor(F.lit(SCALE) * c.cast("double")).cast("double") / SCALE)
                    .otherwise(c.cast("double")))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
            .filter(F.coalesce(fine, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.when(small, v).alias("v"), F.when(~small, w).alias("w")))


def _cells(low: int, high: int):
    """Cell edges for every dimension: equal widths over the range of all components."""
    width = max(1, -(-(high - low + 1) // (1 << CELL_BITS)))
    return low, width


def search_block(ids, cells, exact, q_ids, queries, k: int, low: int, width: int) -> pd.DataFrame:
    """k best rows of one file block for each query of one query block (VA-file search)."""
    lower = cells.astype(np.float64) * width + low
    upper = lower + (width - 1)
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    best = up @ upper.T + down @ lower.T     # no score is above its bound
    worst = up @ lower.T + down @ upper.T    # none is below
    # rounding of 2 * dim products of at most this size each
    most = float(max(np.abs(queries).max(), 1)) * float(max(np.abs(lower).max(), np.abs(upper).max(), 1))
    slack = 1 + (2 * queries.shape[1] + 4) ** 2 * np.finfo(float).eps * most
    best, worst = best + slack, worst - slack
    own = q_ids[:, None] == ids[None, :]
    best[own], worst[own] = -np.inf, -np.inf
    out = []
    n = len(ids)
    certain = np.partition(worst, n - k, axis=1)[:, n - k] if n > k else np.full(len(q_ids), -np.inf)
    for i, q in enumerate(queries.astype(np.int64)):
        near = np.flatnonzero((best[i] >= certain[i]) & (best[i] > -np.inf))
        near = near[np.argsort(-best[i][near], kind="stable")]
        got_id, got_score = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(near), 4 * k):  # read exact vectors in bound order
            if len(got_id) >= k and got_score[k - 1] > best[i][near[at]]:
                break
            some = near[at:at + 4 * k]
            got_id = np.concatenate([got_id, ids[some]])
            got_score = np.concatenate([got_score, exact[some].astype(np.int64) @ q])
            order = np.lexsort((got_id, -got_score))[:k]
            got_id, got_score = got_id[order], got_score[order]
        out.append((np.full(len(got_id), q_ids[i]), got_id, got_score))
    cols = [np.concatenate(c) if out else np.empty(0, np.int64) for c in (zip(*out) if out else ((), (), ()))]
    return pd.DataFrame({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]}).astype("int64")


def _integers(w: np.ndarray) -> list[list[int]]:
    """SCALE * w as integers of any size."""
    fraction, whole = np.modf(w)
    return [[int(x) * SCALE + int(f * SCALE) for x, f in zip(*row)] for row in zip(whole.tolist(), fraction.tolist())]


def search_wide(ids, file, q_ids, queries, k: int) -> pd.DataFrame:
    """As ``search_block``, for vectors of any finite doubles (floor(SCALE * x) / SCALE): float products and the most that
    they can be wrong by leave few rows over, whose scores are integers of any size."""
    with np.errstate(over="ignore", invalid="ignore"):
        product = queries @ file.T
        wrong = (2 * file.shape[1] + 4) * np.finfo(float).eps * (np.abs(queries) @ np.abs(file).T)
        best, worst = product + wrong, product - wrong
    unknown = ~(np.isfinite(best) & np.isfinite(worst))
    best[unknown], worst[unknown] = np.inf, -np.inf
    own = q_ids[:, None] == ids[None, :]
    worst[own] = -np.inf
    n = len(ids)
    certain = np.partition(worst, n - k, axis=1)[:, n - k] if n > k else np.full(len(q_ids), -np.inf)
    out = []
    for i, q in enumerate(_integers(queries)):
        near = np.flatnonzero((best[i] >= certain[i]) & ~own[i])
        distinct, which = np.unique(file[near], axis=0, return_inverse=True)
        score = [sum(a * b for a, b in zip(q, row)) for row in _integers(distinct)]
        top = sorted((-score[j], d) for d, j in zip(ids[near].tolist(), which.ravel().tolist()))[:k]
        for s, d in top:
            fits = -2 ** 63 <= -s < 2 ** 63
            out.append((q_ids[i], d, -s if fits else None, FITS if fits else (2 ** PLACE_BITS - s).to_bytes(PLACE_BITS // 8 + 1, "big")))
    found = pd.DataFrame(out, columns=["query_id", "vec_id", "score", "place"])
    return found.astype({"query_id": "int64", "vec_id": "int64"}).assign(score=pd.array([r[2] for r in out], "Int64"))


def _search(f: pd.DataFrame, q: pd.DataFrame, k: int, low: int, width: int) -> pd.DataFrame:
    """k best rows of each kind (with and without cells) of one file block for each query of one query block."""
    def kinds(rows: pd.DataFrame):
        """(rows, vectors, whether they have cells)"""
        if not len(rows):
            return
        cells = rows["v"].notna()
        for own, some, column in ((True, rows[cells], "v"), (False, rows[~cells], "w")):
            if len(some):
                yield some, np.stack(some[column].to_list()), own

    out = [pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="Int64"), "place": pd.Series(dtype=object)})]
    for fs, exact, f_cells in kinds(f) if len(q) else ():
        for qs, queries, q_cells in kinds(q):
            ids, q_ids = fs["vec_id"].to_numpy(), qs["vec_id"].to_numpy()
            if f_cells and q_cells and exact.shape[1] * int(np.abs(exact.astype(np.int64)).max()) * int(np.abs(queries.astype(np.int64)).max()) < 2 ** 63:
                found = search_block(ids, np.stack(fs["cells"].to_list()), exact, q_ids, queries, k, low, width)
                out.append(found.assign(score=found["score"].astype("Int64"), place=FITS))
            else:
                file, asked = (x / SCALE if cells else x.astype(np.float64) for x, cells in ((exact, f_cells), (queries, q_cells)))
                out.append(search_wide(ids, file, q_ids, asked, k))
    return pd.concat(out, ignore_index=True) if len(out) > 1 else out[0]


def top_k(rows: DataFrame, is_query: Column, k: int = 5, query_block: int = 1024, file_block: int = 16384) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row of (vec_id, embedding) that ``is_query`` marks.

    A row is no candidate for a query of its own vec_id. Ties go to the smaller vec_id. Rows
    that repeat a vec_id: each is a candidate (and each query of that id gets the same answers once).
    Vectors of different lengths do not meet. Fewer than k candidates: all of them. See ``quantised`` for
    rows that take no part; other columns are ignored. A score that 64 bits cannot hold is null, its row and rank are right.
    """
    v = quantised(rows)
    edges = v.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.count("*").alias("n"),
                  F.sum(is_query.cast("long")).alias("q")).first()
    low, width = _cells(edges.low or 0, edges.high or 0)
    blocks, q_blocks = max(1, -(-edges.n // file_block)), max(1, -(-(edges.q or 0) // query_block))
    # vectors without cells have null ones
    cell = F.transform("v", lambda c: F.floor((c - F.lit(low)) / F.lit(width)).cast("tinyint"))
    file = materialize(v.select("vec_id", cell.alias("cells"), "v", "w", F.size(F.coalesce(F.col("v").cast("array<double>"), "w")).alias("dim"),
                                F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")), "va-file")
    queries = (file.filter(is_query).select("vec_id", "v", "w", "dim").dropDuplicates(["vec_id", "v", "w"])
               .withColumn("q_block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks)).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    left = file.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def search(f: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _search(f, q, k, low, width)

    ship_package(rows.sparkSession)
    keys = ["dim", "q_block", "block"]
    found = (left.groupBy(*keys).cogroup(queries.groupBy(*keys))
             .applyInPandas(search, "query_id long, vec_id long, score long, place binary"))
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


ORACLE = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
