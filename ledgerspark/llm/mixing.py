"""Mixing sources to target weights by systematic sampling.

Targets: sources in code point order (null last) carry the weights in turn, share
``share`` times all words, and no target passes ``most`` times its source's size; what
a source cannot take is shared again by weight until none is above. That fixed point
is min(cap, level * weight) with one common level, found in one pass over the sources
ordered by cap / weight.

Sampling: a document's expected copies are target / source size. Within its source the
expected copies are prefix-summed (in order of size, which spreads each size evenly over
the mix and keeps the taken words within one document's size of the target), the source's
random offset is added, and the document is emitted once per integer boundary crossed.

The prefix sum is distributed: rows are range-partitioned by (source, size, doc_id),
sorted, and written; the rank in a source is the position in the written partition plus the
source's rows in earlier partitions, so a source with a third of all rows spreads over
as many tasks as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import WORD, fresh, materialize, named, orderable

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> adds weight and target. One row per source; windows run over
    the list of sources, not over documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("rest", F.col("total") - (F.sum("cap").over(by_ratio) - F.col("cap")))
         .withColumn("weights_left", F.sum("weight").over(every) - F.sum("weight").over(by_ratio) + F.col("weight"))
         .withColumn("level", F.try_divide("rest", "weights_left")))
    # the first source that its level does not fill fixes the level of all; levels only fall after it
    s = s.withColumn("final", F.max(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))).over(every))
    return s.select("source", "source_size", "weight",
                    F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def _offset(seed: int):
    """A source's random offset in [0, 1), from a digest of its name."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for each row of ``docs``
    (doc_id, text, source); ``copies`` is how often the mix emits it.

    A null text has size 0. A null source is a source of its own, after all others.
    A source without words has target 0 and none of its documents is emitted.
    Null and repeated doc_ids are rows like any other; rows that agree in source, size
    and doc_id take neighbouring ranks. Other columns are ignored. The result
    depends on the rows and the seed only, not on partitions.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _size().alias("size"))
    return _drawn(materialize(rows, "sizes"), weights, share, most, seed)


def _size():
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0))


def _drawn(rows: DataFrame, weights: Sequence[float], share: float, most: float, seed: int, *more: str) -> DataFrame:
    """``mix`` of a written table (doc_id, source, size). Columns ``more`` pass through; they settle the order of rows that
    agree in source, size and doc_id."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), "size", "doc_id", *more]
    ranked = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    ranked = materialize(ranked, "ranked")  # positions are settled once, whatever is recomputed later
    # rows here: partitions + sources
    pieces = ranked.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    targets = source_targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    pieces = (pieces.select("part", F.col("source").alias("s"), "first", "before")
              .join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("source")
              .withColumnRenamed("part", "p"))
    joined = ranked.join(pieces, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    rank = (F.col("at") - F.col("first") + F.col("before")).cast("double")
    each = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    u = _offset(seed)
    copies = F.floor((rank + 1) * each + u) - F.floor(rank * each + u)
    return (joined.withColumn("copies", copies.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *more))


def emit(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
         seed: int = 17) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` says of this very row, all columns unchanged.
    Null and repeated doc_ids are rows like any other. Rows that agree in source, size and doc_id take their ranks by a
    hash of all columns, so that the result does not depend on partitions; between identical rows the order is of no account."""
    size, tie, row, copies, n = fresh(docs, "_size", "_tie", "_row", "_copies", "_n")
    # written once: a row's number and its columns stay together, whatever is recomputed later
    rows = materialize(docs.select(*named(docs), _size().alias(size), F.xxhash64(*orderable(docs)).alias(tie), F.monotonically_increasing_id().alias(row)), "sizes")
    sizes = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col(size).alias("size"), F.col(tie).alias("tie"), F.col(row).alias("row"))
    plan = _drawn(sizes, weights, share, most, seed, "tie", "row").filter("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    return (rows.join(plan, row).withColumn(n, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int"))))
            .select(*named(docs)))


_RATIO = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
      [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS w FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s),
r AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM c),
f AS (SELECT *, max(CASE WHEN level * w < cap THEN level END) OVER () AS final FROM r),
t AS (SELECT source, source_size, least(cap, coalesce(final * w, cap)) AS target,
      ('0x' || substr(md5('17:' || coalesce('s' || source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM f),
k AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1)::DOUBLE AS rank FROM d)
"""
ORACLE = _RATIO + """
SELECT k.doc_id, k.size, t.source_size, t.target,
       CAST(k.size * (floor((rank + 1) * coalesce(t.target / nullif(t.source_size, 0)::DOUBLE, 0) + u)
                      - floor(rank * coalesce(t.target / nullif(t.source_size, 0)::DOUBLE, 0) + u)) AS BIGINT) AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""
