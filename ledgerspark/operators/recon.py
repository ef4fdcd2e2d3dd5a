"""Joins, dedupe, set operations, latest-row and last-n, and the two-sided
reconciliation (J1-J4, A1-A4, O1-O4, U1-U3).

Join strategy is left to Catalyst + AQE: dimension sides below
``spark.sql.autoBroadcastJoinThreshold`` (a size Spark measures) are
broadcast, everything else sort-merges on the key, and AQE splits skewed
partitions at run time. No hint here forces a broadcast of an unmeasured side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_chain(base: DataFrame, steps) -> DataFrame:
    """Inner equi-join chain. ``steps`` = [(frame, condition-or-columns, how)]."""
    out = base
    for step in steps:
        frame, on = step[0], step[1]
        how = step[2] if len(step) > 2 else "inner"
        out = out.join(frame, on, how)
    return out


def dedupe(df: DataFrame) -> DataFrame:
    """A1/A2: SELECT DISTINCT / GROUP BY every column."""
    return df.distinct()


def group_max(df: DataFrame, keys) -> DataFrame:
    """A3: group by ``keys`` and take max() of every other column."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in others])


def members(df: DataFrame, dim: str) -> DataFrame:
    """A4: distinct members of the dimension."""
    return df.select(dim).distinct()


def latest_by(df: DataFrame, keys, order_cols) -> DataFrame:
    """O1: the row with the greatest ``order_cols`` per key (ties broken by the
    later columns of ``order_cols``). One partial aggregation with ``max_by``;
    no sort of whole groups, so a hot key costs one running maximum."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    best = df.groupBy(*keys).agg(F.max_by(packed, order).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def top_n(df: DataFrame, n: int) -> DataFrame:
    """O2: any n rows (TOP (n) / LIMIT n without ORDER BY)."""
    return df.limit(n)


def last_n(df: DataFrame, keys, order_col: str, n: int, keep_last: bool = True) -> DataFrame:
    """The last ``n`` rows per key by ``order_col`` (or all but the last n).

    A per-key window: meant for frames already reduced to one row per period
    (series), where a key holds at most its number of periods."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order_col).desc()))
    cond = (F.col("_rn") <= n) if keep_last else (F.col("_rn") > n)
    return df.withColumn("_rn", rn).filter(cond).drop("_rn")


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.union, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """UNION (distinct) by position; NULLs compare equal."""
    return union_all(*dfs).distinct()


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Row concatenation by column name; missing columns become NULL.
    Columns whose types differ between frames are carried as text, the way a
    pandas object column keeps both."""
    types: dict[str, set] = {}
    for df in dfs:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType)
    unlike = {n for n, ts in types.items()
              if len(ts) > 1 and not all(isinstance(t, T.NumericType) for t in ts)}
    fixed = [df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in unlike else F.col(f"`{c}`")
                         for c in df.columns]) for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fixed)


def key_by(rule: str) -> Callable[[Column], Column]:
    """How two keys are compared: ``exact``, ``lower`` (letters without case), or a collation of Spark by name, such as
    ``UNICODE_CI_AI`` (without case and accents, what many databases do unasked)."""
    if rule == "exact":
        return lambda c: c
    if rule == "lower":
        return F.lower
    return lambda c: F.collate(c, rule)


#: Rows of a key that are left together unasked: Spark by itself cuts a key only by its size in bytes, which says little of its pairs.
MOST_OF_A_KEY = 2_000
#: Pairs of parts that a key is cut into before its parts grow beyond ``split_rows``, to LARGEST_PART rows at most: each row is copied
#: once for every part of the other side, so small parts of a large key would cost more to deal out than their pairs.
PAIRS_OF_PARTS = 4096
LARGEST_PART = 20_000


def _split_hot(w: DataFrame, a: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_i`` and ``_j`` to join on besides ``_k``. A key with more than ``most`` rows on a side is cut there into parts of
    about that many rows, and every part meets every part of the other side: (i, j) is one task's share of the key's
    pairs. Parts of a key with more than ``PAIRS_OF_PARTS`` of these are larger, up to ``LARGEST_PART`` rows. ``_met`` marks rows of
    cut keys that both sides have: they meet rows of the other side in some part. Rows without a key meet none and are spread.

    The list of cut keys has at most one entry per ``most`` rows."""
    def counts(df: DataFrame, n: str) -> DataFrame:
        return df.filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.count(F.lit(1)).alias(n))

    n, m = F.coalesce("_n", F.lit(0)), F.coalesce("_m", F.lit(0))
    part = F.least(F.greatest(F.lit(most), F.ceil(F.sqrt(n) * F.sqrt(m) / PAIRS_OF_PARTS ** 0.5)), F.lit(max(most, LARGEST_PART)))
    hot = (counts(w, "_n").join(counts(a, "_m"), "_k", "full").filter((n > most) | (m > most))
           .select("_k", F.greatest(F.ceil(n / part), F.lit(1)).alias("_is"), F.greatest(F.ceil(m / part), F.lit(1)).alias("_js"),
                   ((n > 0) & (m > 0)).alias("_met")))

    def cut(df: DataFrame, own: str, other: str, own_parts: str, other_parts: str) -> DataFrame:
        h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != "_k"])
        one = F.lit(1).cast("long")
        return (df.join(hot, "_k", "left").withColumn("_met", F.coalesce("_met", F.lit(False)))
                .withColumn(own, F.when(F.col("_k").isNull(), h).otherwise(F.pmod(h, F.coalesce(F.col(own_parts), one))))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other_parts), one) - 1)))
                .drop("_is", "_js"))

    return cut(w, "_i", "_j", "_is", "_js"), cut(a, "_j", "_i", "_js", "_is")


def reconcile(wms: DataFrame, ax: DataFrame, key_wms: str = "wms_key", key_ax: str = "ax_key", rule: str = "exact",
              split_rows: int | None = MOST_OF_A_KEY) -> DataFrame:
    """(wms LEFT JOIN ax) UNION (ax LEFT JOIN wms) on the key, DISTINCT. Keys are compared by ``rule`` (see ``key_by``); rows keep
    their keys as they are.

    Each side is deduplicated first (the union is distinct anyway; the dedupe
    is a partial aggregation over all columns, so a hot key still spreads over
    many tasks). No final DISTINCT is needed: matched pairs, WMS rows and ERP
    rows without a match are disjoint and each is already distinct.

    A key that has more rows than ``split_rows`` on either side is cut there, and its pairs spread over as many tasks as there are
    pairs of parts (``_split_hot``). The ERP rows of a part are joined as one row that holds them all, so the full outer join is as
    long as the sides are, and pairs are made by the ``inline`` on top of it: a plain loop, compiled into one piece with what reads
    the pairs. The union of two joins would write every pair as a row first.

    None leaves all keys whole and holds no rows together: one left outer join yields the matched pairs and the
    unmatched WMS rows (NULL keys included), and the ERP rows without a match
    come from an anti join against the distinct WMS keys -- a key-only
    shuffle. AQE can split a skewed key on the (larger, detailed) WMS side,
    by its bytes, which it cannot do for a full outer join.
    """
    w, a = wms.distinct(), ax.distinct()
    compared = key_by(rule)
    w_k = w.withColumn("_k", compared(F.col(f"`{key_wms}`")))
    a_k = a.withColumn("_k", compared(F.col(f"`{key_ax}`")))
    w_cols, a_cols = [F.col(f"`{c}`") for c in w.columns], [F.col(f"`{c}`") for c in a.columns]
    if split_rows is not None:
        # dealt by number: few bytes make many pairs, so tasks are not to be merged by their bytes
        on, n = ["_k", "_i", "_j"], int(w.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        w_part, a_part = (df.repartition(n, *on) for df in _split_hot(w_k, a_k, split_rows))
        a_part = a_part.groupBy(*on).agg(F.collect_list(F.struct(*a_cols)).alias("_rows"), F.first("_met").alias("_a_met"))
        # a part of a cut key may meet a part without rows: its own rows are matched in other parts
        both = w_part.join(a_part, on, "full").filter(
            (F.col("_met").isNotNull() & F.col("_rows").isNotNull()) | ~F.coalesce("_met", "_a_met"))
        return both.select(*w_cols, F.inline_outer("_rows"))
    # same plan as what the left join reads of the ERP side, so its key shuffle is reused below
    a_k = a_k.filter(F.col("_k").isNotNull())
    left = w_k.join(a_k, w_k["_k"] == a_k["_k"], "left")
    w_keys = w_k.select("_k").filter(F.col("_k").isNotNull()).distinct()
    only_a = a_k.join(w_keys, "_k", "left_anti").select(*a_cols).unionByName(a.filter(F.col(f"`{key_ax}`").isNull()))
    w_nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in w.schema.fields]
    right = only_a.select(*w_nulls, *a_cols)
    return left.select(*w_cols, *a_cols).unionByName(right)


def fulfilment_columns(ax_pallet: Column, wms_pallet: Column, ax_date: Column, wms_date: Column):
    """P7 + P9: ``pipeline_date``, ``is_fulfill`` and the status text (first
    match wins)."""
    is_fulfill = F.when(wms_pallet.isNull() | ax_pallet.isNull(), 0).otherwise(1)
    status = (F.when(ax_pallet.isNull() & wms_pallet.isNotNull(), "Open - In WMS")
              .when(wms_pallet.isNull(), "In AX - Not in WMS")
              .otherwise("Fulfilled"))
    return (F.coalesce(ax_date, wms_date).alias("pipeline_date"), is_fulfill.alias("is_fulfill"),
            status.alias("Order_Fulfilled_Status"))
