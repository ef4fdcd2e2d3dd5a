"""N-gram Jaccard self-join by grouped prefix join, with the classes that its links form.

Sets of word shingles are sorted by one global order, frequent shingles last. Two sets that reach the threshold
share a shingle among the first n - ceil(t n) + 1 of each (the prefix). Documents with equal sets are one set;
sets with equal size and prefix are one group; only groups are indexed by their prefix shingles. Group pairs are
filtered by size, then expanded to their members, filtered by bitmaps, and verified on the texts.

Only links that can join two classes have to be found, so the join runs in rounds: first each group is checked against its
nearest neighbours in every shingle's list (sorted by size; one scan, no pairs), the verified links form classes, and this is
repeated between classes, there against the cleanest group of each list (the one with the largest share of shared shingles; copies
with few changes all link to it). The last round takes all pairs that share enough prefix shingles and are still in different
classes. Near copies by the thousand are one class before that round, so they never meet pair by pair, and no class is lost.

The result is the classes, not the join's links: pairs inside a class are neither listed nor counted, as most of them
never meet, so neither a join's links nor a document's number of links can be read from it.

The global order needs shingle frequencies: a sketch of ``1 << SKETCH_BITS`` counters over all documents gives each shingle a
level (logarithm of its counter). Any order gives right results; this one keeps frequent shingles out of the index. It is
the only thing sent to all tasks and has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import (ARROW_ROWS, NULL_ID, drop_table, few_rows, flat, longs, lower_ascii, map_arrow, materialize, public_id,
                                    scramble, settings, slices, without_copies, word_hashes, word_spans)
from ledgerspark.llm.components import components

SKETCH_BITS = 20
BLOCKS = 64
BITMAP = 8  # 64-bit words
TEXT_BUCKETS = 1 << 20  # bounds a broadcast list of bucket numbers
#: A row is its doc_id and two hashes of its text; rows that agree in these are one text stored several times.
ROW_KEY = ("did", "t1", "t2")


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words is one shingle, one without words none."""
    data, offsets = flat(texts)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    w = word_hashes(data, starts, ends)
    joined = np.zeros(max(0, len(w) - words + 1), np.uint64)
    for j in range(words):
        joined = joined * np.uint64(0xA24BAED4963EE407) + w[j:len(joined) + j]
    joined = scramble(joined + np.uint64(words))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(joined[a:b - words + 1])
        elif b > a:
            short = np.uint64(b - a)
            for x in w[a:b]:
                short = short * np.uint64(0xA24BAED4963EE407) + x
            yield scramble(np.array([short + np.uint64(1 << 40)], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def _levels(rows: DataFrame, words: int, bits: int) -> np.ndarray:
    """Frequency level of every sketch counter: counts of all documents' shingles, summed over tasks in two steps."""
    size = 1 << bits
    per_block = size // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch):
                found = [s >> np.uint64(64 - bits) for s in shingle_sets(part.column("text"), words)]
                total += np.bincount(np.concatenate(found).astype(np.int64), minlength=size) if found else 0
        group = TaskContext.get().partitionId() % 32
        yield pa.RecordBatch.from_arrays([pa.array(np.full(BLOCKS, group, np.int32)), pa.array(np.arange(BLOCKS, dtype=np.int32)),
                                          pa.array([x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in total.reshape(BLOCKS, -1)], pa.binary())],
                                         ["part", "block", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(per_block, np.int64)
        for c in group["counts"]:
            total += np.frombuffer(c, f"u{len(c) // per_block}").astype(np.int64)
        return pd.DataFrame({"part": [0], "block": [group["block"].iloc[0]], "counts": [total.tobytes()]})

    schema = "part int, block int, counts binary"
    summed = map_arrow(rows.select("text"), count, schema).groupBy("part", "block").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    out = np.zeros(size, np.int64)
    with settings(rows.sparkSession, {ARROW_ROWS: few_rows(rows.sparkSession)}):  # whole texts go to the workers here too
        found = summed.collect()  # BLOCKS rows, 8 << bits bytes in all
    for r in found:
        out[r.block * per_block:(r.block + 1) * per_block] = np.frombuffer(r.counts, np.int64)
    return np.ceil(6 * np.log2(np.maximum(out, 1))).astype(np.uint8)


def _set_rows(words: int, threshold: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels.value, np.uint8)
        shift = np.uint64(64 - int(np.log2(len(level))))
        for batch in batches:
            for part in slices(batch):
                n, s1, s2, prefix, maps = [], [], [], [], []
                for s in shingle_sets(part.column("text"), words):
                    n.append(len(s))
                    mixed = scramble(s + np.uint64(0x51ED270B))
                    s1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    s2.append(int(np.bitwise_xor.reduce(mixed).view(np.int64)) if len(s) else 0)
                    keep = len(s) - -(-threshold * len(s) // 100) + 1 if len(s) else 0
                    order = np.argsort(level[s >> shift], kind="stable")[:keep]
                    prefix.append(s[order].view(np.int64))
                    bit = (mixed >> np.uint64(55)).astype(np.int64)
                    odd = np.bincount(bit, minlength=512) & 1
                    maps.append(np.packbits(odd.astype(bool)).view(np.int64))
                bm = np.stack(maps) if maps else np.empty((0, BITMAP), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ROW_KEY), pa.array(n, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))]
                    + [pa.array(np.ascontiguousarray(bm[:, i])) for i in range(BITMAP)], [*ROW_KEY, "n", "s1", "s2", "prefix", *(f"b{i}" for i in range(BITMAP))])
    return run


def _near(nx: str, ny: str, x: str, y: str, threshold: int):
    """Size and bitmap tests that every linked pair passes: two sets differ in at least as many shingles as their parity bitmaps
    in bits. ``nx``, ``ny`` name the sizes, ``x``, ``y`` the bitmap columns with {} for their number."""
    a, b = F.col(nx), F.col(ny)
    apart = sum((F.bit_count(F.col(x.format(i)).bitwiseXOR(F.col(y.format(i)))) for i in range(BITMAP)), F.lit(0))
    return (100 * F.least(a, b) >= threshold * F.greatest(a, b)) & ((100 + threshold) * apart <= (100 - threshold) * (a + b))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, n, g) sorted by token, n, g: adds the row before it in the same token's list, and drops tokens with one row
    (a task's first and last token may go on elsewhere and stay)."""
    opening, last, pending = None, None, None

    def settled(batch: pa.RecordBatch, keep: np.ndarray, before: np.ndarray) -> pa.RecordBatch:
        g, n = longs(batch, "g"), longs(batch, "n")
        pg, pn = np.roll(g, 1), np.roll(n, 1)
        if last is not None:
            pg[0], pn[0] = last[1], last[2]
        return pa.RecordBatch.from_arrays([batch.column("token"), batch.column("n"), batch.column("g"), pa.array(pg, mask=~before), pa.array(pn, mask=~before)],
                                          ["token", "n", "g", "pg", "pn"]).filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays([batch.column(c) for c in ("token", "n", "g")], ["token", "n", "g"])
        if pending is not None:
            batch = pa.concat_batches([pending, batch])
        token = longs(batch, "token")
        if opening is None:
            opening = token[0]
        same = token[1:] == token[:-1]
        before = np.append(last is not None and last[0] == token[0], same)
        keep = before | np.append(same, False) | (token == opening)
        most = batch.num_rows - 1  # the last row waits for the next batch
        if most:
            yield settled(batch.slice(0, most), keep[:most], before[:most])
            last = tuple(batch.column(c)[most - 1].as_py() for c in ("token", "g", "n"))
        pending = batch.slice(most)
    if pending is not None:
        yield settled(pending, np.array([True]), np.array([last is not None and last[0] == pending.column("token")[0].as_py()]))


def _linked(words: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "tx"):
                x, y = longs(part, "x"), longs(part, "y")
                linked = []
                for a, b in zip(shingle_sets(part.column("tx"), words), shingle_sets(part.column("ty"), words), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(both > 0 and 100 * both >= threshold * (len(a) + len(b) - both))
                keep = np.array(linked, bool)
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], ["x", "y"])
    return run


def _row_key() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def _classes(docs: DataFrame, words: int, threshold: int, sketch_bits: int, by_id: bool) -> tuple[DataFrame, list[DataFrame]]:
    """ROW_KEY, n, least (the smallest ROW_KEY of the row's class, null for an empty set) for each row of ``docs``, and the written
    tables that this still reads. Rows are linked by their own texts; with ``by_id`` also the rows that share a doc_id which is
    not null. Every other written table is dropped when its last reader has been written."""
    written: dict[str, list[DataFrame]] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        written.setdefault(name, []).append(materialize(df, name))
        return written[name][-1]

    def drop(*names: str) -> None:
        for name in names:
            for df in written.pop(name, []):
                drop_table(df)

    spark = docs.sparkSession
    rows = docs.select(*_row_key(), F.coalesce("text", F.lit("")).alias("text"))
    levels = spark.sparkContext.broadcast(_levels(rows, words, sketch_bits).tobytes())
    bits = [f"b{i}" for i in range(BITMAP)]
    sets = keep(map_arrow(rows, _set_rows(words, threshold, levels), "did long, t1 long, t2 long, n int, s1 long, s2 long, prefix array<long>, " + ", ".join(f"{b} long" for b in bits))
                .withColumn("p", F.xxhash64("prefix")), "sets")
    some = sets.filter("n > 0")
    # equal sets are one, numbered once; sets of equal size and prefix are one group, named by its smallest number
    reps = some.groupBy("n", "s1", "s2", "p").agg(F.min(F.struct(*ROW_KEY)).alias("least"), *[F.min(b).alias(b) for b in bits])
    reps = keep(reps.withColumn("rep", F.monotonically_increasing_id()), "distinct-sets")
    named = reps.groupBy("n", "p").agg(F.min("rep").alias("g"))
    groups = some.groupBy("n", "p").agg(F.any_value("prefix").alias("prefix")).join(named, ["n", "p"])
    members = keep(reps.join(named, ["n", "p"]).drop("p"), "members")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = groups.select(F.explode("prefix").alias("token"), "n", "g").repartitionByRange(parts, "token", "n", "g").sortWithinPartitions("token", "n", "g")
    lists = keep(map_arrow(postings, _neighbours, "token long, n int, g long, pg long, pn int"), "shared-shingles")
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") / 100) + 1
    sets = keep(sets.select(*ROW_KEY, "n", "s1", "s2"), "row-sets")  # all that is read of them from here on
    drop("sets", "distinct-sets")
    clean = keep(lists.groupBy("g", "n").agg((F.count("*") / F.any_value(prefix)).alias("clean")), "cleanness")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The linked ones of ``pairs`` (x, y). Texts are read for pairs that size and bitmaps leave over."""
        pairs = keep(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x <> y").distinct(), "pairs")
        a = members.select(F.col("rep").alias("x"), F.col("n").alias("nx"), *[F.col(c).alias("x" + c) for c in bits])
        b = members.select(F.col("rep").alias("y"), F.col("n").alias("ny"), *[F.col(c).alias("y" + c) for c in bits])
        near = keep(pairs.join(a, "x").join(b, "y").filter(_near("nx", "ny", "xb{}", "yb{}", threshold)).select("x", "y").distinct(), "near-pairs")
        ids = near.select(F.col("x").alias("rep")).unionByName(near.select(F.col("y").alias("rep"))).distinct()
        ids = keep(members.join(ids, "rep").select("rep", "least.*"), "near-ids")
        # texts whose key falls into no bucket of a key wanted are not moved; there are ``TEXT_BUCKETS`` buckets at most
        bucket = F.pmod("t1", F.lit(TEXT_BUCKETS))
        wanted = rows.withColumn("bucket", bucket).join(F.broadcast(ids.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
        # a set is read once, from one of the rows that agree in its key
        texts = wanted.groupBy(*ROW_KEY).agg(F.any_value("text").alias("text")).join(ids, list(ROW_KEY)).select("rep", "text")
        both = (near.join(texts.select(F.col("rep").alias("x"), F.col("text").alias("tx")), "x")
                .join(texts.select(F.col("rep").alias("y"), F.col("text").alias("ty")), "y"))
        links = keep(map_arrow(both, _linked(words, threshold), "x long, y long").distinct(), name)
        drop("pairs", "near-pairs", "near-ids", "mixed-tokens", "mixed-shingles", "hubs")
        return links

    def nearest(pairs: DataFrame, most: int) -> DataFrame:
        """Per left side, the partners it meets most often."""
        order = Window.partitionBy("x").orderBy(F.desc("times"), "y")
        counted = pairs.groupBy("x", "y").agg(F.count("*").alias("times"))
        return counted.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most).select("x", "y")

    def classed(links: DataFrame | None) -> DataFrame:
        own = members if links is None else members.join(components(links), F.col("rep") == F.col("id"), "left")
        cls = F.col("rep") if links is None else F.coalesce("component", "rep")
        drop("classes")
        return keep(own.select("rep", "g", "n", cls.alias("cls")), "classes")

    def mixed(classes: DataFrame) -> DataFrame:
        """The lists' rows by class, of shingles that more than one class has."""
        ends = classes.groupBy("g", "n", "cls").agg(F.min("rep").alias("rep"), F.count("*").alias("sets"))
        entries = lists.select("token", "n", "g").join(ends, ["g", "n"])
        apart = entries.groupBy("token").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a < b").select("token")
        # written: Spark can split a frequent shingle's rows against a plain table
        return keep(entries.join(keep(apart, "mixed-tokens"), "token", "left_semi"), "mixed-shingles")

    def to_hub(entries: DataFrame) -> DataFrame:
        best = F.max(F.struct("clean", F.col("rep").alias("y"), F.col("cls").alias("ycls"), F.col("n").alias("ny"))).alias("hub")
        hubs = keep(entries.join(clean, ["g", "n"]).groupBy("token").agg(best).select("token", "hub.y", "hub.ycls", "hub.ny"), "hubs")
        sized = 100 * F.least("n", "ny") >= threshold * F.greatest("n", "ny")
        return entries.join(hubs, "token").filter((F.col("cls") != F.col("ycls")) & sized).select(F.col("rep").alias("x"), "y")

    sized = (100 * F.least("n", "pn") >= threshold * F.greatest("n", "pn"))
    classes = classed(None)
    near_by = lists.filter(F.col("pg").isNotNull() & sized).select(F.col("g").alias("x"), F.col("pg").alias("y"))
    links = verified(nearest(near_by.unionByName(to_hub(mixed(classes))), 3).unionByName(members.filter("rep <> g").select(F.col("rep").alias("x"), F.col("g").alias("y"))), "links-near")
    classes = classed(links)
    links = links.unionByName(verified(nearest(to_hub(mixed(classes)), 3), "links-hub"))
    # all that is left: pairs of different classes with enough common prefix shingles, and inside groups
    classes = classed(links)
    entries = (mixed(classes).join(members.select("rep", "n", "g", *bits), ["rep", "n", "g"])
               .select("token", "n", "g", "cls", (F.col("sets") == 1).alias("one"), *bits))
    right = entries.select("token", *[F.col(c).alias(c + "2") for c in entries.columns if c != "token"])
    alone = F.col("one") & F.col("one2")  # the bitmap is that of the only member
    fit = ((F.col("cls") < F.col("cls2")) & (100 * F.least("n", "n2") >= threshold * F.greatest("n", "n2")) & (~alone | _near("n", "n2", "b{}", "b{}2", threshold)))
    # of c common prefix shingles follow at most c + the larger remainder in all
    rest = F.greatest(F.ceil(F.lit(threshold) * F.col("n") / 100), F.ceil(F.lit(threshold) * F.col("n2") / 100)) - 1
    least = F.ceil(F.lit(threshold) * (F.col("n") + F.col("n2")) / (100 + threshold)) - rest
    entry_pairs = (entries.join(right, "token").filter(fit).groupBy("g", "n", "cls", "g2", "n2", "cls2").agg(F.count("*").alias("common"))
                   .filter(F.col("common") >= least).drop("common"))
    inner = classes.select("g", "n", "cls").distinct()
    entry_pairs = entry_pairs.unionByName(
        inner.join(inner.select("g", "n", F.col("cls").alias("cls2")), ["g", "n"]).filter("cls < cls2")
        .select("g", "n", "cls", F.col("g").alias("g2"), F.col("n").alias("n2"), "cls2"))
    pairs = (entry_pairs.join(classes.withColumnRenamed("rep", "x"), ["g", "n", "cls"])
             .join(classes.select(F.col("rep").alias("y"), F.col("g").alias("g2"), F.col("n").alias("n2"), F.col("cls").alias("cls2")), ["g2", "n2", "cls2"]))
    links = links.unionByName(verified(pairs.select("x", "y"), "links-rest"))
    drop("classes", "shared-shingles", "cleanness")
    known = sets.select(*ROW_KEY, "n", "s1", "s2").join(members.select("n", "s1", "s2", "rep", "least"), ["n", "s1", "s2"], "left").drop("s1", "s2")
    if by_id:
        repeated = sets.filter(F.col("did") != NULL_ID).groupBy("did").agg(F.count("*").alias("rows")).filter("rows > 1")
        repeated = keep(repeated.select("did"), "repeated-ids")
        if not repeated.isEmpty():
            # the sets of one doc_id hang together, and its empty ones go with them
            known = keep(known, "known-sets")
            own = keep(known.join(repeated, "did").filter("rep IS NOT NULL").select("did", "rep").distinct(), "repeated-sets")
            first = own.groupBy("did").agg(F.min("rep").alias("first"))
            links = links.unionByName(own.join(first, "did").select(F.col("rep").alias("x"), F.col("first").alias("y")))
            first = first.join(members.select(F.col("rep").alias("first"), F.col("least").alias("first_least")), "first")
            known = (known.join(first, "did", "left").withColumn("rep", F.coalesce("rep", "first"))
                     .withColumn("least", F.coalesce("least", "first_least")).drop("first", "first_least"))
    found = keep(components(links).withColumnRenamed("id", "rep"), "components")
    smallest = found.join(members.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("class_least"))
    found = found.join(smallest, "component").select("rep", "class_least")
    out = known.join(found, "rep", "left").select(*ROW_KEY, "n", F.coalesce("class_least", "least").alias("least"))
    return out, [df for tables in written.values() for df in tables]


def jaccard_classes(docs: DataFrame, words: int = 4, threshold: int = 85, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text); ``threshold`` in percent.

    Texts are ASCII lower-cased; a set holds the distinct ``words``-word shingles, of a shorter text its word sequence. Null
    texts and texts without words have the empty set and link with nothing, not even each other. component_id is the smallest
    doc_id reachable by links, its own included; a null doc_id counts as smaller than any other and makes the component_id
    null. Rows that repeat a doc_id are one document with the sets of all its rows, each row with its own n_shingles; rows
    with a null doc_id are documents of their own. Empty table: empty result; other columns are ignored."""
    out, _ = _classes(docs, words, threshold, sketch_bits, True)
    return out.select(public_id("did").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      public_id(F.coalesce("least.did", "did")).alias("component_id"))


def one_of_each_class(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each class of near copies, that of the smallest doc_id (null first), all columns unchanged; rows without words
    stay. Classes are those of rows: rows that share a doc_id, or have none, are linked by their own texts only. Of rows that
    repeat doc_id and text one stays."""
    rows, written = _classes(docs, words, threshold, SKETCH_BITS, False)
    rows = rows.filter("least IS NOT NULL")
    keys = rows.groupBy(*ROW_KEY).agg(F.any_value("least").alias("least"), F.count("*").alias("rows"))
    first = F.struct(*ROW_KEY) == F.col("least")
    odd = materialize(keys.filter(~first | (F.col("rows") > 1)).select(*ROW_KEY, first.alias("tied")), "dropped")
    for df in written:
        drop_table(df)
    return without_copies(docs, odd, _row_key())
