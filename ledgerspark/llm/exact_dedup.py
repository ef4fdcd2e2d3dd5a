"""Exact dedup by counting quotient filters.

Every text gets a 64-bit fingerprint. Each task builds counting quotient
filters over its fingerprints: the top bits (quotient) say where a fingerprint
sits, the remaining bits (remainder) are stored in slots sorted by remainder, and
a repeat raises a counter instead of taking a slot. Since quotient and remainder
together hold the whole fingerprint, filters of different tasks merge without
loss by merging their sorted remainders. A filter is sent in pieces of equal
fingerprint ranges, so that the merge of each range is a task of its own; a
fingerprint that half of all rows share is one slot per piece.

Fingerprints counted once are unique texts. All rows of a fingerprint counted
twice or more go to byte verification: they are grouped by the text itself (map
side first), which also parts texts whose fingerprints collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import NULL_ID, drop_table, longs, map_arrow, materialize, possible, ship_package, without_copies

FILTER_ROWS = 500_000  # fingerprints per filter: bounds a task's memory, not the input


class QuotientFilter:
    """A counting quotient filter in its packed form.

    ``remainders`` holds the slots in order; ``occupied`` has a bit per quotient
    that has a run, ``runend`` a bit per slot that ends its run, and ``counts``
    the counter of each slot.
    """

    def __init__(self, q_bits: int, occupied: np.ndarray, runend: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.q_bits, self.occupied, self.runend, self.remainders, self.counts = q_bits, occupied, runend, remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> QuotientFilter:
        """From 64-bit fingerprints in any order; repeats are summed."""
        fp, at = np.unique(fingerprints, return_inverse=True)
        total = np.bincount(at, counts, len(fp)).astype(np.int64)
        q_bits = max(1, int(len(fp)).bit_length())
        shift = np.uint64(64 - q_bits)
        quotient = (fp >> shift).astype(np.int64)
        occupied = np.zeros(1 << q_bits, bool)
        occupied[quotient] = True
        runend = np.append(quotient[1:] != quotient[:-1], True)[:len(fp)]
        return cls(q_bits, occupied, runend, fp & ((np.uint64(1) << shift) - np.uint64(1)), total)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in ascending order, put together again, and their counts."""
        run = np.cumsum(np.append(0, self.runend[:-1])) if len(self.runend) else np.empty(0, np.int64)
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotient << np.uint64(64 - self.q_bits)) | self.remainders, self.counts

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        a, b = self.entries(), other.entries()
        return QuotientFilter.build(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))

    def to_bytes(self) -> bytes:
        head = np.array([self.q_bits, len(self.remainders)], np.int64)
        return b"".join(x.tobytes() for x in (head, np.packbits(self.occupied), np.packbits(self.runend), self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, blob: bytes) -> QuotientFilter:
        q_bits, n = (int(x) for x in np.frombuffer(blob, np.int64, 2))
        at = 16
        parts = []
        for kind, items, bits in ((np.uint8, 1 << q_bits, True), (np.uint8, n, True), (np.uint64, n, False), (np.int64, n, False)):
            size = (items + 7) // 8 if bits else items
            part = np.frombuffer(blob, kind, size, at)
            at += part.nbytes
            parts.append(np.unpackbits(part, count=items).astype(bool) if bits else part)
        return cls(q_bits, *parts)


def _filters(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(held: list[np.ndarray]) -> pa.RecordBatch:
            fp, count = np.unique(np.concatenate(held), return_counts=True)
            bucket = ((fp >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            ids, first = np.unique(bucket, return_index=True)
            blobs = [QuotientFilter.build(f, c).to_bytes()
                     for f, c in zip(np.split(fp, first[1:]), np.split(count, first[1:]), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "filter"])

        held, n = [], 0
        for batch in batches:
            held.append(longs(batch, "fp").astype(np.int64).view(np.uint64))
            n += batch.num_rows
            if n >= FILTER_ROWS:
                yield pieces(held)
                held, n = [], 0
        if n:
            yield pieces(held)
    return run


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Merge one range's filters; report what was counted more than once."""
    filters = [QuotientFilter.from_bytes(b) for b in group["filter"]]
    while len(filters) > 1:  # pairwise, so that every entry is merged log(filters) times
        filters = [a.merge(b) for a, b in zip(filters[::2], filters[1::2])] + filters[len(filters) & ~1:]
    fp, count = filters[0].entries()
    many = count > 1
    return pd.DataFrame({"fp": fp[many].view(np.int64), "n": count[many]})


def repeated_fingerprints(fingerprints: DataFrame, buckets: int | None = None) -> DataFrame:
    """(fp, n) for every fingerprint of the column ``fp`` that occurs more than once."""
    spark = fingerprints.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = map_arrow(fingerprints.select("fp"), _filters(buckets), "bucket int, filter binary")
    ship_package(spark)
    return pieces.groupBy("bucket").applyInPandas(_merged, "fp long, n long")


def exact_dedup(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text equals an empty one. Of
    equal texts the largest doc_id stays; a null doc_id is smaller than any other
    (a group of nulls only has a null keep_id and is kept). Rows that repeat doc_id and
    text are one document stored twice: both count in group_size, and both are
    marked kept if their doc_id is. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("fp"))
    suspects = repeated_fingerprints(rows, buckets)
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    suspects = materialize(suspects.select("fp"), "repeated-fingerprints")
    # only texts whose fingerprint may be repeated move
    likely = possible(rows, F.col("fp"), suspects, "likely").filter("likely")
    verified = (likely.join(suspects, "fp", "left_semi").groupBy("fp", "text")
                .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    # one row per verified text; written, so that texts move once and the join below meets a plain table, whose
    # skewed side Spark can split
    classes = materialize(verified.select("fp", sha, "keep_id", "group_size"), "text-classes")
    drop_table(suspects)
    out = rows.select("doc_id", "fp", sha).join(classes, ["fp", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """One row of each text, of the largest doc_id as in ``exact_dedup``, all columns unchanged. Of rows that repeat this
    doc_id and text, or all have no doc_id, one stays, the smallest by all columns."""
    copies = (exact_dedup(docs).filter("group_size > 1").groupBy("doc_id", "text_sha256")
              .agg(F.any_value("kept").alias("kept"), F.count("*").alias("rows")))
    odd = copies.filter("NOT kept OR rows > 1").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("did"), "text_sha256", F.col("kept").alias("tied"))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return without_copies(docs, materialize(odd, "dropped"), [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), sha])


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
     g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text
"""
