"""Helpers shared by the training-data operators: shared-folder tables, and
vectorised work on Arrow batches of text (byte views, words, rolling hashes).

Rows of text are handled as one flat byte buffer per slice, so a batch costs a
few dozen NumPy calls whatever its row count, and a slice is cut at
``SLICE_BYTES`` so that memory does not follow the batch size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ledgerspark.session import scratch_table_path, ship_package, table

SLICE_BYTES = 500_000
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id inside the operators: sorts before every other id.
NULL_ID = -(2 ** 63)
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits that tell which hashed keys a table may have: 4 MB for every task, however many keys there are.
KEY_BITS = 1 << 25
#: Rows of text a Python worker and its executor hold at once.
MOST_ROWS = 2000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, shared by driver and executors."""
    return scratch_table_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")


def few_rows(spark: SparkSession) -> str:
    """The session's rows of an Arrow batch, ``MOST_ROWS`` at most: Spark's default of 10,000 whole texts is held several times over."""
    rows = int(spark.conf.get(ARROW_ROWS, None) or 0)
    return str(min(rows, MOST_ROWS) if rows > 0 else MOST_ROWS)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside; those from before hold again behind it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage at a table that outlives any executor. The shuffle files of the write
    are removed with its end, as nothing but the table is read from then on. Arrow
    batches of the write are kept small, as rows can be long. Texts are packed with zstd: the folder is what the jobs' disk goes to."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with settings(spark, {SHUFFLE_CLEANUP: "true", ARROW_ROWS: few_rows(spark)}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table written by ``materialize`` once nothing reads it any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(did, rid, text, *more): ``did`` is doc_id with a stand-in for null, ``rid``
    tells rows that repeat a doc_id with another text apart; rows that agree in
    both are the same document stored twice and share their results."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.xxhash64(text).alias("rid"), text.alias("text"), *more)


def public_id(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NULL_ID, c)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever the case of its letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(df: DataFrame) -> list[Column]:
    """The columns of ``df``, names with dots and blanks too."""
    return [F.col(quoted(c)) for c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, MapType):
        return True
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, StructType) and any(_has_map(f.dataType) for f in kind)


def orderable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form that can be hashed and ordered: those that hold maps as JSON text."""
    return [F.to_json(F.struct(F.col(quoted(f.name)))) if _has_map(f.dataType) else F.col(quoted(f.name)) for f in df.schema]


def possible(df: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """``df`` with a boolean column ``flag`` more: false where ``key`` (a long) is not among the only column of ``keys``, true where it
    is, or where only its hash is. Rows marked false need not move to meet ``keys``; no row moves for the mark itself."""
    at, bucket, bits = fresh(df, "_at", "_bucket", "_bits")

    def place(of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(KEY_BITS)) + 1  # bitmaps begin at 1

    there = keys.select(place(F.col(quoted(keys.columns[0]))).alias(at)).select(F.bitmap_bucket_number(at).alias(bucket), F.bitmap_bit_position(at).alias(at))
    there = there.repartition(bucket).groupBy(bucket).agg(F.bitmap_construct_agg(at).alias(bits))  # at most KEY_BITS / 32768 rows
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.col(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = (byte.bitwiseAND(F.pow(F.lit(2), F.col(at) % 8).cast("int")) != 0)
    rows = df.select(*named(df), F.bitmap_bucket_number(place(key)).alias(bucket), F.bitmap_bit_position(place(key)).alias(at))
    rows = rows.join(F.broadcast(there), bucket, "left")
    return rows.select(*named(df), F.coalesce(found, F.lit(False)).alias(flag))


def without_copies(docs: DataFrame, odd: DataFrame, key: list[Column]) -> DataFrame:
    """The rows of ``docs`` without those whose ``key`` (named columns, never null) is in the written table ``odd``; but of the
    rows of a key marked ``tied`` there one stays, the smallest by all columns."""
    *on, mark, row, flag = fresh(docs, *[f"_k{i}" for i in range(len(key))], "_tied", "_row", "_flag")
    odd = odd.toDF(*on, mark)
    marked = possible(docs, key[0], odd.select(on[0]), flag)
    rows = marked.filter(flag).select(*named(docs), *[c.alias(n) for c, n in zip(key, on)])
    # most rows stay where they are: only those that may be odd move to meet the odd ones
    rest = marked.filter(~F.col(flag)).select(*named(docs)).union(rows.join(odd, on, "left_anti").select(*named(docs)))
    tied = odd.filter(F.col(mark))
    if tied.isEmpty():
        return rest
    least = F.min_by(F.struct(*named(docs)), F.struct(*orderable(docs))).alias(row)
    one = rows.join(tied.select(*on), on, "left_semi").groupBy(*on).agg(least)
    return rest.union(one.select(*[F.col(row)[c].alias(c) for c in docs.columns]))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``most`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its row offsets (nulls are empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.cast(pa.binary() if not pa.types.is_large_string(arr.type) else pa.large_binary()).fill_null(b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


# --- words ---------------------------------------------------------------------------------------

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)  # fixed: hashes must agree between tasks and runs
_MIX = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WEIGHT = _RNG.integers(1, 2 ** 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = int(_RNG.integers(1, 2 ** 62)) * 4 + 3
_BASE_INVERSE = pow(_BASE, -1, 2 ** 64)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= _STEP
    x ^= x >> np.uint64(32)
    return x


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR):
    """Starts and ends (byte positions) of the words of all rows, and the first word of each row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] |= inside[1:-1][edges]
    closes[edges - 1] |= inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (a weighted sum of random byte values)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    length = ends - starts
    at = np.arange(len(data), dtype=np.int64)
    at[:starts[0]] = 0
    at[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    weight = _WEIGHT[at & 4095]
    if length.max() > 4096:
        weight += (at >> 12).astype(np.uint64) * _STEP
    weight *= _MIX[data]
    weight[at >= np.repeat(np.append(0, length), np.diff(np.concatenate(([0], starts, [len(data)]))))] = 0
    return scramble(np.add.reduceat(weight, starts) + length.astype(np.uint64) * _STEP)


class Rolling:
    """Polynomial hashes (mod 2**64) of any range of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.inverse = np.full(n + 1, _BASE_INVERSE, np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.prefix[1:])

    def all(self, k: int) -> np.ndarray:
        """Hash of the k values from each position on."""
        m = len(self.prefix) - k
        return (self.prefix[k:] - self.prefix[:m]) * self.inverse[:m] if m > 0 else np.empty(0, np.uint64)

    def ranges(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return scramble((self.prefix[hi] - self.prefix[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64) * _STEP)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _MIX[data]


def union_length(spans: np.ndarray) -> np.ndarray:
    """Merge [start, end) rows that overlap or touch; returns sorted disjoint rows."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > reach[:-1])
    at = np.flatnonzero(first)
    return np.stack([spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]], 1)
