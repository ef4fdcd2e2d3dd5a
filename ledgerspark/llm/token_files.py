"""Token ids in bit-plane-shuffled binary files.

File layout (little endian)::

    magic "BPLN1\\0\\0\\0" | blocks... | chunk index | document index | footer

    block           ids of one fixed-size block (the last may be shorter), transposed into bit or byte planes, each
                    plane compressed with zstandard on its own
    chunk index     per block: ids (u32), planes (u32), then per plane its offset (u64) and length (u32)
    document index  zstandard of: doc ids (i64), ids per document (u64)
    footer          offset of the chunk index, of the document index, blocks, documents, ids, plane bits (u64 each)

One shard file is written per range partition of doc_id, so shards in order hold the documents in ascending doc_id
order; ids before a document are the totals of earlier shards plus those before it in its own shard. A task writes
its file under a name of its own attempt and then renames it, so a lost or repeated attempt never leaves half a
shard behind. Executors write through ``pyarrow.fs`` (file, HDFS, S3, ...) and Spark reads back with its
binary file source.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import NULL_ID, map_arrow, materialize, public_id, scratch_path, slices

MAGIC = b"BPLN1\0\0\0"
BLOCK = 65536
MEMO = 500_000  # distinct pieces a worker keeps per generation of its memo
TEXT = 2_000_000  # bytes of text encoded at a time


# --- planes --------------------------------------------------------------------------------------

def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Transpose 32-bit ids into 32 bit planes (``bits`` 1) or 4 byte planes (``bits`` 8)."""
    columns = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if bits == 8:
        return [c.tobytes() for c in columns]
    planes = np.unpackbits(columns[:, :, None], axis=2, bitorder="little")  # byte, id, bit
    return [np.packbits(planes[b, :, i], bitorder="little").tobytes() for b in range(4) for i in range(8)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    columns = np.empty((4, n), np.uint8)
    if bits == 8:
        for b in range(4):
            columns[b] = np.frombuffer(planes[b], np.uint8)
    else:
        for b in range(4):
            rows = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes[8 * b:8 * b + 8]]
            columns[b] = np.packbits(np.stack(rows, 1), axis=1, bitorder="little")[:, 0]
    return np.ascontiguousarray(columns.T).view("<u4").reshape(-1)


class Writer:
    """Writes one shard; holds one block of ids and the indexes."""

    def __init__(self, sink, bits: int = 8, block: int = BLOCK, level: int = 1):
        self.sink, self.bits, self.block = sink, bits, block
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.at, self.rest, self.held = len(MAGIC), [], 0
        self.chunks, self.doc_ids, self.sizes = [], [], []
        sink.write(MAGIC)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.extend([doc_id], [len(ids)], ids)

    def extend(self, doc_ids: list[int], sizes: list[int], ids: np.ndarray) -> None:
        """Documents whose ids follow each other in ``ids``."""
        self.doc_ids += doc_ids
        self.sizes += sizes
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.rest)
            for i in range(0, len(ids) - self.block + 1, self.block):
                self._put(ids[i:i + self.block])
            self.rest = [ids[len(ids) - len(ids) % self.block:]]
            self.held = len(self.rest[0])

    def _put(self, ids: np.ndarray) -> None:
        entry = [len(ids)]
        for plane in to_planes(ids, self.bits):
            data = self.compress(plane)
            self.sink.write(data)
            entry += [self.at, len(data)]
            self.at += len(data)
        self.chunks.append(entry)

    def close(self) -> int:
        if self.held:
            self._put(np.concatenate(self.rest))
        chunk_at, index = self.at, bytearray()
        for n, *planes in self.chunks:
            index += np.array([n, len(planes) // 2], "<u4").tobytes()
            for at, size in zip(planes[::2], planes[1::2], strict=True):
                index += np.array([at], "<u8").tobytes() + np.array([size], "<u4").tobytes()
        docs = self.compress(np.array(self.doc_ids, "<i8").tobytes() + np.array(self.sizes, "<u8").tobytes())
        total = int(sum(self.sizes))
        foot = np.array([chunk_at, chunk_at + len(index), len(self.chunks), len(self.doc_ids), total, self.bits], "<u8")
        self.sink.write(bytes(index) + docs + foot.tobytes())
        return total


class Reader:
    """Reads a shard; ``block`` decompresses one block only."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.data = memoryview(data)
        chunk_at, doc_at, chunks, docs, self.total, self.bits = (int(x) for x in np.frombuffer(data, "<u8", 6, len(data) - 48))
        self.expand = zstandard.ZstdDecompressor().decompress
        self.chunks, at = [], chunk_at
        for _ in range(chunks):
            n, planes = (int(x) for x in np.frombuffer(data, "<u4", 2, at))
            at += 8
            entry = []
            for _ in range(planes):
                entry.append((int(np.frombuffer(data, "<u8", 1, at)[0]), int(np.frombuffer(data, "<u4", 1, at + 8)[0])))
                at += 12
            self.chunks.append((n, entry))
        raw = self.expand(self.data[doc_at:len(data) - 48])
        self.doc_ids, self.sizes = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "<u8", docs, 8 * docs).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        n, planes = self.chunks[i]
        return from_planes([self.expand(self.data[at:at + size]) for at, size in planes], n, self.bits)

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """Documents in order, holding no more blocks than one document spans."""
        rest, i = np.empty(0, np.uint32), 0
        for doc, size in zip(self.doc_ids.tolist(), self.sizes.tolist(), strict=True):
            if len(rest) < size:
                parts, have = [rest], len(rest)
                while have < size:
                    parts.append(self.block(i))
                    have += len(parts[-1])
                    i += 1
                rest = np.concatenate(parts)
            yield doc, rest[:size]
            rest = rest[size:]


# --- encoding ------------------------------------------------------------------------------------

def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Memo:
    """Values by key in two generations: what is used survives, the rest goes, memory is bounded."""

    def __init__(self, most: int = MEMO):
        self.most, self.new, self.old = most, {}, {}

    def fill(self, keys: set, make) -> dict:
        """The dict that holds all ``keys``; ``make(list)`` gives the values of unknown ones."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        unknown = []
        for k in keys.difference(new):  # set against dict: only the keys are gone through
            v = old.get(k)
            if v is None:
                unknown.append(k)
            else:
                new[k] = v
        if unknown:
            new.update(zip(unknown, make(unknown), strict=True))
        return new

    def values(self, keys: list, make) -> list:
        """The values of ``keys``, which are distinct, in their order; ``make`` as in ``fill``."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        out = list(map(new.get, keys))
        for i in [i for i, v in enumerate(out) if v is None] if old else ():
            v = old.get(keys[i])
            if v is not None:
                new[keys[i]] = out[i] = v
        at = [i for i, v in enumerate(out) if v is None]
        unknown = [keys[i] for i in at]
        for i, k, v in zip(at, unknown, make(unknown) if unknown else (), strict=True):
            new[k] = out[i] = v
        return out


#: Letters of every Unicode version since 5.0, which any tokenizer's pattern takes for letters, and what else ends a run of them for sure.
STABLE = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u0391-\u03A1\u03A3-\u03CE\u0400-\u0481\u0531-\u0556\u05D0-\u05EA\u0621-\u064A\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"
NO_LETTER = r"\0-@\[-`{-\x7F"


def _byte_level() -> np.ndarray:
    """The code points (UTF-16) that stand for bytes in byte-level vocabularies."""
    out = np.arange(256, dtype="<u2")
    others = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0x100 and b != 0xAD)]
    out[others] = 0x100 + np.arange(len(others))
    return out


class Encoder:
    """Ids by the tokenizers library, one call per distinct piece.

    The byte-level pre-tokenizer never joins a space with the non-space before it, so a text may be cut before each
    space that a non-space follows without changing its ids, and around a line end between non-spaces; equal pieces are
    encoded once. A piece is kept under the word after its space. Arrow cuts the texts and finds the distinct words, NumPy puts
    their ids in the order of the texts: Python meets each distinct word of a call once. Unknown words are cut
    once more behind their letters, where the pre-tokenizer cuts too, so that the library meets the letters once whatever
    follows them; they are one piece and go straight to the library's model. Texts that hold a special token's string, or one of
    the two marks that cuts are made with, are treated without the shortcut.
    """

    _SPACE, _LINE = "\0", "\1"  # marks of a cut: for the space before a word; behind it, for a line end
    _LONE_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
    _IN_RUN = re.compile(r" (?!\S)")
    _CUT = re.compile(r" (?=\S)")
    _LETTERS = re.compile(f"([{STABLE}]+)((?:[{NO_LETTER}].*)?)", re.DOTALL)
    _BYTE_LEVEL = _byte_level()

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize  # of one piece, in byte-level characters
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self.tokenizer.get_vocab_size())])  # byte-level for a space
        self.spaced, self.bare = Memo(), Memo(MEMO // 4)  # words after a space; pieces without one

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _batches(self, pieces: list[str]) -> list[bytes]:
        return [ids for i in range(0, len(pieces), 4096) for ids in self._whole(pieces[i:i + 4096])]

    def _run(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space, each with the space before it: one call for many. The first id of each word is the
        only one that begins with a space."""
        out: list[bytes] = []
        for i in range(0, len(words), 8192):
            [e] = self.tokenizer.encode_batch_fast([" " + " ".join(words[i:i + 8192])], add_special_tokens=False)
            data = packed(e.ids)
            at = (4 * np.append(np.flatnonzero(self.opens[np.frombuffer(data, "<u4")]), len(data) // 4)).tolist()
            out += [data[a:b] for a, b in zip(at, at[1:])]
        return out

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each with the space before it: each is one piece, which the model takes as it is."""
        if not words:
            return []
        space, tokenize = chr(self._BYTE_LEVEL[0x20]), self.tokenize
        pieces = self._BYTE_LEVEL[np.frombuffer(" ".join(words).encode(), np.uint8)].tobytes().decode("utf-16-le").split(space)
        ids, ends = [], [0]
        for piece in pieces:
            ids += [t.id for t in tokenize(space + piece)]
            ends.append(4 * len(ids))
        data = packed(ids)
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _unknown(self, words: list[str]) -> list[bytes]:
        """Ids of each word with the space before it, or of a line end and the word behind it."""
        known, line = self.spaced.new, self._LINE
        cuts = [m and m.groups() for m in map(self._LETTERS.fullmatch, words)]
        letters = list({c[0] for c in cuts if c}.difference(known))
        own = dict(zip(letters, self._letters(letters), strict=True))
        others = [w for w, c in zip(words, cuts) if not c]
        tails = self.bare.fill({"\n", *[c[1] for c in cuts if c], *[w[1:] for w in others if w[:1] == line]}, self._batches)
        rest = [w for w in others if w[:1] != line]
        single = [w.split() == [w] for w in rest]
        run, odd = iter(self._run(list(compress(rest, single)))), iter(self._batches([" " + w for w, one in zip(rest, single) if not one]))
        of_rest = iter([next(run if one else odd) for one in single])
        out = []
        for w, c in zip(words, cuts):
            if c:
                core, rest_of = c
                ids = own.get(core) or known[core]
                out.append(ids + tails[rest_of] if rest_of else ids)
            else:
                out.append(tails["\n"] + tails[w[1:]] if w[:1] == line else next(of_rest))
        return out

    def _marked(self, text: str) -> str | None:
        """The text with marks where it may be cut; None if it may not be."""
        if self._SPACE in text or self._LINE in text or any(s in text for s in self.special):
            return None
        if "\n" in text:
            text = self._LONE_LINE.sub(self._SPACE + self._LINE, text)
        return self._CUT.sub(self._SPACE, text) if self._IN_RUN.search(text) else text.replace(" ", self._SPACE)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        marked = [self._marked(t) for t in texts]
        cut = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), self._SPACE)
        first = np.asarray(cut.offsets, np.int64)
        coded = cut.flatten().dictionary_encode()
        at, words = np.array(coded.indices), coded.dictionary
        opening = words.take(pa.array(at[first[:-1]])).to_pylist()
        heads = self.bare.fill({h for h, m in zip(opening, marked) if m is not None}, self._batches)
        heads = [heads[h] if m is not None else self._whole([t])[0] for t, h, m in zip(texts, opening, marked)]
        at[first[:-1]] = len(words) + np.arange(len(texts))  # a text's first piece has no space before it
        used = np.bincount(at, minlength=len(words) + len(texts)) > 0
        names = words.filter(pa.array(used[:len(words)])).to_numpy(zero_copy_only=False).tolist()
        values = self.spaced.values(names, self._unknown) + heads
        at = (np.cumsum(used) - 1)[at]
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        own = size[at]
        ends = np.append(0, np.cumsum(own))
        take = np.repeat((np.cumsum(size) - size)[at] - ends[:-1], own)
        take += np.arange(len(take))
        return np.frombuffer(b"".join(values), "<u4")[take], np.diff(ends[first])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        ids, sizes = self.ids(texts)
        data, ends = ids.tobytes(), np.append(0, 4 * np.cumsum(sizes)).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- Spark ---------------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, bits: int = 8, block: int = BLOCK,
                 shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, write shard files into ``folder``, and return the
    manifest (shard, path, docs, ids), one row per shard.

    A null text is empty; a null doc_id sorts first; rows that repeat a doc_id are documents of their own, ordered by
    text. An empty table writes no shard. Other columns are ignored.
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(n, "did").sortWithinPartitions("did", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        shard = TaskContext.get().partitionId()
        fs.create_dir(base, recursive=True)
        name, attempt = f"{base}/shard-{shard:08d}.bpln", f"{base}/_attempt-{uuid.uuid4().hex}"
        enc, out, count, sink = encoder(tokenizer), None, 0, None
        for batch in batches:
            for part in slices(batch, most=TEXT):
                if out is None:
                    sink = fs.open_output_stream(attempt)
                    out = Writer(sink, bits, block)
                ids, sizes = enc.ids(part.column("text").to_pylist())
                out.extend(part.column("did").to_pylist(), (sizes + 1).tolist(), np.insert(ids, np.cumsum(sizes), end_id))
                count += len(sizes)
        if out is not None:
            total = out.close()
            sink.close()
            try:
                fs.move(attempt, name)
            except OSError:  # stores that do not replace: an earlier attempt wrote the same shard whole
                if fs.get_file_info(name).type != pyarrow.fs.FileType.File:
                    raise
                fs.delete_file(attempt)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name], "docs": pa.array([count], pa.int64()), "ids": pa.array([total], pa.int64())})

    return materialize(map_arrow(rows, write, "shard int, path string, docs long, ids long"), "token-manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the shards back: did, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                shard = int(path.rsplit("shard-", 1)[1].split(".")[0])
                file = Reader(content.as_buffer().to_pybytes())
                crc = [zlib.crc32(ids.tobytes()) for _, ids in file.documents()]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, shard, np.int32)), pa.array(file.doc_ids.astype(np.int64)),
                    pa.array(np.cumsum(file.sizes) - file.sizes), pa.array(file.sizes), pa.array(crc, pa.int64())],
                    ["shard", "did", "at", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bpln").load(folder).select("path", "content")
    rows = map_arrow(files, read, "shard int, did long, at long, n_tokens long, ids_crc32 long")
    # one row per shard: offsets are a running sum over the manifest
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return rows.join(offsets, "shard").select("did", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the token files into a new folder of the shared scratch space and return doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, tokenizer, **options)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    out = read_tokens(manifest, folder)
    return out.select(public_id("did").alias("doc_id"), "start", "n_tokens", "ids_crc32")
