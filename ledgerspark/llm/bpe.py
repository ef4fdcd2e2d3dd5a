"""BPE encoding by backtracking, decoding by an offset table.

Encoding: an Aho-Corasick automaton over the vocabulary finds, in one pass over a word, the longest token that
starts at each position. Tokens are taken greedily; a token may follow another only if the pair is compatible, i.e. if
merging their characters in rank order gives exactly these two tokens. When no token fits, the last one is given
back for its longest shorter prefix token, and the position is marked as a dead end. Every prefix of a word has one
encoding, so each position is entered once and the work is linear; a sequence whose neighbours are all compatible is
the one that the merges produce.

Compatibility: at the border of two tokens stand, at any time of the merging, one piece of the left token's right
spine and one of the right token's left spine. The border is crossed if a merge of two such pieces comes before the
merges that take them into their own tokens (on equal ranks the merge further left goes first).

Decoding: all token strings lie in one buffer; ids index a table of offsets into it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import map_arrow, slices
from ledgerspark.llm.token_files import Memo, packed

END = "￿"  # stands for the end-of-word suffix inside the automaton; no token string holds it
NEVER = 1 << 60
PAIRS = 400_000  # entries of the pair-compatibility table that a worker keeps, some 50 MB
#: Entries per generation of a worker's memos, some 70 MB in all at most: workers outlive the task and keep them.
WORDS, PIECES = 100_000, 140_000


class Merges:
    """A vocabulary with ranked merges: pieces of tokens, spines, the pair-compatibility table."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        import ahocorasick
        self.vocab, self.suffix = vocab, suffix
        self.size = max(vocab.values()) + 1
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank = [-1] * self.size  # of the merge that makes a token
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.merged[a, b] = whole
            self.parts[whole] = a, b
            self.rank[whole] = rank
        self.string = {i: self._marked(t) for t, i in vocab.items()}
        self.compatible: dict[int, bool] = {}  # by left * size + right
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        usable = self._usable()
        by_string = {self.string[i]: i for i in usable}
        self.length = [0] * self.size
        self.shorter: list[int | None] = [None] * self.size
        self.automaton = ahocorasick.Automaton()
        for text, i in by_string.items():
            self.length[i] = len(text)
            self.shorter[i] = next((by_string[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_string), None)
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()

    def _marked(self, token: str) -> str:
        return token[:-len(self.suffix)] + END if self.suffix and token.endswith(self.suffix) else token

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, rank of the merge that takes it into the next larger piece), from the whole token down."""
        known = self._left if side == 0 else self._right
        if token not in known:
            spine, until = [(token, NEVER)], token
            while until in self.parts:
                taken, until = self.rank[until], self.parts[until][side]
                spine.append((until, taken))
            known[token] = spine
        return known[token]

    def _crossed(self, a: int, b: int, below: int = NEVER) -> bool:
        for x, x_taken in self._spine(a, 1):
            for y, y_taken in self._spine(b, 0):
                whole = self.merged.get((x, y))
                if whole is not None:
                    rank = self.rank[whole]
                    if rank < below and rank < x_taken and rank <= y_taken:
                        return True
        return False

    def _usable(self) -> set[int]:
        """Tokens that the merges produce from their own characters."""
        good = {i for i in self.vocab.values() if i not in self.parts}
        for whole in sorted(self.parts, key=self.rank.__getitem__):
            a, b = self.parts[whole]
            if a in good and b in good and not self._crossed(a, b, self.rank[whole]):
                good.add(whole)
        return good

    def fits(self, a: int, b: int) -> bool:
        pair = a * self.size + b
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) > PAIRS:
                self.compatible.clear()
            known = self.compatible[pair] = not self._crossed(a, b)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a word given in vocabulary characters; the end-of-word suffix is added here."""
        if self.suffix:
            word += END
        n, length, shorter = len(word), self.length, self.shorter
        longest: list[int | None] = [None] * n
        for end, token in self.automaton.iter(word):
            longest[end + 1 - length[token]] = token  # later ends overwrite earlier ones: the longest stays
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token is not None:
                to = at + length[token]
                if not dead[to] and (not out or self.fits(out[-1], token)):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at = to
                token = longest[at] if at < n else None
            else:
                if not out:
                    raise ValueError(f"the vocabulary cannot spell {word!r}")
                dead[at] = 1
                last = out.pop()
                at -= length[last]
                token = shorter[last]
        return out


class Codec:
    """A tokenizer file's normalisation, splitting and special tokens around ``Merges``, and its decoding.

    Words are separated by white space before splitting, so equal blank-separated pieces have equal ids and are
    encoded once while the memo holds them.
    """

    _ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        strings = model["vocab"] | self.special
        table = [b""] * (max(strings.values()) + 1)
        for token, i in strings.items():
            table[i] = token.encode() + b" "
        self.buffer = np.frombuffer(b"".join(table), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(t) for t in table])))
        self.words, self.pieces = Memo(WORDS), Memo(PIECES)

    def _word_ids(self, words: list[str]) -> list[bytes]:
        return [packed(self.merges.encode(w)) for w in words]

    def _split(self, piece: str) -> list[str]:
        if piece.isascii() and piece.isprintable():
            return self._ASCII.findall(piece.lower())
        return [w for w, _ in self.split(self.normalise(piece))]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        parts = [self._split(p) for p in pieces]
        get = self.words.fill(set().union(*parts), self._word_ids).__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = []
        for text in texts:
            if self.special_at is not None and self.special_at.search(text):
                cut.append([(p, p in self.special) for p in self.special_at.split(text)])
            else:
                cut.append([(text, False)])
        cut = [[self.special[p] if special else p.replace("\n", " ").split(" ") for p, special in c] for c in cut]
        keys = set().union(*[p for c in cut for p in c if isinstance(p, list)])
        get = self.pieces.fill(keys, self._piece_ids).__getitem__
        return [b"".join(packed([p]) if isinstance(p, int) else b"".join(map(get, p)) for p in c) for c in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings, one space between them, in UTF-8 (what a tokenizer without a decoder gives)."""
        if not len(ids):
            return b""
        start, size = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        at = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
        return self.buffer[at[:-1]].tobytes()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, tokenizer: str, ids: bool = True, decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian 32-bit), decoded, ids_sha256, decoded_sha256 for each row of
    ``docs`` (doc_id, text); ``ids`` and ``decoded`` are left out on request. A null text is empty (no ids); doc_id
    passes through, null and repeated ones too; other columns are ignored."""
    schema = "doc_id long, n_tokens long" + ", ids binary" * ids + ", decoded string" * decoded + ", ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            for part in slices(batch, most=1_000_000):
                raw = c.encode(part.column("text").to_pylist())
                out = {"doc_id": part.column("doc_id"), "n_tokens": pa.array([len(b) // 4 for b in raw], pa.int64())}
                plain = [c.decode(np.frombuffer(b, "<u4").astype(np.int64)) for b in raw]
                if ids:
                    out["ids"] = pa.array(raw, pa.binary())
                if decoded:
                    out["decoded"] = pa.array([p.decode() for p in plain], pa.string())
                out["ids_sha256"] = pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string())
                out["decoded_sha256"] = pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, run, schema)
