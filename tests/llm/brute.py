"""Plain references for the training-data operators: small inputs only."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def substring(rows: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple[int, int, str]]:
    words = {d: WORD.findall(t or "") for d, t in rows}
    least: dict[tuple, int] = {}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(d, least.get(key, d))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def suffix(rows: list[tuple[int, str | None]], window: int = 400) -> dict[int, tuple[int, int, int, str]]:
    data = {d: (t or "").encode() for d, t in rows}
    seen: dict[bytes, int] = defaultdict(int)
    for b in data.values():
        for i in range(len(b) - window + 1):
            seen[hashlib.blake2b(b[i:i + window], digest_size=16).digest()] += 1
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[hashlib.blake2b(b[i:i + window], digest_size=16).digest()] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def classes(rows: list[tuple[int, str | None]], k: int = 4, threshold: int = 85) -> dict[int, tuple[int, int]]:
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for d, s in sets.items():
        both: dict[int, int] = defaultdict(int)
        for x in s:
            for e in where[x]:
                both[e] += e > d
        for e, n in both.items():
            if n and 100 * n >= threshold * (len(s) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def token_rows(rows, path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    at, out = 0, {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out[d] = (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    return out


def bpe_rows(rows, path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    out = {}
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out[d] = (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(t.decode(ids, skip_special_tokens=False)))
    return out


def auc(score, label) -> float:
    import pandas as pd
    r = pd.Series(score).rank()
    pos = [i for i, y in enumerate(label) if y == 1]
    n = len(label) - len(pos)
    return (sum(r[i] for i in pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * n)
