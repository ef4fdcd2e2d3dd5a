"""Personal data in texts, plain and disguised, with spans in the source's code points.

Plain identifiers (email, ip, card, phone) are found in the text itself. For disguised ones the text runs through a chain
of transducers:

    fold     characters that look like ASCII ones: full-width and styled forms, other scripts' digits and look-alike letters;
             invisible characters go
    spell    spelled digits in English, French, German and Spanish, ``double`` and ``triple``, ``plus``, letters
             among digits (O, l, I), and ``dot`` between digits
    address  ``[at]``, ``(dot)``, ``name at host dot com`` and the like

Each transducer writes a new text and keeps, for every character written, the source characters it came from (``Mapped``), so
a span found in the last text maps back exactly. The same detectors read the normalised text. A span found there is added
when it holds something that was rewritten, stands between characters that are no letters or digits, and overlaps no plain span of its
kind unless it contains it and is longer. Plain spans always stay.

A text is one row's work, linear in its length: no pattern starts twice within a run of characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import map_arrow, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
Edit = tuple[int, int, str]


# --- detectors -----------------------------------------------------------------------------------

_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_EMAIL_HERE = re.compile(rf"[A-Za-z0-9._%+-]++@{_DOMAIN}")
_EMAIL_NEXT = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@{_DOMAIN}")
# a run of digits can only be entered at its start: what matches from inside it matches from there too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    at = 0
    while "@" in text:
        # where the last match ended another may begin amid a run; everywhere else a run's first character decides
        m = _EMAIL_HERE.match(text, at) or _EMAIL_NEXT.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


# --- transducers ---------------------------------------------------------------------------------

class Mapped:
    """A text and, per character, the source span [start, end) that it stands for."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text)) if start is None else start
        self.end = np.arange(1, len(text) + 1) if end is None else end

    def rewrite(self, edits: list[Edit]) -> Mapped:
        """With each (start, end, replacement), in order and apart, carried out. All characters of a replacement stand for all that it replaces."""
        if not edits:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, new in edits:
            text += (self.text[at:a], new)
            start += (self.start[at:a], np.full(len(new), self.start[a]))
            end += (self.end[at:a], np.full(len(new), self.end[b - 1]))
            at = b
        text.append(self.text[at:])
        start.append(self.start[at:])
        end.append(self.end[at:])
        return Mapped("".join(text), np.concatenate(start), np.concatenate(end))

    def source(self, a: int, b: int) -> Span:
        return int(self.start[a]), int(self.end[b - 1])


# fixed values: letters and signs of other scripts that look like ASCII ones
_ALIKE = dict(zip("аеорсухіјѕһԁԛԝкАВЕКМНОРСТХУІЈЅ" "οανρικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ıɡ" "。٫‐‑‒–—−",
                  "aeopcyxijshdqwkABEKMHOPCTXYIJS" "oavpikuABEZHIKMNOPTYX" "ig" "..------", strict=True))


@lru_cache(maxsize=4096)
def folded(c: str) -> str:
    """What a character looks like in ASCII; itself if like nothing there; nothing if it is invisible."""
    if c in _ALIKE:
        return _ALIKE[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    if unicodedata.category(c) == "Cf":
        return ""
    plain = unicodedata.normalize("NFKC", c)
    return plain if plain.isascii() else c


def fold(m: Mapped) -> Mapped:
    if m.text.isascii():
        return m
    odd = [c for c in set(m.text) if not c.isascii() and folded(c) != c]
    if not odd:
        return m
    return m.rewrite([(x.start(), x.end(), folded(x.group())) for x in re.finditer(f"[{re.escape(''.join(odd))}]", m.text)])


# fixed values: digits in words
_DIGIT_WORDS = {w: str(d) for words in ("zero one two three four five six seven eight nine", "zéro un deux trois quatre cinq six sept huit neuf",
                                        "null eins zwei drei vier fünf sechs sieben acht neun", "cero uno dos tres cuatro cinco seis siete ocho nueve")
                for d, w in enumerate(words.split())} | {"oh": "0"}
_TIMES = {"double": 2, "triple": 3, "plus": 0}
_DOTS = ("dot", "point", "punkt", "punto")
_W = "|".join(sorted({*_DIGIT_WORDS, *_TIMES}, key=len, reverse=True))
_DOT = "|".join(_DOTS)
_SAID = re.compile(rf"(?<![^\W_])(?:{_W})(?![^\W_])", re.I)
_ITEM = rf"(?:[0-9]++|(?:{_W}|{_DOT})(?![^\W_]))"
# items of a spoken number: words and figures with little between them
_SPOKEN = re.compile(rf"(?<![^\W_])(?:{_W})(?![^\W_])(?:[ ,.()+-]{{1,3}}{_ITEM})+|(?<![0-9])[0-9]++(?:[ ,.()+-]{{1,3}}{_ITEM})+", re.I)
_PART = re.compile(rf"[0-9]+|(?:{_W}|{_DOT})(?![^\W_])|[^0-9A-Za-z]+", re.I)
_LETTERED = re.compile(r"(?<![A-Za-z0-9])(?=[OolI]*[0-9])[0-9OolI]{2,}(?![A-Za-z0-9])")
_LETTER_DIGITS = str.maketrans("OolI", "0011")


def _spoken(text: str, base: int) -> Iterator[Edit]:
    """Edits of one spoken number: words become figures and what stands between two items of which one is a word goes (a dot word
    becomes a dot); figures among themselves keep their separators."""
    parts = [(m.start() + base, m.end() + base, m.group()) for m in _PART.finditer(text)]
    times, was_word, gap = 1, None, None
    for a, b, part in parts:
        word = part.lower()
        if word in _TIMES and _TIMES[word]:
            new, times_next, is_word = "", _TIMES[word], True
        elif word == "plus":
            new, times_next, is_word = "+", 1, True
        elif word in _DIGIT_WORDS:
            new, times_next, is_word = _DIGIT_WORDS[word] * times, 1, True
        elif word in _DOTS:
            new, times_next, is_word = ".", 1, True
        elif part.isdigit():
            new, times_next, is_word = part[0] * (times - 1) + part, 1, False
        else:
            gap = (a, b, part)
            continue
        if gap and was_word is not None and (was_word or is_word):
            yield gap[0], gap[1], "".join(c for c in gap[2] if c in ".+")
        gap = None
        if new != part:
            yield a, b, new
        times, was_word = times_next, is_word


def spell(m: Mapped) -> Mapped:
    if _SAID.search(m.text):
        edits: list[Edit] = []
        for run in _SPOKEN.finditer(m.text):
            if _SAID.search(run.group()):
                edits += _spoken(run.group(), run.start())
        m = m.rewrite(edits)
    edits = []
    for token in _LETTERED.finditer(m.text):
        t = token.group()
        if not t.isdigit():
            edits += [(token.start() + i, token.start() + i + 1, c.translate(_LETTER_DIGITS)) for i, c in enumerate(t) if not c.isdigit()]
    return m.rewrite(edits)


_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_BRACKETED = re.compile(rf"(?<=[A-Za-z0-9]){_OPEN}(?:(at|arroba|@)|({_DOT}|\.)){_CLOSE}(?=[A-Za-z0-9])", re.I)
_BARE_AT = re.compile(r"(?<=[A-Za-z0-9])(?:[\s_-]{1,3}(?:at|arroba)[\s_-]{1,3}| ?@ ?)(?=[A-Za-z0-9])", re.I)
_LABEL = re.compile(r"[A-Za-z0-9]+(?:-(?!dot-|punkt-|point-|punto-)[A-Za-z0-9]+)*")
_BARE_DOT = re.compile(rf"[\s_-]{{1,3}}(?:{_DOT})[\s_-]{{1,3}}| \. |\.", re.I)
_HOST = re.compile(_DOMAIN)
_DOT_WORD = re.compile(rf"(?<![^\W_])(?:{_DOT})(?![^\W_])|_dot_", re.I)
# fixed values: last parts of host names that bare words may spell; prose has "at" and "dot" too
_TOP = frozenset("com org net edu gov mil int info biz io ai app dev co me tv name example test local uk de fr es eu us ch at it nl be se no dk fi pl pt ie ca au nz in jp cn br mx ru".split())


def address(m: Mapped) -> Mapped:
    text = m.text
    if any(c in text for c in "[({<"):
        m = m.rewrite([(x.start(), x.end(), "@" if x.group(1) else ".") for x in _BRACKETED.finditer(text)])
        text = m.text
    if "@" not in text and not _DOT_WORD.search(text):
        return m
    edits: list[Edit] = []
    done = 0
    for at in _BARE_AT.finditer(text):
        if at.start() < done:
            continue
        dots, spelled, taken = [], False, 0
        label = _LABEL.match(text, at.end())
        while label:
            if spelled and label.group().lower() in _TOP:
                taken, done = len(dots), label.end()
            dot = _BARE_DOT.match(text, label.end())
            label = _LABEL.match(text, dot.end()) if dot else None
            if label:
                spelled = spelled or dot.group() != "."
                dots.append((dot.start(), dot.end(), "."))
        sign = at.group().strip() == "@"
        if not taken and not (sign and _HOST.match(text, at.end())):
            continue  # a word or a sign alone says nothing
        if at.group() != "@":
            edits.append((at.start(), at.end(), "@"))
        edits += [d for d in dots[:taken] if text[d[0]:d[1]] != "."]
    return m.rewrite(edits)


TRANSDUCERS = (fold, spell, address)


def normalised(text: str) -> Mapped:
    m = Mapped(text)
    for transducer in TRANSDUCERS:
        m = transducer(m)
    return m


# --- spans ---------------------------------------------------------------------------------------

def find(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether plain) of all identifiers, by kind as listed, then start."""
    out = []
    m = normalised(text)
    for kind, detect in DETECTORS.items():
        plain = list(detect(text))
        spans = [(a, b, True) for a, b in plain]
        if m.text != text:
            spans += [(a, b, False) for a, b in _added(text, m, detect, plain)]
        out += [(kind, a, b, p) for a, b, p in sorted(spans)]
    return out


def _added(text: str, m: Mapped, detect: Callable[[str], Iterator[Span]], plain: list[Span]) -> Iterator[Span]:
    first = 0
    for a, b in detect(m.text):
        s, e = m.source(a, b)
        if text[s:e] == m.text[a:b] or (s and text[s - 1].isalnum()) or (e < len(text) and text[e].isalnum()):
            continue
        while first < len(plain) and plain[first][1] <= s:
            first += 1
        last, inside = first, True
        while last < len(plain) and plain[last][0] < e:
            inside = inside and s <= plain[last][0] and plain[last][1] <= e and plain[last] != (s, e)
            last += 1
        if inside:
            yield s, e


# --- Spark ---------------------------------------------------------------------------------------

SPANS = "array<struct<kind: string, start: long, end: long, plain: boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans for each row of ``docs`` (doc_id, text): kind, start and end (code points, end exclusive) and whether the span is
    plain or was found by deobfuscation; by kind as in ``KINDS``, then start.

    A null text is empty and has no spans; doc_id passes through, null and repeated ones too; other columns are ignored. A row is
    worked on as a whole and alone, so neither long texts nor repeated rows change another row's result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": k, "start": a, "end": b, "plain": p} for k, a, b, p in find(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, _ARROW)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with each identifier in ``text`` replaced by its kind in brackets; spans that overlap are
    replaced together, under the kind of the first. A null text stays null."""
    at = docs.columns.index("text")

    def hide(text: str) -> str:
        out, done, last = [], 0, 0
        for kind, a, b, _ in sorted(find(text), key=lambda s: (s[1], -s[2])):
            if a >= last:
                out += (text[done:a], f"[{kind.upper()}]")
            done = last = max(last, b)
        return "".join(out) + text[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                texts = pa.array([None if t is None else hide(t) for t in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([texts if i == at else part.column(i) for i in range(part.num_columns)], part.schema.names)

    return map_arrow(docs, run, docs.schema)


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def pii_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (plain ones), base_sha256 (of the plain spans), spans (all) and n_added (found by
    deobfuscation). See ``find_pii``."""
    plain = F.filter("spans", lambda s: s["plain"])
    counts = [F.size(F.filter(plain, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["plain"])).cast("long").alias("n_added")
    return find_pii(docs).select("doc_id", *counts, F.sha2(told(plain).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), added)
