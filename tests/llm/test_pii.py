"""Personal data: plain spans against the patterns as written, disguised ones planted in texts."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm import pii
from ledgerspark.session import table
from tests.conftest import SF_SMALL
from tests.llm.brute import sha

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                    or (kind == "card" and 13 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15)):
                out.append((kind, *m.span()))
    return out


def plain(text):
    return [s[:3] for s in pii.find(text) if s[3]]


def added(text):
    return [(k, text[a:b]) for k, a, b, p in pii.find(text) if not p]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-_ +01234567é()9Z%２ο", max_size=60))
def test_plain_spans_are_those_of_the_patterns(text):
    assert plain(text) == base(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "x", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (234) 555-0199", "+", "5", " ", "-", "at", "dot com", "one"]), max_size=12))
def test_plain_spans_stay_beside_added_ones(parts):
    text = "".join(parts)
    assert plain(text) == base(text)
    for kind, a, b, p in pii.find(text):
        assert 0 <= a < b <= len(text)


@pytest.mark.parametrize("said, kind", [
    ("ann.lee at mail dot example dot com", "email"), ("ann.lee [at] mail [dot] com", "email"), ("ann(at)mail(dot)example(dot)org", "email"), ("ann AT mail DOT com", "email"),
    ("ann@mail dot com", "email"), ("ann @ mail.example.com", "email"), ("ａnn＠mａil．cоm", "email"), ("a\u200bnn@ma\u00adil.com", "email"), ("ann_at_mail_dot_com", "email"),
    ("ann { arroba } mail { punto } es", "email"), ("１９２.168.0.１", "ip"), ("one nine two dot one six eight dot one dot seven", "ip"), ("192[.]168[.]0[.]1", "ip"),
    ("four one one one one one one one one one one one one one one one", "card"), ("4111 1111 1111 one one one one", "card"), ("4lll 1111 1111 1111", "card"), ("quatre un un un 1111 1111 1111", "card"),
    ("plus one two three four five five five zero one nine nine", "phone"), ("＋1 (234) 555-0199", "phone"), ("plus 1 234 triple five 0199", "phone"), ("+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨", "phone")])
def test_disguises_are_found_with_their_own_spans(said, kind):
    for text in (said, f"Écrivez à 日本 {said}, merci", f"so, {said}."):
        assert (kind, said) in added(text), pii.normalised(text).text
        assert plain(text) == base(text)


@pytest.mark.parametrize("text", ["", "look at the dot product", "meet me at noon. Com is late", "at home dot", "one two three", "f(a) at x[i].y", "été à Noël, un deux trois", "Chapter 1.2.3.4.5 at the end",
                                  "we met at example.com", "le point de vue de un at six", "See you @ noon. Then go", "O 0 l 1 I", "punto y coma, tres, cuatro", "Москва, 12 мая"])
def test_prose_is_left_alone(text):
    assert added(text) == []


def test_a_longer_span_may_contain_a_plain_one():
    assert pii.find("ann@mail.example dot com") == [("email", 0, 16, True), ("email", 0, 24, False)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "one " * 75_000, " at a dot " * 30_000, "O" * 300_000, "(" * 300_000, "a-" * 150_000 + "@"):
        pii.find(text)


def test_offsets_map_back_through_all_transducers():
    rng = random.Random(5)
    bits = ["ｆｕｌｌ", "\u200b", "plain", "one two", " [at] ", "dot", "é", "日本", "²", " "]
    for _ in range(200):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        m = pii.normalised(text)
        assert len(m.text) == len(m.start) == len(m.end)
        assert all(0 <= a < b <= len(text) for a, b in zip(m.start, m.end))
        assert (m.start[1:] >= m.start[:-1]).all() and (m.end[1:] >= m.end[:-1]).all()


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_table(spark):
    odd = [(1, "ann@mail.com and bob at mail dot com", "x", 1), (1, "ann@mail.com and bob at mail dot com", "x", 1), (None, None, None, None), (2, "", "x", 1),
           (3, "1.2.3.4 " * 3000, "x", 1), (3, "日本 +1 (234) 555-0199", "x", 1), (4, "4111 1111 1111 1111", "x", 1)]
    df = spark.createDataFrame(odd, "doc_id long, text string, spans string, n_email int")
    real = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()]
    for got, want in ((pii.pii_table(df).collect(), [r[:2] for r in odd]), (pii.pii_table(real).collect(), rows)):
        expected = []
        for d, t in want:
            spans = base(t or "")
            expected.append((d, *[sum(s[0] == k for s in spans) for k in pii.KINDS], sha(told(spans)), told([s[:3] for s in pii.find(t or "")])))
        assert sorted(map(str, [tuple(r)[:7] for r in got])) == sorted(map(str, expected))
    assert sum(r.n_email for r in pii.pii_table(real).collect()) > 0
    assert pii.pii_table(df.limit(0)).count() == 0
    out = pii.redact(df)
    assert out.schema == df.schema
    texts = sorted(str(r.text) for r in out.collect())
    assert texts == sorted(["[EMAIL] and [EMAIL]"] * 2 + ["None", "", "[IP] " * 3000, "日本 [PHONE]", "[CARD]"])
