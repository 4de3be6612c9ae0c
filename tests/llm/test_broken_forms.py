"""The network of personal data on forms that the base patterns miss, trained on the smallest tables."""

import collections
import random
import re

import pytest

from onomata.llm import pii

SF = "/root/testdata/sf0.01"
WORDS = "river stone window garden letter morning bridge silver candle forest market harbor winter lantern".split()


def luhn_number(r, size=16):
    while True:
        x = "".join(str(r.randrange(10)) for _ in range(size))
        if pii.luhn(x):
            return x


def unseen(kind, r):
    """A broken form with names and digits of its own."""
    digits = lambda n: "".join(str(r.randrange(10)) for _ in range(n))
    if kind == 0:
        local, domain, tld = r.choice(WORDS) + r.choice(["", ".j", "7", "_k"]), r.choice(WORDS), r.choice(["com", "org", "net", "fr"])
        return r.choice([f"{local} (at) {domain}.{tld}", f"{local}[at]{domain}.{tld}", f"{local} @ {domain}.{tld}", f"{local}(at){domain}(dot){tld}", f"{local} [at] {domain} [dot] {tld}"])
    if kind == 1:
        return r.choice([" . ", "[.]", ". ", "(.)", " ."]).join(str(r.randrange(1, 255)) for _ in range(4))
    if kind == 2:
        x = luhn_number(r)
        return r.choice([".", "/", "_", " - ", "  "]).join(x[k : k + 4] for k in range(0, 16, 4))
    return r.choice([f"+ {r.randrange(10, 99)} {digits(3)} {digits(6)}", f"(0{r.randrange(10, 99)}) {digits(4)}-{digits(5)}", f"00{r.randrange(10, 99)} {digits(3)} {digits(7)}", f"0{digits(3)}/{digits(7)}", f"+{r.randrange(10, 99)}/{digits(3)}/{digits(6)}"])


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_finds_unseen_broken_forms(tagger):
    r = random.Random(5)
    texts, wanted = [], []
    for k in range(400):
        kind = k % 4
        before, after = (" ".join(r.choice(WORDS) for _ in range(r.randrange(3, 30))) for _ in range(2))
        span = unseen(kind, r)
        texts.append(f"{before} {span} {after}")
        wanted.append((len(before) + 1, kind, len(before) + 1 + len(span)))
    caught = collections.Counter()
    for text, (a, kind, b), added in zip(texts, wanted, pii.network_spans(texts, tagger), strict=True):
        assert (a, kind, b) not in pii.base_spans(text)
        spans = pii.all_spans(text, added)[1]
        # The kind, and all but a fifth of the span at most.
        caught[kind] += any(k == kind and min(b, y) - max(a, x) >= 0.8 * (b - a) and y - x <= 1.3 * (b - a) for x, k, y in spans)
    assert sum(caught.values()) >= 0.9 * len(texts), caught
    assert min(caught.values()) >= 0.8 * len(texts) / 4, caught


def test_adds_nothing_to_clean_documents(spark, tagger):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    clean = [t for t in texts if t and not pii.base_spans(t)]
    assert len(clean) > 800
    r = random.Random(9)
    numbers = [f"{r.choice(WORDS)} {x} {r.choice(WORDS)}" for x in ("version 2.0.13", "page 12", "in 1999, 2004 and 2010", "3,141 of 2,718", "1.5 to 2.75", "room 101", "at 10:45", "4 x 100 m", "chapter 3.2.1", "50 % of 12") for _ in range(20)]
    found = pii.network_spans(clean + numbers, tagger)
    assert sum(map(len, found)) == 0


def test_base_spans_stay(spark, tagger):
    rows = [t for t in (r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()) if t and pii.base_spans(t)]
    for text, added in zip(rows, pii.network_spans(rows, tagger), strict=True):
        base, both = pii.all_spans(text, added)
        assert base == pii.base_spans(text) and set(base) <= set(both)


def test_copies_keep_their_kind():
    sample = ["mail ann.lee@example.org or +49 170 5551234 now", "host 10.20.30.40 paid by 4111 1111 1111 1111 today", "no such thing 12"]
    made = pii.copies(sample)
    assert len(made) == 4 * pii.COPIES
    for text, spans in made:
        a, kind, b = spans[0]
        digits = sum(c.isdigit() for c in text[a:b])
        assert 0 <= a < b <= len(text) and (digits >= 4 or kind in (0, 1))
        assert kind != 0 or re.search(r"@|at", text[a:b], re.IGNORECASE)
    assert pii.copies(sample) == made  # trained alike every time
    assert pii.copies(["nothing here"]) == [] and pii.network_spans(["a 12 b"], pii.trained([])) == [[]]
