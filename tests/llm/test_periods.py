from __future__ import annotations

import hashlib
import re
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saleslake.llm import periods
from saleslake.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(words, least=6, times=4):
    """All maximal matches of each lag that have no smaller period."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < n and words[end] == words[end - q]:
                end += 1
            run = words[i - q : end]
            shorter = any(run[d:] == run[:-d] for d in range(1, q))
            if len(run) >= max(least, times * q) and not shorter:
                out.append((i - q, len(run), q))
            i = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_text(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(ident, text):
    """The contract, word by word."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(ident).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(plain_text(words, runs)),
    )


def test_query_equals_the_contract_word_by_word(spark):
    texts = dict(brute.rows("documents", "doc_id, text"))
    rows = QUERIES["op13_periodic_runs"](spark, brute.SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(WORD.findall(texts[r.doc_id] or "")) <= 3000:  # the plain version takes a square of them
            assert tuple(r)[1:] == plain_row(r.doc_id, texts[r.doc_id])
    assert sum(r.n_runs > 0 for r in rows) >= 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 9), st.lists(st.integers(0, 2), max_size=4)), max_size=4))
def test_runs_of_several_texts(parts):
    texts = [[*head, *(head * times), *tail] for head, times, tail in parts]
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.array([w for t in texts for w in t], np.int64)
    begins = np.r_[0, np.cumsum(sizes)].tolist()
    expected = [(s + begin, n, q) for t, begin in zip(texts, begins, strict=False) for s, n, q in plain_runs(t)]
    assert [tuple(r) for r in periods.runs_of(codes, sizes).tolist()] == expected


def test_long_texts_of_one_word_and_of_few(spark):
    again = " ".join(f"w{i}" for i in range(5000))
    texts = {1: "a " * 300_000, 2: f"{again} " * 4, 3: "a b a a b " * 20_000}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r.periods for r in periods.collapsed(frame).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(0, 300_000, 1)] and rows[1].text == "a"
    assert [tuple(x) for x in rows[2].runs] == [(0, 20_000, 5000)] and rows[2].text == again
    assert [tuple(x) for x in rows[3].runs] == [(0, 100_000, 5)] and rows[3].text == "a b a a b"


def test_odd_rows(spark):
    rows = [(None, None, "x", 1), (1, "", "x", 1), (2, " \x0b\n", None, 2), (2, "a\xa0b " * 6, "x", 3), (2, "a\xa0b " * 6, "x", 3)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, periods string, `a.b` int").repartition(2)
    found = periods.collapsed(frame)
    assert found.columns == ["doc_id", "text", "periods", "a.b", "periods_"]
    got = sorted(([len(r[4].runs), r[4].text] for r in found.collect()))
    assert got == [[0, ""]] * 3 + [[1, "a\xa0b"]] * 2
    assert periods.collapsed(frame.limit(0)).count() == 0


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        periods.runs_of(np.zeros(3, np.int64), np.array([3]), least_periods=2)
