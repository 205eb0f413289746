from __future__ import annotations

import math
import re
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from saleslake.llm import scoring
from saleslake.llm.queries import QUERIES


def plain(docs, order=2, folds=10):
    """[(id, held out, tokens, known, N, base, score)] with dictionaries."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    texts = [[("begin",), *re.findall(r"[^\x20\x09-\x0D]+", low(t)), ("end",)] for _, t in docs]
    train = [brute.remainder(i, folds) != 0 for i, _ in docs]
    count = Counter()
    for text, own in zip(texts, train, strict=True):
        if own:
            count.update(tuple(text[i - n + 1 : i + 1]) for i in range(len(text)) for n in range(1, order + 1) if i >= n - 1)
    words = {k: c for k, c in count.items() if len(k) == 1 and k != (("begin",),)}
    total, kinds = sum(words.values()), len(words)
    every, once = Counter(), Counter()
    for text, own in zip(texts, train, strict=True):
        for n in range(2, order + 1):
            for i in range(n - 1, len(text)):
                h, g = count[tuple(text[i - n + 1 : i])], count[tuple(text[i - n + 1 : i + 1])]
                if own and h >= 2:
                    every[n, int(math.log2(h))] += 1
                    once[n, int(math.log2(h))] += g == 1

    def b(n, h):
        known = sorted(k for m, k in every if m == n)
        if not known:
            return 0.5
        k = max([x for x in known if x <= int(math.log2(h))], default=known[0])
        return min(max((once[n, k] + 0.5) / (every[n, k] + 1), 1e-4), 1 - 1e-4)

    out = []
    for (ident, _), text, own in zip(docs, texts, train, strict=True):
        base = score = known = 0
        for i in range(1, len(text)):
            c = words.get((text[i],), 0)
            known += c > 0
            p = (c + 0.1) / (total + 0.1 * (kinds + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                if i >= n - 1 and (h := count[tuple(text[i - n + 1 : i])]):
                    x = b(n, h)
                    p = (1 - x) * count[tuple(text[i - n + 1 : i + 1])] / h + x * p
            score += math.log10(p)
        out.append((ident, not own, len(text) - 1, known, total, base, score))
    return out


def assert_equal(frame, want):
    got = sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[6]))
    want = sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[6]))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == (pytest.approx(b[5], rel=1e-9), pytest.approx(b[6], rel=1e-9))


def test_query_equals_brute_force_and_beats_the_base(spark):
    frame = QUERIES["op10_lm_scoring"](spark, brute.SF)
    assert frame.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    want = plain(brute.rows("documents", "doc_id, text"))
    assert_equal(frame, want)
    assert sum(r[6] for r in want if r[1]) > sum(r[5] for r in want if r[1])


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "A b\n\na  B\x0ba b"), (4, "a b"), (None, "É é a b"), (5, "x y z " * 4000),
    (6, "x y z w"), (7, "a"), (8, "end <begin>"), (6, "x y z w"), (25, "a b a b"),
]


@pytest.mark.parametrize(("order", "block"), [(1, 1 << 20), (2, 50), (3, 1 << 20), (4, 10)])
def test_odd_rows(spark, monkeypatch, order, block):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", block)
    frame = spark.createDataFrame([(i, t, 1.0, "x") for i, t in ODD], "doc_id long, text string, score double, block string")
    assert_equal(scoring.scored(frame.repartition(3), order=order, folds=4), plain(ODD, order, 4))


def automaton_of(texts, order):
    """The automaton of one block whose texts are all for training, and the block."""
    hashes, index, sizes = scoring._tokens(pa.array(texts))
    block = scoring._Block(hashes, index, sizes, np.ones(len(texts), bool))
    grams = [(block.counts(keys, where), where) for _, keys, where, _ in block.grams(order)]
    words = grams[0][0]
    begin = grams[0][1][block.starts[0]]
    tokens = int(words.sum() - words[begin])
    backoffs = np.full((order + 1, scoring.BUCKETS), 0.25)
    return scoring._Automaton(grams, tokens, len(words) - 1, backoffs), block


@pytest.mark.parametrize("order", [2, 3, 4])
def test_weights_of_a_state_and_failure_arcs(order):
    automaton, block = automaton_of(["a b c a b d", "b c b c a", "a b c"], order)
    # failure arcs shorten a state until the root
    states = np.arange(1, len(automaton.failure))
    assert (automaton.failure[states] < states).all()
    # every state that goes on: its letters' probabilities sum to one, but for unknown words and the begin mark
    begin = automaton.letters[block.starts[0]]
    letters = np.delete(np.arange(automaton.n_letters), begin)
    sources = np.unique(automaton.arcs // automaton.n_letters)
    assert len(sources) > order
    spare = 0.1 / (sum(block.sizes - 1) + 0.1 * (len(letters) + 1))
    for state in [0, *sources]:
        _, weight = automaton.read(np.full(len(letters), state), letters)
        passes = 0
        at = state
        while at:
            passes, at = passes + 1, automaton.failure[at]
        assert (10**weight).sum() == pytest.approx(1 - spare * 0.25**passes)


def test_segments_carry_the_state(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcde"), n)) for n in (0, 1, 7, 8, 9, 40, 333)]
    for order in (1, 2, 3, 4):
        automaton, block = automaton_of(texts, order)
        whole = automaton.scores(block, order)
        for size in (1, 3, 8):
            monkeypatch.setattr(scoring, "SEGMENT", size)
            assert automaton.scores(block, order) == pytest.approx(whole, rel=1e-12)
        monkeypatch.undo()


def test_nothing_to_learn_from_and_empty_table(spark):
    held = [(i, "a b") for i in range(100) if brute.remainder(i, 10) == 0]
    frame = spark.createDataFrame(held, "doc_id long, text string")
    assert_equal(scoring.scored(frame), plain(held))
    assert scoring.scored(frame.limit(0)).count() == 0


def test_keys_survive_packing():
    rng = np.random.default_rng(3)
    for keys in ([5], [1, 2, 2**63, 2**64 - 1], np.sort(rng.integers(0, 2**44, 500, np.uint64)) + np.uint64(7 << 60)):
        keys = np.array(keys, np.uint64)
        assert np.array_equal(scoring._unpack_keys(scoring._pack_keys(keys)), keys)
