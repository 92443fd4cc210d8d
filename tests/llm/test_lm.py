"""Language-model scores against a brute-force model."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hintforge.llm import lm_scoring as lm

rng = random.Random(8)
WORDS = ["the", "The", "of", "Ça", "x", "y.", "日本"] + [f"w{i}" for i in range(60)]
DOCS = [(i, "".join(rng.choice(WORDS) + rng.choice(" \n\t") for _ in range(rng.randint(0, 80)))) for i in range(120)]
DOCS += [(200, None), (201, ""), (None, "the of"), (3, DOCS[3][1]), (4, "another text of the same doc")]


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]


def brute():
    out = [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, tokens(t)) for d, t in DOCS]
    uni = Counter(w for _, h, ws in out if not h for w in ws)
    bi = Counter(p for _, h, ws in out if not h for p in zip(["^", *ws], ws))
    n, v = sum(uni.values()), len(uni)
    p1 = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    q = lambda c: lm.LEAST[lm.level(np.array([c]))[0]] if c else 0
    p2 = lambda a, w: (q(bi[a, w]) + lm.MU * p1(w)) / ((uni[None] if a == "^" else uni[a]) + lm.MU)
    return [(d, h, len(ws), sum(uni[w] > 0 for w in ws), n, sum(math.log10(p1(w)) for w in ws), sum(math.log10(p2(a, w)) for a, w in zip(["^", *ws], ws))) for d, h, ws in out]


@pytest.mark.parametrize("bound", [1 << 20, 900])
def test_scores(spark, bound):
    docs = spark.createDataFrame([(*d, 1.0) for d in DOCS], "doc_id long, text string, score double").repartition(3)
    key = lambda r: tuple(str(x) if not isinstance(x, float) else f"{x:.6f}" for x in r)
    got = sorted((tuple(r) for r in lm.score_documents(docs, shard_text=4000, broadcast_bytes=bound, entry_bits=60).collect()), key=key)
    want = sorted(brute(), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    close = np.isclose([r[6] for r in got], [r[6] for r in want], rtol=1e-9)
    assert close.mean() > 0.95 and all(g[6] >= w[6] - 1e-9 for g, w in zip(got, want))


def test_no_training_text_and_empty(spark):
    docs = spark.createDataFrame([(d, "a b") for d in range(40) if lm.held_out(d)], "doc_id long, text string")
    rows = lm.score_documents(docs).collect()
    assert rows and all(r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3 for r in rows)
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_filter_has_no_false_negatives_and_few_errors():
    gen = np.random.default_rng(1)
    keys = np.unique(gen.integers(0, 2**63, 20_000).astype(np.uint64))
    counts = np.maximum(1, gen.pareto(1, len(keys))).astype(np.int64)
    table = lm.LogFrequencyFilter.of(keys, counts)
    assert (table.levels(keys) >= lm.level(counts)).all()
    assert (table.levels(keys) == lm.level(counts)).mean() > 0.95
    assert (table.levels(keys + np.uint64(1)) > 0).mean() < 0.05


def test_word_counts_are_exact():
    gen = np.random.default_rng(3)
    keys = np.unique(gen.integers(0, 2**63, 5000).astype(np.uint64))
    counts = np.concatenate([gen.integers(1, 300, len(keys) - 3), [255, 254, 10**12]])
    table = lm.WordCounts(keys, np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255])
    assert (table.of(keys) == counts).all() and not table.of(keys + np.uint64(1)).any()
    assert not lm.WordCounts(*(np.zeros(0, k) for k in (np.uint64, np.uint8, np.int64))).of(keys).any()


def test_every_class_and_filter_is_in_one_pass():
    words, pairs = {c: 30 + c for c in range(9)}, {(c, p): 25 + 7 * p for c in range(9) for p in range(3) if c != 4}
    for bound in (1, 60, 150, 400, 10_000):
        plan = lm.passes(words, pairs, 10, bound)
        assert sorted(p for _, some in plan for p in some) == sorted(pairs)
        runs = list(dict.fromkeys(run for run, _ in plan))
        assert [c for a, b in runs for c in range(a, b)] == list(range(10))
        for (a, b), some in plan:
            held = sum(words.get(c, 0) for c in range(a, b))
            assert held + sum(pairs[p] for p in some) <= max(bound, held + max((pairs[p] for p in some), default=0)) and (b - a == 1 or held <= bound // 2 or held <= max(words.values()))


def test_filters_are_probed_together():
    rng = np.random.default_rng(4)
    keys, counts = rng.integers(0, 2**63, 9000).astype(np.uint64), rng.integers(1, 3000, 9000)
    where = rng.integers(0, 3, 9000)
    filters = {k: lm.LogFrequencyFilter.of(keys[where == n], counts[where == n]) for n, k in enumerate((7, 2, 11))}
    bank = lm.FilterBank({k: f.bits for k, f in filters.items()})
    assert bank.numbers.tolist() == [7, 2, 11]
    asked, at = np.concatenate([keys, keys + np.uint64(1)]), np.concatenate([where, where])
    got = bank.levels(asked, at)
    for n, k in enumerate((7, 2, 11)):
        assert (got[at == n] == filters[k].levels(asked[at == n])).all()
    assert (got[:9000] >= lm.level(counts)).all() and (got[9000:] > 0).mean() < 0.05
    assert len(lm.FilterBank({}).levels(keys[:0], where[:0])) == 0
