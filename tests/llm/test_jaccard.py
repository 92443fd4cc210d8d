"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from hintforge.llm import jaccard_join as jj
from hintforge.llm import links

rng = random.Random(4)


def say(n, words=40):
    return [f"W{rng.randint(0, words)}" for _ in range(n)]


def texts():
    out = [None, "", "  ", "one", "ONE", "one two", "one two three", "a b c d", "a b c d"]
    for size in (3, 8, 12, 20, 60, 150, 400):
        for _ in range(6):
            base = say(size, 5 if size < 10 else 500)
            out.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, 6, 10):
                w = list(base)
                for _ in range(edits):
                    k = rng.randrange(len(w) + 1)
                    w[k : k + 1] = rng.choice([[], ["new"], ["x", "y"]])
                out.append("\n".join(w).lower())
    return out


def brute(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    forest = links.Forest(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                forest.join(i, j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            ids[forest.root(i)] = min(d, ids.get(forest.root(i), d))
    return [(d, len(s), ids.get(forest.root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize(("n", "num", "den", "block"), [(3, 90, 100, 800), (5, 8, 10, 5)])
def test_components(spark, n, num, den, block):
    rows = [(1000 - i, t) for i, t in enumerate(texts())] + [(7, "a b c d"), (7, None), (None, "a b c d"), (None, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, size int").repartition(4)
    got = [tuple(r) for r in jj.jaccard_components(docs, n, (num, den), block).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, n, num, den), key=str)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert jj.jaccard_components(docs.limit(0)).count() == 0 and jj.keep_one(docs).count() == 1


def test_keep_one_judges_rows(spark):
    a, b, c = ("x1 x2 x3 x4 x5 x6 x7", "y1 y2 y3 y4 y5 y6 y7", "z1 z2 z3 z4 z5 z6 z7")
    rows = [(1, a), (2, a), (2, "own text of this second row"), (3, b), (3, b), (None, b), (None, c), (None, c), (None, "alone"), (None, None), (4, ""), (5, "")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kind string").repartition(3)
    got = [tuple(r) for r in jj.keep_one(docs).collect()]
    want = [(1, a), (2, "own text of this second row"), (3, b), (None, c), (None, "alone"), (None, None), (4, ""), (5, "")]
    assert sorted(got, key=str) == sorted([(*r, "k") for r in want], key=str)


def test_prefix_keys_lose_no_link():
    gen = np.random.default_rng(2)
    for num, den in ((9, 10), (8, 10)):
        for size in [*range(1, 40), 100, 300]:
            for _ in range(6):
                common = gen.integers(0, 2, 64).astype(np.uint8)
                a = np.unique(gen.integers(0, 2**63, size).astype(np.uint64))
                most = 2 * len(a) * (den - num) // (den + num)
                drop, new = gen.integers(0, most + 1), gen.integers(0, most + 1)
                b = np.unique(np.concatenate([a[drop:], gen.integers(0, 2**63, new).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if not len(b) or den * both < num * (len(a) + len(b) - both):
                    continue
                ka, kb = (jj.prefix_keys(s, np.array([len(s)]), np.array([1]), num, den, common)[0] for s in (a, b))
                assert len(np.intersect1d(ka, kb)), (size, len(b), both)


def test_connected_components(spark):
    gen = random.Random(1)
    pairs = [(gen.randint(0, 400), gen.randint(0, 400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(60)] + [(-5, 5), (3, 3)]
    table = spark.createDataFrame(pairs, "a long, b long")
    got = dict(tuple(r) for r in links.connected_components(table).collect())
    assert got == dict(tuple(r) for r in links.connected_components(table, task_links=0).collect())
    names = sorted({x for p in pairs for x in p})
    at, forest = {x: i for i, x in enumerate(names)}, links.Forest(len(names))
    for a, b in pairs:
        forest.join(at[a], at[b])
    want = {x: names[forest.root(at[x])] for x in names if forest.root(at[x]) != at[x]}
    assert got == want


def test_groups_beyond_a_block_lose_no_link(spark):
    """Walks dealt into chunks, with and without sets, against all pairs; sets of very different sizes have bitmaps of different widths."""
    from hintforge.llm import signature_trees as st

    gen, rows, sets = np.random.default_rng(9), [], {}
    for g in range(3):
        for base in [gen.integers(0, 2**63, n).astype(np.uint64) for n in (30, 60, 6000)]:
            for _ in range(14):
                keep = base[gen.random(len(base)) > gen.choice([0.01, 0.06, 0.15])]
                s = np.unique(np.concatenate([keep, gen.integers(0, 2**63, 2).astype(np.uint64)]))
                node = len(sets)
                sets[node] = s
                rows.append((g, node, len(s), int(s[0].view(np.int64)), s))
    forest = links.Forest(len(sets))
    for g in range(3):
        mine = [r[1] for r in rows if r[0] == g]
        for p in mine:
            for q in mine:
                both = len(np.intersect1d(sets[p], sets[q]))
                if p < q and 10 * both >= 8 * (len(sets[p]) + len(sets[q]) - both):
                    forest.join(p, q)
    want = [forest.root(k) for k in range(len(sets))]
    schema = "group long, node long, size long, low long, data binary"
    whole = spark.createDataFrame([(*r[:4], bytearray(r[4].tobytes())) for r in rows], schema)
    bits = spark.createDataFrame([(*r[:4], bytearray(st.own_bitmaps(r[4], np.array([len(r[4])]))[0])) for r in rows], schema)
    for block in (800, 6):
        for exact, table in ((True, whole), (False, bits)):
            found = links.Forest(len(sets))
            for r in st.span_groups(table, exact, 8, 10, block).collect():
                found.join(r.a, r.b)
            got = [found.root(k) for k in range(len(sets))]
            if exact:
                assert got == want
            else:  # what may link holds what does, and little else
                assert all(got[k] == got[want[k]] for k in range(len(sets))) and len(set(got)) > 0.5 * len(set(want))


def test_unrelated_sets_do_not_chain(spark):
    """Passages that many texts share: no candidate cluster holds unrelated texts, however many chains of shared shingles there are."""
    gen = random.Random(12)
    shared = [" ".join(f"s{gen.randint(0, 10**6)}" for _ in range(12)) for _ in range(40)]
    rows = [(i, " ".join(f"u{gen.randint(0, 10**7)}" for _ in range(60)) + " " + shared[i % 40] + " " + shared[(i * 7 + 1) % 40]) for i in range(3000)]
    rows += [(5000 + i, rows[i][1] + " end") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jj.jaccard_components(docs, 5, (8, 10)).collect()}
    assert all(got[i] == i for i in range(3000)) and all(got[5000 + i] == i for i in range(100))


def test_tasks_have_one_python_step(spark, monkeypatch):
    """A task with two Python steps in a row keeps two workers, and an executor keeps all that it ever had."""
    steps, stored = [], links.stored

    def seen(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        steps.append(max(part.count("InArrow") + part.count("InPandas") for part in plan.split("Exchange")))
        return stored(df, name)

    monkeypatch.setattr(links, "stored", seen)
    docs = spark.createDataFrame([(i, f"a b c d e f {i // 2} h i j k") for i in range(40)], "doc_id long, text string")
    assert len({r.component_id for r in jj.jaccard_components(docs, 1, (9, 10)).collect()}) == 20
    assert max(steps) == 1
