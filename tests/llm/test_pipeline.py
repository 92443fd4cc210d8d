"""The pipeline's stages against brute force, and every registered query against its SQL where it has one."""

import os
import re

import pytest

import corpus_pipeline
from hintforge.llm import links, queries
from tests.llm.test_filters import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def low(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def keeps(t):
    words = low(t)
    raw = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    size = lambda some: sum(len(w) for x in some for w in x.split())
    if len(words) < 50 or 100 * len(brute(t, 3)[1]) > 50 * len(words):
        return False
    if len(lines) - len(set(lines)) > 0.3 * len(lines) or size(lines) - size(set(lines)) > 0.2 * size(lines):
        return False
    return all(sum(len(raw[j]) for j in brute(t, n)[1]) <= limit * sum(map(len, raw)) for n, limit in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items())


def survivors(docs):
    sets = {d: {tuple(low(t)[i : i + 5]) for i in range(max(1, len(low(t)) - 4))} for d, t in docs.items()}
    names = sorted(docs)
    forest = links.Forest(len(names))
    for i, a in enumerate(names):
        for j, b in enumerate(names[:i]):
            both = len(sets[a] & sets[b])
            if both and 10 * both >= 8 * len(sets[a] | sets[b]):
                forest.join(i, j)
    return {d for i, d in enumerate(names) if forest.root(i) == i}


def runs(t, n):
    w = low(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    before = text(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = queries_store(stage(spark, docs, SF), k)
        assert docs.columns == columns
        after = text(docs)
        if k == 0:
            assert set(after) == {d for d, t in before.items() if keeps(t)} and len(after) > 0.5 * len(before)
        elif k == 1:
            assert set(after) == survivors(before) and len(after) < len(before)
        elif k == 2:
            assert set(after) <= set(before)
            seen = {}
            for d in sorted(after):
                for r in runs(after[d], 50):
                    assert seen.setdefault(r, d) == d
            for d, t in after.items():  # what went is held by an earlier document
                gone = [w for w in low(before[d])]
                if t != before[d]:
                    assert len(low(t)) < len(gone) and any(r in runs(before[e], 36) for r in runs(before[d], 36) for e in before if e < d)
        else:
            items = [runs_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = {d for d, t in before.items() if any(i and 10 * len(i & runs_of(t)) >= 8 * len(i) for i in items)}
            assert set(after) == set(before) - bad
        before = after
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(before)


def runs_of(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def queries_store(df, k):
    from hintforge.llm.common import stored

    return stored(df, f"stage-{k}")


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 1


def test_queries_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    known = queries.queries()
    for name, sql in queries.oracle_sql().items():
        got = known[name](spark, SF)
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(got.columns), name
        key = lambda r: tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r)
        assert sorted(map(key, want.fetchall())) == sorted(key(r) for r in got.select(*names).collect()), name
