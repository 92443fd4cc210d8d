"""Source divergence against its definition in Python's integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from hintforge.llm import divergence
from hintforge.llm.divergence import corrections, gap, source_divergence

rng = random.Random(11)
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    groups, langs, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(terms), langs[lang].update(terms), docs[lang].update(set(terms))
    out = set()
    for lang in langs:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        v = len(kept)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (n + 2 * v) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(c) for (x, s), c in groups.items() if x == lang}, shares(langs[lang])
        for s in p:
            pairs = sorted(((sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, value, i + 1) for i, (value, o) in enumerate(pairs)}
            terms = sorted(((f(p[s][t], q[t]), t) for t in kept if groups[lang, s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "term", t, value, i + 1) for i, (value, t) in enumerate(terms[:top])}
    return out


def corpus(n, sources, words):
    some = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é"[: 2 + i % 3] for i in range(words)]
    return [(i, " ".join(rng.choice(some) * rng.randint(1, 2) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(sources)) for i in range(n)]


def test_divergence(spark):
    rows = corpus(400, ["a", "b", "ß", "A", None, ""], 60) + [(None, None, "en", "none"), (1, "", "xx", "alone"), (1, "Ünder_score ABC日本abc-x", None, None), (1, "Ünder_score ABC日本abc-x", None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, term string, n int")  # clashing names
    got = [tuple(r) for r in source_divergence(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert {r[3] for r in got if r[0] == "xx"} == set() and any(r[1] == "none" and r[2] == "pair" for r in got)


def test_many_sources_in_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "SHARD_POSTINGS", 40)
    monkeypatch.setattr(divergence, "TERM_ROWS", 8)
    rows = corpus(500, [f"s{i}" for i in range(11)], 90)
    assert {tuple(r) for r in source_divergence(spark.createDataFrame(rows, SCHEMA), min_docs=3, top_terms=4).collect()} == brute(rows, 3, 4)


def test_no_kept_terms_and_empty(spark):
    rows = [(1, "only once", "en", "a"), (2, "x", "en", "b"), (3, None, "en", "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in source_divergence(docs).collect()}
    assert got == brute(rows) and {r[4] for r in got} == {0} and len(got) == 6
    assert source_divergence(docs.limit(0)).count() == 0


def test_counters_leave_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    batch = spark.createDataFrame(corpus(200, ["a", "b"], 60), SCHEMA).fillna("").toArrow().combine_chunks().to_batches()
    parts = list(divergence.count_terms(iter(batch * 2)))
    assert len(parts) > 5
    whole = Counter()
    for p in parts:
        for r in p.to_pylist():
            whole[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for r in batch[0].to_pylist() * 2:
        want.update((r["lang"], r["source"], t) for t in re.findall("[^\\W\\d_]+", r["text"]))
    assert {k: n for k, n in whole.items() if k[2]} == dict(want)


def test_corrections_only_come_from_postings():
    zero = {0: 5, 1: 7, 2: 11}
    head = [(0, i, None, p) for i, p in zero.items()]
    posts = [(0, 0, "t", 900), (0, 1, "t", 70), (0, 1, "u", 33)]
    a, b, fix = corrections(pd.DataFrame(head + posts, columns=["block", "idx", "term", "p"]), same=True)
    share = lambda s, t: dict(((s2, t2), p) for _, s2, t2, p in posts).get((s, t), zero[s])
    f = lambda p, q: int(gap(np.int64(p), np.int64(q)))
    want = {(x, y): sum(f(share(x, t), share(y, t)) - f(zero[x], zero[y]) for t in "tu") for x in zero for y in zero if x < y}
    assert dict(zip(zip(a.tolist(), b.tolist()), fix.tolist())) == want


def test_bytes_that_are_not_utf8(spark):
    raw = [(i, bytearray(b"ab\xff cd")) for i in range(10)]
    docs = spark.createDataFrame(raw, "doc_id long, raw binary").selectExpr("doc_id", "cast(raw AS string) AS text", "'en' AS lang", "'s' || doc_id % 2 AS source")
    assert {tuple(r) for r in source_divergence(docs).collect()} == brute([(i, "ab� cd", "en", f"s{i % 2}") for i in range(10)])
