"""Repeated passages: planted ones are found and cut, other text stays."""

import random

from hintforge.llm import substring_dedup as sd

rng = random.Random(6)


def say(n):
    return [f"V{rng.randint(0, 10**6)}" for _ in range(n)]


def test_passages_everywhere(spark):
    docs, planted = [], {}
    for k, size in enumerate([50, 51, 60, 90, 200, 700]):
        passage = say(size)
        for c in range(3):
            d = 10 * k + c
            before, after = say(rng.randint(0, 300)), say(rng.randint(0, 300))
            words = before + [w.lower() if c else w for w in passage] + after
            docs.append((d, "".join(w + rng.choice([" ", " ", " ", "\n", "\t "]) for w in words)))
            planted[d] = (len(before), size, 10 * k)
    short = " ".join(say(20))
    docs += [(500 + i, " ".join(say(80)) + " " + short + "\n" + " ".join(say(90))) for i in range(5)]
    docs += [(600, None), (601, ""), (None, docs[0][1]), (602, " ".join(["x"] * 300))]
    df = spark.createDataFrame([(*d, "copy", len(d[1] or "")) for d in docs], "doc_id long, text string, copy string, n_chars long").repartition(4)
    got = {r.doc_id: r.spans for r in sd.repeated_spans(df).collect()}
    assert set(got) == set(planted)
    for d, (at, size, keeper) in planted.items():
        assert len(got[d]) == 1
        s = got[d][0]
        assert at <= s.first and s.first + s.size <= at + size and s.size >= max(sd.PASSAGE, size - 2 * sd.REACH)
        assert s.removed == (d != keeper) and s.keeper == keeper
    texts = dict((d, t) for d, t in docs if d is not None)
    out = {r.doc_id: r for r in sd.remove_repeats(df).collect()}
    for d, t in texts.items():
        if d in planted and got[d][0].removed:
            s = got[d][0]
            w = t.split()
            rest = w[: s.first] + w[s.first + s.size :]
            assert (d in out) == bool(rest) and (not rest or (out[d].text.split() == rest and out[d].n_chars == len(out[d].text)))
        else:
            assert out[d].text == t and out[d].n_chars == len(t or "")
    assert None in out and sd.remove_repeats(df.limit(0)).count() == 0


def test_spans_reach_both_ends(spark):
    docs, planted = [], {}
    for k, size in enumerate([50, 53, 60, 75, 100, 130, 300]):
        passage = say(size)
        for c in range(3):
            before = say(rng.randint(0, 60))
            docs.append((10 * k + c, "\n".join(before + passage + say(rng.randint(0, 60)))))  # no long lines
            planted[10 * k + c] = [(len(before), size, c > 0, 10 * k)]
    df = spark.createDataFrame([*docs, (docs[1][0], " ".join(say(90))), (None, docs[0][1])], "doc_id long, text string").repartition(3)
    got = sd.repeated_spans(df).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in got} == planted and len(got) == len(planted)


def test_near_lines_by_jaccard(spark):
    base = say(150)
    near, far = list(base), list(base)
    near[40], near[100] = "new", "other"
    for k in range(5, 150, 6):
        far[k] = f"far{k}"
    line = lambda w: " ".join(w)
    rows = [(1, line(say(70)) + "\n" + line(base) + "\nend"), (2, line(near)), (3, line(far)), (4, line(say(150))), (2, line(near)), (5, line(base[:49]))]
    got = {(r.doc_id, r.first): (r.size, r.keeper) for r in sd.line_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 70): (150, 1), (2, 0): (150, 1)}


def test_bands_have_high_recall():
    import numpy as np

    gen = np.random.default_rng(4)
    hit = {0.8: 0, 0.3: 0}
    for jaccard in hit:
        for _ in range(150):
            both = gen.integers(0, 2**63, 120).astype(np.uint64)
            extra = round(120 * (1 - jaccard) / jaccard / 2)
            a, b = (np.concatenate([both, gen.integers(0, 2**63, extra).astype(np.uint64)]) for _ in range(2))
            hit[jaccard] += (sd.band_keys(a, np.array([len(a)])) == sd.band_keys(b, np.array([len(b)]))).any()
    assert hit[0.8] >= 145 and hit[0.3] <= 25


def test_drop_spans():
    assert sd.drop_spans(b"a b  c\nd e", [(1, 2)]) == b"a d e" and sd.drop_spans(b" a b", [(0, 2)]) == b" " and sd.drop_spans(b"a b", []) == b"a b"


def wrapped(words, n):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def edited(words, edits):
    out = list(words)
    for k in range(1, edits + 1):
        out[len(out) * k // (edits + 1)] = f"edit{rng.random()}"
    return out


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(a & b) / len(a | b)


def test_edited_paragraphs_over_short_lines(spark):
    docs, cases, clean = [], [], []
    for size, edits in [(80, 1), (94, 2), (120, 2), (160, 3), (200, 4)]:
        for form in ("alone", "among lines", "between empty lines"):
            for width in (7, 12, 30):
                for _ in range(2):
                    one = [w.lower() for w in say(size)]
                    two = edited(one, edits)
                    assert jaccard(one, two) >= 0.8
                    for w in (one, two):
                        gap = {"alone": None, "among lines": "\n", "between empty lines": "\n\n"}[form]
                        text = wrapped(w, width)
                        docs.append((len(docs), text if gap is None else wrapped(say(60 + rng.randint(0, 40)), 12) + gap + text + gap + wrapped(say(70), 12)))
                    cases.append((len(docs) - 1, size, form))
    for _ in range(60):
        clean.append(len(docs))
        docs.append((len(docs), "\n".join(wrapped(say(rng.randint(20, 300)), rng.choice([1, 3, 9, 20])) for _ in range(2))))
    got = {r.doc_id: r.spans for r in sd.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()}
    gone = {d: sum(s.size for s in spans if s.removed) for d, spans in got.items()}
    found = [size * 3 / 4 <= gone.get(d, 0) <= size for d, size, _ in cases]
    assert sum(found) >= 0.95 * len(cases) and not set(clean) & set(got)
    assert all(not gone[d - 1] for d, _, _ in cases if d - 1 in gone)


def test_parts_never_chain():
    import numpy as np

    gen = np.random.default_rng(8)
    for _ in range(200):
        sizes = gen.integers(0, gen.choice([3, 10, 30, 60]), gen.integers(1, 60))
        doc = np.sort(gen.integers(0, 3, len(sizes)))
        first, n, part = sd.paragraph_places(sizes, doc, gen.integers(0, 2**63, int(sizes.sum())).astype(np.uint64))
        line_of = np.repeat(np.arange(len(sizes)), sizes)
        assert (n >= sd.MIN_LINE).all() and (first + n <= sizes.sum()).all()
        for f, m in zip(first, n):
            assert doc[line_of[f]] == doc[line_of[f + m - 1]] and (sizes[line_of[f] : line_of[f + m - 1] + 1] > 0).all()
        parts = [set(range(f, f + m - 4)) for f, m in zip(first[part], n[part])]
        assert all(len(a & b) < 0.75 * len(a | b) for i, a in enumerate(parts) for b in parts[:i])
    assert sum(map(len, sd.paragraph_places(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)))) == 0


def test_bridges_need_jaccard():
    assert sd.bridged([(0, 40, 1), (41, 40, 1)]) == [(0, 81, 1)] and sd.bridged([]) == []
    for apart in ([(0, 40, 1), (41, 40, 2)], [(0, 40, 1), (46, 40, 1)], [(0, 28, 1), (33, 28, 1)]):
        assert sd.bridged(apart) == apart


def test_what_is_read_no_more_goes_from_disk(spark, monkeypatch):
    from pathlib import Path

    from hintforge.llm import common

    passage = say(60)
    docs = spark.createDataFrame([(d, " ".join(say(40) + passage + say(40))) for d in range(6)], "doc_id long, text string").repartition(3)
    base, seen, walk = Path(common.shared_dir(spark, "x")).parent, [], sd.span_groups
    monkeypatch.setattr(sd, "span_groups", lambda *a: seen.append({p.name.split("-")[0] for p in base.iterdir()} | {p.name for p in base.glob("paragraphs-*/*=*")}) or walk(*a))
    before = {p.name for p in base.iterdir()}
    assert sd.repeated_spans(docs).count() == 6
    (held,) = seen
    assert "pack=false" in held and "pack=true" not in held and not any(n.startswith("near-sets") for n in {p.name for p in base.iterdir()} - before)


def test_lists_too_long_to_broadcast(spark, monkeypatch):
    passage, more = say(70), say(55)
    docs = spark.createDataFrame([(d, " ".join(say(30) + passage + say(30)) + "\n" + "\n".join(more)) for d in range(5)], "doc_id long, text string").repartition(3)
    rows = lambda: sorted((r.doc_id, r.copy, str(r.spans)) for r in sd.repeated_spans(docs).collect())
    few = rows()
    monkeypatch.setattr(sd, "LIST_BYTES", 0)
    assert len(few) == 5 and rows() == few


def test_shuffle_files_go_with_the_write(spark):
    import time

    from hintforge.llm.common import stored

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    before = shuffled()
    df = stored(spark.range(5000).repartition(3, "id").groupBy("id").count(), "some")
    for _ in range(20):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and df.count() == 5000
