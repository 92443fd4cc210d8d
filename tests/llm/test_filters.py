"""Repetition rules, URL templates, decontamination and WARC archives against brute force."""

import hashlib
import random
import re
from collections import Counter

from hintforge.llm import decontaminate, quality_rules, url_filter, warc

rng = random.Random(3)
VOCAB = ["the", "of", "a", "#", "|", "naïve", "x<y", "日本", "end."]
TEXTS = [None, "", " \n\t ", "one", "a b a b a b", "x\ny\nx\n \nx", "the cat sat\u00a0on \x1c the mat\n" * 30, " ".join(f"w{i}" for i in range(200))]
TEXTS += ["".join(rng.choice(VOCAB) + rng.choice([" ", "\n", "  ", "\x0b"]) for _ in range(rng.randint(1, 150))) for _ in range(60)]
TEXTS += [" ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(40, 300))) for _ in range(40)]


def brute(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    under = {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
    return words, under


def test_repetition_measures(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in quality_rules.repetition_measures(docs).collect()}
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    for i, t in enumerate(TEXTS):
        r, (words, three) = got[i], brute(t, 3)
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(three)), t
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "") and r.n_dup_lines == len(lines) - len(set(lines))
        for n in range(5, 11):
            assert r[f"dup_{n}gram_chars"] == sum(len(words[j]) for j in brute(t, n)[1])
        assert r.base_failed == (len(words) < 50 or 100 * len(three) > 50 * len(words))
        assert (i in kept) == r.kept and not (r.base_failed and r.kept)
    assert got[7].kept and not got[6].kept


def test_repetition_empty_and_repeated(spark):
    docs = spark.createDataFrame([(None, "a " * 60), (None, "a " * 60)], "doc_id long, text string")
    assert quality_rules.repetition_measures(docs).count() == 2 and quality_rules.repetition_measures(docs.limit(0)).count() == 0


def test_repetition_of_few_words_alone(spark):
    for n in range(10):
        docs = spark.createDataFrame([(n, "a " * n)], "doc_id long, text string").coalesce(1)
        r = quality_rules.repetition_measures(docs).first()
        assert (r.doc_id, r.n_words, r.n_repeat_words, r.kept) == (n, n, len(brute("a " * n, 3)[1]), False)
        assert [r[f"dup_{k}gram_chars"] for k in range(5, 11)] == [len(brute("a " * n, k)[1]) for k in range(5, 11)]
        assert quality_rules.keep_good(docs).count() == 0


def test_split_and_rules(spark):
    urls = [
        ("http://A.Example.org/es/x?q=/en", "a.example.org", "/es/x", "example.org/es/", "block"), ("https://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
        ("x://b.org", "b.org", "", None, "allow"), ("x://b.org/", "b.org", "/", "org/", "allow"), ("ftp://w.com/fr/a", "w.com", "/fr/a", "com/fr/", "allow"), ("ftp://w.com/de/a", "w.com", "/de/a", "com/de/", "block"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("a://ÄB.net/x\ny", "Äb.net", "/x\ny", None, "allow"), ("://org/a", "org", "/a", "org/", "allow"), ("http://notorg/a://b.org/", "notorg", "/a://b.org/", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0], "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, labels).collect()}
    assert len(got) == len(urls)
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), urls[i]
    assert url_filter.judge_urls(pages.limit(0), labels).count() == 0


def test_templates_learn_bad_branches(spark):
    rows, marks = [], []
    for i in range(600):
        part = ["news", "spam", f"r{rng.randint(0, 10**9):x}"][i % 3]
        rows.append((i, f"http://h.net/{part}/{i}.html"))
        marks.append((i, 0 if part == "spam" else 1, 0 if i % 7 else None))
    rows += [(1000, "http://h.net/spam/77777.html"), (1001, "http://h.net/news/8.html"), (1001, "http://h.net/news/8.html"), (None, None)]
    marks += [(5, 1, 1), (None, 0, 0), (1001, None, None)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    assert {r.template for r in got if "/spam/" in r.path} == {"/spam/{num}.html/"}
    for r in got:
        assert r.verdict == ("block" if "/spam/" in r.path else "allow"), r


def test_decontamination(spark):
    words = [f"t{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([4, 5, 6, 12, 30, 60, 80])] + [(7, None), (8, ""), (None, say(20))]
    docs = [(i, f"{say(300)} {t.upper().replace(' ', ', ')}! {say(900)}") for i, t in items if t]
    for k, (i, t) in enumerate(items):  # holes of growing size
        for hole in range(8):
            w = (t or "").split()
            docs.append((1000 + 10 * k + hole, f"{say(40)} {' '.join(w[: len(w) // 2])} {say(hole)} {' '.join(w[len(w) // 2 + hole :])}"))
    docs += [(1, None), (2, ""), docs[3]]
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda t: {tuple(norm(t)[i : i + 5]) for i in range(len(norm(t)) - 4)}
    held = {}
    for d, t in docs:
        held.setdefault(d, set()).update(shingles(t))
    want = {(d, i, len(shingles(t)), len(s & shingles(t))) for d, s in held.items() for i, t in items if shingles(t) and 10 * len(s & shingles(t)) >= 8 * len(shingles(t))}
    d, b = spark.createDataFrame(docs, "doc_id long, text string").withColumnsRenamed({}), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(d, b).collect()
    assert len(got) == len(want) > 10 and {tuple(r) for r in got} == want
    assert decontaminate.contaminated(d.limit(0), b).count() == 0 and decontaminate.contaminated(d, b.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(d, b).count() == sum(x[0] not in {w[0] for w in want} for x in docs)


def test_rows_without_id_are_judged_alone(spark):
    words = [f"u{i}" for i in range(40)]
    item, clean = " ".join(words), " ".join(f"v{i}" for i in range(40))
    docs = [(None, "pre " + item), (None, clean), (None, None), (None, " ".join(words[:22])), (None, " ".join(words[18:])), (1, item), (2, clean)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((tuple(r) for r in decontaminate.drop_contaminated(d, b).collect()), key=str) == sorted([*docs[1:5], docs[6]], key=str)


def test_warc_round_trip(spark):
    long = "é" * 5000
    html = [(3, "u", "x" * 100), (1, "http://a/\r\nb c", "x" * 100), (2, None, "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (9, "u", long), (8, "u", long), (8, "u", long), (7, "u", "a\r\n\r\nWARC/1.1"), (None, "u", "x" * 100), (12, "u", "q" * 300 + "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "?") for r in html], "page_id long, url string, html string, record_type string").repartition(3)
    got = [tuple(r) for r in warc.archive_pages(pages, chunk_bytes=64).collect()]
    first = {}
    for i, _, h in html:
        if i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in html:
        data = (h or "").encode()
        again = len(data) >= 100 and first[h] != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    key = lambda r: tuple((x is None, x) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0
