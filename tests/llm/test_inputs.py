"""Odd inputs to every operator: bytes that aren't UTF-8, texts beyond a slice, clashing columns, empty tables, repeated rows."""

import os
import random
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hintforge.llm import common, decontaminate, jaccard_join, lm_scoring, packing, quality_rules, substring_dedup, token_codes, token_counts, url_filter, warc
from hintforge.llm.queries import tokenizer_path

rng = random.Random(21)
WORD, PIECE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
BAD = [b"ok \xff\xfe word", b"\xc3", b"cut \xe6\x97", b"fine"]


def say(n, kinds=10**6):
    return " ".join(f"k{rng.randint(0, kinds)}" for _ in range(n))


def bad_docs(spark, more=()):
    rows = [(i, bytearray(b)) for i, b in enumerate(BAD)] + [(10 + i, bytearray(t.encode())) for i, t in enumerate(more)]
    return spark.createDataFrame(rows, "doc_id long, raw binary").select("doc_id", F.expr("cast(raw AS string)").alias("text"))


def test_bytes_that_are_not_utf8(spark):
    from tokenizers import Tokenizer

    docs = bad_docs(spark).coalesce(1)
    texts = [b.decode("utf-8", "replace") for b in BAD]
    got = {r.doc_id: r for r in quality_rules.repetition_measures(docs).collect()}
    assert [got[i].word_chars for i in range(len(BAD))] == [len("".join(t.split())) for t in texts]
    library = Tokenizer.from_file(WORD)
    sizes = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [r.n_tokens for r in token_codes.encode_documents(docs, WORD).orderBy("doc_id").collect()] == [n + 1 for n in sizes]
    assert [r.length for r in packing.pack_documents(docs, WORD).orderBy("doc_id").collect()] == [n + 1 for n in sizes]
    assert token_counts.count_tokens(docs, PIECE).count() == len(BAD)
    assert lm_scoring.score_documents(docs).count() == jaccard_join.jaccard_components(docs).count() == len(BAD)
    passage = say(60)
    more = bad_docs(spark, [passage, f"{passage}\n{say(3)}"]).unionByName(docs.select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    kept = {r.doc_id: bytes(r.raw) for r in substring_dedup.remove_repeats(more).select("doc_id", F.expr("cast(text AS binary)").alias("raw")).collect()}
    assert all(kept[i] == kept[100 + i] == b for i, b in enumerate(BAD)) and len(kept[11].split()) == 3


def test_texts_beyond_a_slice(spark):
    words = [f"k{i % 70_000}x{i}" for i in range(420_000)]
    long = " ".join(words)
    assert len(long) > common.CHUNK_BYTES
    near = " ".join([*words[:200_000], "changed", *words[200_001:]])
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, near), (4, " ".join(words[1000:1100])), (5, "")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id: r.n_words for r in quality_rules.repetition_measures(docs).collect()} == {1: 420_000, 2: 1, 3: 420_000, 4: 100, 5: 0}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, (90, 100)).collect()} == {1: (419_998, 1), 2: (1, 2), 3: (419_998, 1), 4: (98, 4), 5: (0, 5)}
    spans = {r.doc_id: [(s.first, s.size, s.removed) for s in r.spans] for r in substring_dedup.repeated_spans(docs).collect()}
    assert spans[4] == [(0, 100, True)] and sum(n for _, n, gone in spans[3] if gone) >= 419_000
    items = spark.createDataFrame([(1, " ".join(words[300_000:300_040])), (2, say(30))], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()) == [(1, 1), (3, 1)]
    counts = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PIECE).collect()}
    assert counts[1][0] == len(long) and counts[1][1] > 420_000 and counts[5] == (0, 0)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.net/x").alias("url"), F.col("text").alias("html"))
    assert {r.page_id: r.payload_bytes for r in warc.archive_pages(pages).collect()} == {1: len(long), 2: 5, 3: len(near), 4: len(" ".join(words[1000:1100])), 5: 0}
    deep = spark.createDataFrame([(1, "http://a.net/" + "x" * 4_500_000), (2, "http://a.net/" + "y/" * 3000)], "page_id long, url string")
    assert url_filter.judge_urls(deep, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 2


def test_clashing_columns(spark):
    passage = say(80)
    rows = [(i, passage + " " + say(5), "a", "b", "c", "d") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _copies string, _copy string, component string, node string")
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and {r._copies for r in out.collect()} == {"a"}
    assert jaccard_join.keep_one(docs).count() == 1 and jaccard_join.keep_one(docs).columns == docs.columns
    pieces = spark.createDataFrame([(i, 100, "x", "y", 9, 9) for i in range(90)], "id long, length long, _item string, _bin string, offset long, sequence_id long")
    packed = packing.pack_pieces(pieces, 4096)
    assert set(packed.columns) == set(pieces.columns) and {(r._item, r._bin) for r in packed.collect()} == {("x", "y")} and packed.select("sequence_id").distinct().count() == 3
    items = spark.createDataFrame([(1, passage, 0, "w")], "item_id long, text string, n_shingles int, h string")
    assert decontaminate.contaminated(docs.withColumn("item_id", F.lit(1)).withColumn("h", F.lit(2)), items).count() == 3
    assert decontaminate.drop_contaminated(docs.withColumn("_found", F.lit(1)), items).count() == 0


def test_token_counts_of_repeated_rows_and_nulls(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens > 0) for r in token_counts.count_tokens(docs, PIECE).collect())
    assert got == Counter({(1, 3, True): 2, (None, 3, True): 1, (None, 0, False): 1})


def test_folder_of_a_cluster_must_be_named(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Cluster.conf)

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Cluster, "x")


# --- packing

def fewest(lengths, capacity):
    """The exact optimum by branch and bound."""
    best, order = [len(lengths)], sorted(lengths, reverse=True)

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(order):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= order[i]}.values():
            rooms[k] -= order[i]
            place(i + 1, rooms)
            rooms[k] += order[i]
        place(i + 1, [*rooms, capacity - order[i]])

    place(0, [])
    return best[0]


def test_few_pieces_are_packed_optimally():
    gen = np.random.default_rng(5)
    for k in range(120):
        lengths = gen.integers(5, 70, gen.integers(1, 11))
        bins, made = packing.evolution(lengths, [], 100, k)
        assert len(bins) == fewest(lengths.tolist(), 100) and made >= packing.CROSSOVERS


def test_packings_evolve_by_crossover_and_migration(spark):
    sf = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(sf):
        pytest.skip("no driver tables")
    lengths = np.array([min(4095, 1 + r.n_chars // 4) for r in spark.read.parquet(sf).select("n_chars").collect()], np.int64)
    todo = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "_item long, length long")
    rows = packing._pack_round(todo, 3, 4096, 1).select("_item", "_bin", "length", "crossovers").collect()
    assert min(r.crossovers for r in rows) >= 2 * packing.CROSSOVERS and len({r._item for r in rows}) == len(lengths)
    start = packing.random_grouping(lengths, 4096, np.random.default_rng(1))
    grown, made = packing.evolution(lengths, [], 4096, 1)
    assert made >= packing.CROSSOVERS and packing.fitness(lengths, grown, 4096) < packing.fitness(lengths, start, 4096)
    best = packing.best_fit(lengths, list(range(len(lengths))), [], 4096)
    assert len(packing.evolution(lengths, [grown, start], 4096, 2)[0]) <= len(best)
    pieces = spark.createDataFrame([(int(n),) for n in lengths], "length long")
    assert packing.pack_pieces(pieces, 4096, shard_pieces=300).select("sequence_id").distinct().count() <= len(best) + 1


# --- WARC

def records(data: bytes):
    """(fields, block) of each record of a WARC file, read by the standard's rules alone."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].split(b"\r\n")
        assert version == b"WARC/1.1"
        fields = dict(x.split(b": ", 1) for x in lines)
        size = int(fields[b"Content-Length"])
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4


def test_warc_files_that_any_reader_opens(spark, tmp_path):
    html = [(1, "http://a/", "x" * 500), (2, "http://b/", "x" * 500), (2, "http://b/", "x" * 500), (None, None, "y"), (None, None, "y"), (3, "http://c/", "é\r\n\r\n" * 300), (4, "http://d/", None)]
    pages = spark.createDataFrame(html, "page_id long, url string, html string").repartition(2)
    warc.write_archive(pages, str(tmp_path / "archive"), chunk_bytes=64, date="2024-01-02T03:04:05Z")
    n = warc.export_warc(spark, str(tmp_path / "archive"), str(tmp_path / "files"))
    found = sorted((tmp_path / "files").glob("*.warc"))
    assert len(found) == n and not list((tmp_path / "files").glob(".part*"))
    held = [r for f in found for r in records(f.read_bytes())]
    assert len(held) == len(html) == len({f[b"WARC-Record-ID"] for f, _ in held})
    for fields, block in held:
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields) and fields[b"WARC-Date"] == b"2024-01-02T03:04:05Z"
        uuid.UUID(fields[b"WARC-Record-ID"].decode().removeprefix("<urn:uuid:").removesuffix(">"))
        payload = block.split(b"\r\n\r\n", 1)[1]
        page = int(fields[b"Page-ID"]) if fields[b"Page-ID"] else None
        want = next(h or "" for i, _, h in html if i == page).encode()
        assert payload == (b"" if fields[b"WARC-Type"] == b"revisit" else want)
    assert Counter(f[b"WARC-Type"] for f, _ in held) == {b"response": 5, b"revisit": 2}


# --- URL templates

def test_branches_part_at_any_depth(spark):
    rows = [(i, f"http://deep.net/a/b/c/d/{'bad' if i % 2 else 'good'}/{i}.html") for i in range(400)]
    pages = spark.createDataFrame([*rows, (1001, "http://deep.net/a/b/c/d/bad/77.html"), (1002, "http://deep.net/" + "z/" * 60), (1003, "http://other.net/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, labels).collect()}
    assert len(got) == 403 and all(got[i].verdict == ("block" if i % 2 else "allow") for i in range(400))
    assert got[1001].verdict == "block" and got[1003].verdict == "allow" and got[1001].template == "/*/*/*/*/bad/{num}.html"


# --- substring dedup

def test_edited_lines_against_all_pairs(spark):
    """Pairs of lines of Jaccard 0.8 or more are found, however they lie, and the removed words are the keeper's or within the threshold of them."""
    docs = []
    for k in range(40):
        base = say(rng.randint(60, 160)).split()
        docs.append((10 * k, "\n".join([say(60), " ".join(base), say(7)])))
        for c in (1, 2):
            w = list(base)
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = say(1)
            docs.append((10 * k + c, "\n".join([say(20), " ".join(w), say(90)])))
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    lines = [(d, sets(x.split())) for d, t in docs for x in t.split("\n") if len(x.split()) >= 50]
    linked = {max(a, b) for a, s in lines for b, t in lines if a != b and len(s & t) >= 0.8 * len(s | t)}
    got = substring_dedup.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    gone = {r.doc_id for r in got if any(s.removed for s in r.spans)}
    assert linked and len(linked - gone) <= 0.02 * len(linked)
    texts = dict(docs)
    for r in got:
        for s in r.spans:
            if s.removed:
                mine, theirs = texts[r.doc_id].split()[s.first : s.first + s.size], sets(texts[s.keeper].split())
                assert len(sets(mine) & theirs) >= 0.6 * len(sets(mine)) and s.size >= substring_dedup.SPAN


def test_passages_come_through_bands(spark):
    passage = say(51).split()
    docs = [(i, " ".join(say(rng.randint(1, 90)).split() + passage + say(rng.randint(1, 90)).split())) for i in range(30)] + [(100 + i, say(200)) for i in range(30)]
    docs += [(200, " ".join(passage[:45] + say(100).split()))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = substring_dedup.paragraph_repeats(df).where("block").select("doc_id").distinct().collect()
    assert {r.doc_id for r in found} >= set(range(30))
    spans = {r.doc_id: [(s.size, s.removed) for s in r.spans] for r in substring_dedup.repeated_spans(df).collect()}
    assert spans == {i: [(51, i > 0)] for i in range(30)}  # 45 words of it don't count


# --- decontamination

def test_short_items_are_found_whole(spark):
    items = spark.createDataFrame([(1, "Alpha"), (2, "beta, gamma"), (3, "one two three four"), (4, "!"), (5, "a b c d e f"), (6, "x y"), (6, "k l m n o")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the alpha."), (2, "beta x gamma"), (3, "Beta GAMMA one two three"), (4, "zero one two three four"), (5, "a b c d e f"), (6, "x y"), (7, "x y k l m n o"), (8, None), (9, "")], "doc_id long, text string")
    got = {tuple(r) for r in decontaminate.contaminated(docs, items, short_items=True).collect()}
    assert got == {(1, 1, 1, 1), (3, 2, 1, 1), (4, 3, 1, 1), (5, 5, 2, 2), (7, 6, 2, 2)}
    assert {r.doc_id for r in decontaminate.contaminated(docs, items).collect()} == {5, 7}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items, short_items=True).collect()} == {2, 6, 8, 9}
