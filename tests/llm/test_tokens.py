"""Token codes, token counts and packing against the libraries themselves."""

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from hintforge.llm import packing, token_codes, token_counts  # noqa: E402
from hintforge.llm.tokenizing import WordTokenizer  # noqa: E402

WORD, PIECE = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   a  b ", "a\nb\n\n c", "it's DON'T we'll", "x<|endoftext|>y <|startoftext|>", "a\x1cb c\x0bd\x0ce", "a\x85b\xa0c", "İ ß ﬁ 123 ½²",
    "日本語のテキスト。", "▁▁a▁ b▁", "x▁  ", "  ▁", "<s></s><unk><0x0A>", "a" * 500, "ab" * 300, "\x00\x01", "😀😀 é ́", "the" * 700,
]
rng = random.Random(5)
ODD += ["".join(rng.choice("ab ▁the\nré日 'sÀ,.") for _ in range(rng.randint(1, 60))) for _ in range(400)]
ODD += ["".join(rng.choice("etaoinshrdlu ") for _ in range(rng.randint(1, 300))) for _ in range(100)]


def frame(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_word_tokenizer_equals_library():
    words = WordTokenizer(WORD, cache_words=50)
    for texts in (ODD[:20], ODD[20:300], ODD[300:]):
        ids, counts = words.ids([t.encode() for t in texts])
        for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            assert got.tolist() == words.library.encode(t, add_special_tokens=False).ids, t


def test_word_tokenizer_keeps_the_most_used_words(monkeypatch):
    words, learnt = WordTokenizer(WORD, cache_words=50), []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda new: (learnt.extend(new), learn(new))[1])
    for k in range(20):
        text = b" often" * 3 + b"".join(b" rare%d" % (40 * k + i) for i in range(40))
        ids, counts = words.ids([text])
        assert ids.tolist() == words.library.encode(text.decode(), add_special_tokens=False).ids and counts.tolist() == [len(ids)]
    assert learnt.count(b"often") == 1


def test_counts_equal_sentencepiece(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r.doc_id: r for r in token_counts.count_tokens(frame(spark, [*ODD, None]), PIECE, 100).collect()}
    for i, t in enumerate([*ODD, None]):
        n = len(model.encode(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 100), t


@pytest.mark.parametrize("bits", [8, 16])
def test_segment_round_trip_and_random_access(bits):
    gen = np.random.default_rng(1)
    ids = gen.integers(0, [200, 70_000, 2**32][int(bits == 16)], 5000).astype(np.uint32)
    ids[::7] = 2**31 + 5
    counts = np.array([0, 1, 4000, 999, 0])
    s = token_codes.Segment(token_codes.encode_segment([3, None, -5, 7, 7], counts, ids, bits))
    assert s.doc_ids == [3, None, -5, 7, 7] and (s.tokens(np.arange(5000)) == ids).all()
    at = gen.integers(0, 5000, 300)
    assert (s.tokens(at) == ids[at]).all() and (s.document(2) == ids[1:4001]).all()


@pytest.mark.parametrize("bits", [8, 16])
def test_segment_read_in_order(bits):
    gen = np.random.default_rng(2)
    for n, most in ((0, 5), (1, 2**32), (64, 200), (5000, 70_000), (5000, 2**32)):
        ids = gen.integers(0, most, n).astype(np.uint32)
        s = token_codes.Segment(token_codes.encode_segment([1], np.array([n]), ids, bits))
        assert (s.every() == ids).all() and (s.every() == s.tokens(np.arange(n))).all()


def test_codes_table(spark, monkeypatch):
    monkeypatch.setattr(token_codes, "SEGMENT_TOKENS", 500)
    docs = frame(spark, [*ODD, None]).repartition(5)
    library = WordTokenizer(WORD).library
    place = 0
    got = sorted(token_codes.encode_documents(docs, WORD).collect())
    assert len(got) == len(ODD) + 1
    for r, t in zip(got, [*ODD, None]):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)


def test_codes_nulls_ties_and_empty(spark):
    docs = spark.createDataFrame([(None, "b"), (1, "c"), (1, "a"), (None, None)], "doc_id long, text string")
    rows = token_codes.encode_documents(docs, WORD).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 1] and [r.n_tokens for r in rows] == [1, 2, 2, 2]
    assert token_codes.encode_documents(docs.limit(0), WORD).count() == 0
    assert token_counts.count_tokens(docs.limit(0), PIECE).count() == 0


def check_packing(rows, lengths, capacity):
    assert len(rows) == len(lengths)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_is_whole_and_tight(spark):
    gen = np.random.default_rng(3)
    lengths = [int(x) for x in np.minimum(gen.lognormal(6, 1, 3000), 4096)]
    pieces = spark.createDataFrame([(i, n, 5) for i, n in enumerate(lengths)], "doc_id long, length long, offset long").repartition(3)
    bins = check_packing(packing.pack_pieces(pieces, 4096, shard_pieces=150).collect(), lengths, 4096)
    assert bins <= 1.01 * -(-sum(lengths) // 4096) + 1


def test_pack_documents(spark):
    texts = [*ODD, None, "word " * 9000]
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.limit(3))
    library = WordTokenizer(WORD).library
    rows = packing.pack_documents(docs, WORD, 1, 4096).collect()
    check_packing(rows, [None] * len(rows), 4096)
    want = []
    for i, t in [*enumerate(texts), *list(enumerate(texts))[:3]]:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, k * 4096, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(ids[a : a + 4096] for a in range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_crossover_keeps_every_document_once():
    gen = np.random.default_rng(2)
    lengths = gen.integers(1, 100, 200)
    a = packing.best_fit(lengths, list(range(200)), [], 100)
    b = packing.mutate(lengths, a, 100, gen)
    for child in (b, packing.crossover(lengths, a, b, 100, gen), packing.evolve(lengths, [a, b], 100, 1)):
        assert sorted(i for k in child for i in k) == list(range(200))
        assert all(lengths[k].sum() <= 100 for k in child)


def test_long_texts_without_spaces():
    import random
    import time

    import public_tokenizers
    import sentencepiece

    from hintforge.llm.token_counts import TokenCounter

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, gen = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    kana = "".join(map(chr, range(0x3041, 0x30FF)))
    base = letters + letters.upper() + "0123456789+/"
    for alphabet in (letters, letters + kana, base, "a", "\U0001f600é\x00▁", "acgt"):
        taken = {}
        for n in (2_000, 20_000, 200_000):
            if alphabet in ("acgt", "\U0001f600é\x00▁") and n > 20_000:
                continue
            text = "".join(gen.choice(alphabet) for _ in range(n))
            counter, began = TokenCounter(path), time.perf_counter()
            got = counter.counts([text.encode(), b"", b"x " + text.encode()])
            taken[n] = time.perf_counter() - began
            assert got.tolist() == [len(library.encode(t)) for t in (text, "", "x " + text)]
        if 200_000 in taken:
            assert taken[200_000] < max(6.0, 25 * taken[20_000])


def test_cuts_keep_what_no_piece_crosses():
    import public_tokenizers

    from hintforge.llm.token_counts import MergeTable

    table = MergeTable(public_tokenizers.path("piece_bpe_32k.model"))
    for word in ("▁theqzthe", "▁international", "▁", "éééxq", "zqzqzq"):
        parts = table.cut(word)
        at, cuts = 0, set()
        for p in parts:
            at += len(p)
            cuts.add(at)
        crossed = {k for i in range(len(word)) for j in range(i + 2, len(word) + 1) if word[i:j] in table.letters for k in range(i + 1, j)}
        assert "".join(parts) == word and cuts == set(range(1, len(word) + 1)) - crossed


def test_each_piece_goes_to_the_fullest_bin_with_room():
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 4096, 300)
    begun = [[0, 1]] if lengths[0] + lengths[1] <= 4096 else [[0], [1]]
    items = rng.permutation(np.arange(2, 300)).tolist()
    want = [list(b) for b in begun]
    for i in items:
        rooms = [(4096 - sum(lengths[x] for x in b), k) for k, b in enumerate(want)]
        fit = min((r for r in rooms if r[0] >= lengths[i]), default=None)
        want[fit[1]].append(i) if fit else want.append([i])
    assert packing.placed(lengths, items, begun, 4096) == want and packing.BIN_BITS >= 20
