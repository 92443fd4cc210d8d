"""Token counts by rank-synchronous array merging (operator 8).

A sentencepiece BPE model merges, again and again, the adjacent pair whose union is the best piece (ties: leftmost). No piece of
the model has a space mark after another letter, so text falls apart exactly before each run of space marks: these
pre-tokens are independent. A batch's distinct pre-tokens lie in one ragged numpy array of symbols; each round finds every
sequence's lowest-rank pair and merges it in all sequences at once; what survives is counted. Symbols that are no piece count
their UTF-8 bytes, as byte fallback does.

A round looks at all symbols left, so a long pre-token (text without spaces) would ask for many rounds over all of it. It is first cut wherever no piece
that occurs in it lies across: no symbol ever forms there, so both sides merge as if alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import mix64, text_chunks

#: Pre-tokens whose counts a worker remembers before it starts afresh.
CACHE_WORDS = 400_000
NO_PAIR = np.int64(1 << 62)
SPACE = "▁"
#: Letters of a pre-token from which it is cut.
LONG = 48


class MergeTable:
    """Pieces of a sentencepiece BPE model as symbols, and ranked merges between symbols."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in usable}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece has a space mark inside: texts can't be cut before spaces")
        self.letters = {p: i for i, p in enumerate(pieces)}
        self.n = len(self.letters)
        self.grams = self._grams(pieces)
        # one rank for equal scores: ties go to the leftmost pair
        ranks = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        keys, made, rank = [], [], []
        extra = self.letters.copy()
        for p, score in pieces.items():
            for k in range(1, len(p)):
                if p[:k] in extra and p[k:] in extra:
                    keys.append(extra[p[:k]] * self.n + extra[p[k:]])
                    made.append(extra[p])
                    rank.append(ranks[score])
        order = np.argsort(keys)
        self.keys, self.made, self.rank = np.array(keys, np.int64)[order], np.array(made, np.int64)[order], np.array(rank, np.int64)[order]
        # a piece is safe if no merge of it with a neighbour outranks its own making: then all its places may merge at once
        own = np.full(self.n, -1, np.int64)
        np.maximum.at(own, self.made, self.rank)
        left, right = self.keys // self.n, self.keys % self.n
        self.safe = np.ones(self.n, bool)
        self.safe[left[self.rank <= own[left]]] = False
        self.safe[right[self.rank <= own[right]]] = False

    def _grams(self, pieces: dict[str, float]) -> list[np.ndarray]:
        """For each length from 2 the sorted hashes of the pieces that have it."""
        by_length: dict[int, list[str]] = {}
        for p in pieces:
            by_length.setdefault(len(p), []).append(p)
        out = []
        for n in range(2, max(by_length, default=1) + 1):
            some = by_length.get(n, [])
            codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(len(some), n).astype(np.uint64)
            out.append(np.sort(_rolled(codes.T)))
        return out

    def cut(self, word: str) -> list[str]:
        """The word in parts between which no piece lies that occurs in it. A false match of hashes only cuts less."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        # begun less ended pieces over the border before each letter
        across = np.zeros(len(codes) + 1, np.int64)
        key = mix64(codes)
        for n, grams in enumerate(self.grams, 2):
            if n > len(codes):
                break
            key = _grown(key[:-1], codes[n - 1 :])
            if len(grams):
                hit = np.flatnonzero(grams[np.minimum(np.searchsorted(grams, key), len(grams) - 1)] == key)
                across[hit + 1] += 1
                across[hit + n] -= 1
        at = [0, *(np.flatnonzero(np.cumsum(across)[1:-1] == 0) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; NO_PAIR where they don't merge."""
        key = np.where((a < 0) | (b < 0), -1, a * self.n + b)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NO_PAIR), self.made[at]


def _grown(key: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return mix64(key * np.uint64(0x9E3779B97F4A7C15) + codes)


def _rolled(columns: np.ndarray) -> np.ndarray:
    """Hashes of strings whose letters stand in columns."""
    key = mix64(columns[0])
    for codes in columns[1:]:
        key = _grown(key, codes)
    return key


def count_symbols(symbols: np.ndarray, weights: np.ndarray, lengths: np.ndarray, table: MergeTable) -> np.ndarray:
    """Tokens of each sequence. symbols: piece numbers, -1 for letters that are no piece; weights: tokens that a letter left alone makes."""
    count = np.zeros(len(lengths), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    symbols, weights = symbols.copy(), weights.copy()
    same = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
    rank, made = np.full(len(symbols), NO_PAIR), np.zeros(len(symbols), np.int64)
    at = np.flatnonzero(same)
    rank[at], made[at] = table.pairs(symbols[at], symbols[at + 1])
    while len(owner):
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.minimum.reduceat(rank, heads)
        sizes = np.diff(np.append(heads, len(owner)))
        over = best == NO_PAIR
        if over.any():  # sequences without a pair leave
            gone = np.repeat(over, sizes)
            np.add.at(count, owner[gone], weights[gone])
            stay = ~gone
            symbols, weights, owner, rank, made = symbols[stay], weights[stay], owner[stay], rank[stay], made[stay]
            if not len(owner):
                break
            sizes, best = sizes[~over], best[~over]
            heads = np.cumsum(sizes) - sizes
        hit = np.flatnonzero(rank == np.repeat(best, sizes))
        first = np.append(True, owner[hit[1:]] != owner[hit[:-1]])
        # every place of the pair, if its product is safe and it is the same product throughout; else only the leftmost
        lead = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        merge = first | (table.safe[made[hit]] & (made[hit] == made[hit[lead]]))
        mixed = np.zeros(len(count), bool)
        mixed[owner[hit[~merge]]] = True
        merge &= first | ~mixed[owner[hit]]
        hit = hit[merge]
        # in a run of overlapping places, every other one
        start = np.append(True, np.diff(hit) > 1)
        run = np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        symbols[hit], weights[hit] = made[hit], 1
        keep = np.ones(len(owner), bool)
        keep[hit + 1] = False
        place = np.cumsum(keep) - 1
        symbols, weights, owner, rank, made = symbols[keep], weights[keep], owner[keep], rank[keep], made[keep]
        hit = place[hit]
        touched = np.unique(np.concatenate([hit, np.maximum(hit - 1, 0)]))
        inside = touched[touched < len(owner) - 1]
        inside = inside[owner[inside] == owner[inside + 1]]
        rank[touched] = NO_PAIR
        rank[inside], made[inside] = table.pairs(symbols[inside], symbols[inside + 1])
    return count


class TokenCounter:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.table, self.cache_words = MergeTable(path), cache_words
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        """Token counts of pre-tokens, all merged together."""
        letters = self.table.letters
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, at = np.unique(codes, return_inverse=True)
        number = np.array([letters.get(chr(c), -1) for c in distinct], np.int64)
        weight = np.array([1 if n >= 0 else len(chr(c).encode()) for c, n in zip(distinct, number)], np.int64)
        return count_symbols(number[at], weight[at], np.fromiter(map(len, words), np.int64, len(words)), self.table)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        if len(self.known) > self.cache_words:
            self.known.clear()
        words: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = [part for w in pre_tokens(text.decode("utf-8", "replace")) for part in (self.table.cut(w) if len(w) >= LONG else (w,))]
                sizes[i] = len(found)
                words += found
        new = list(set(words).difference(self.known))
        for a in range(0, len(new), 100_000):
            some = new[a : a + 100_000]
            self.known.update(zip(some, self.words(some).tolist()))
        each = np.concatenate([[0], np.cumsum(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))])
        ends = np.cumsum(sizes)
        return each[ends] - each[ends - sizes]


def pre_tokens(text: str) -> list[str]:
    """The text after the model's dummy prefix and space marks, cut before each run of space marks."""
    if SPACE in text:
        return cut_marks(SPACE + text.replace(" ", SPACE))
    out: list[str] = []
    run = 1
    for part in text.split(" "):
        if part:
            out.append(SPACE * run + part)
            run = 1
        else:
            run += 1
    if run > 1:
        out.append(SPACE * (run - 1))
    return out


def cut_marks(text: str) -> list[str]:
    """For text that itself holds space marks: cut where a mark follows another letter."""
    at = [0, *(i for i in range(1, len(text)) if text[i] == SPACE != text[i - 1]), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:])]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for docs(doc_id long, text string, ...).

    A null or empty text has 0 bytes and 0 tokens; repeated rows each give a row; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(model)
        for part, texts in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(counter.counts(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
