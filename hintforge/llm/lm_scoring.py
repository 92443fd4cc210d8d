"""Language-model scoring with a log-frequency Bloom filter (operator 5).

Training documents are those whose crc32(doc_id as text) mod 5 is not 1. Counting: each task sums its n-grams and sends them,
packed in numpy arrays, to shards by hash, so a hot word costs a shard one entry a chunk; the number of shards follows the text.
A shard's bigram counts are quantised, level(c) = 1 + floor(log c / log LOG_BASE), and (bigram, 1) ... (bigram, level) go into the shard's Bloom
filter; a probe asks for level 1, 2, ... until one is missing, which keeps errors low and one-sided. Unigram counts stay exact, as the base score
needs them so.

Score of a word w after v: p(w | v) = (q(vw) + MU p1(w)) / (c(v) + MU), where q is the least count of the level found, p1 the smoothed
unigram share of the base score and c(v) an exact count; sums over w do not exceed one but for false positives.

Unigrams fall into word classes by the word's hash, and bigrams by their second word's, then by their own. A pass broadcasts the unigrams of
a run of classes and some of these classes' filters, together at most `broadcast_bytes` (or one class's unigrams with one filter, if these alone are more), and
adds log(q + MU p1) of the tokens that it holds, and, once a run, -log(c(v) + MU) of the tokens whose history it holds. A document's score is
the sum over passes; their number grows with the tables, and one serves until these outgrow the bound.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import mix64, segment_ids, stored, text_chunks

FOLDS, HELD_OUT = 5, 1
#: Quantisation, hashes and bits of a filter entry, pseudo-count of the unigram model.
LOG_BASE, HASHES, ENTRY_BITS, MU = 1.5, 6, 9, 400.0
#: Text of one shard, bytes that are broadcast at once, classes of words at most.
SHARD_TEXT, BROADCAST_BYTES, CLASSES = 12 << 20, 160 << 20, 64
END, BEGIN = xxhash.xxh3_64_intdigest(b" end"), xxhash.xxh3_64_intdigest(b" begin")
CHUNK = 1 << 20
#: Keys that are probed at a time, which bounds what a probe holds besides the filters.
PROBED = 1 << 14


def held_out(doc_id: int | None) -> bool:
    """A null doc_id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(LOG_BASE) + 1e-9).astype(np.int64)


#: The least count of each level; index 0: none.
LEAST = np.concatenate([[0.0], np.ceil(LOG_BASE ** np.arange(0, 120.0) - 1e-9)])


class LogFrequencyFilter:
    """A Bloom filter of (key, level) entries for 64-bit keys."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.m = bits, np.uint64(len(bits) * 8)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, entry_bits: int = ENTRY_BITS) -> LogFrequencyFilter:
        levels = level(counts)
        new = cls(np.zeros(max(8, int(levels.sum()) * entry_bits // 8), np.uint8))
        for j in range(1, int(levels.max(initial=0)) + 1):
            for at in new._places(keys[levels >= j], j):
                np.bitwise_or.at(new.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        return new

    def _places(self, keys: np.ndarray, j: int) -> Iterator[np.ndarray]:
        a = mix64(keys + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64))
        step = (a >> np.uint64(32)) | np.uint64(1)
        for i in range(HASHES):
            yield (a + np.uint64(i) * step) % self.m

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: 0 if it was never put in, too high at times, never too low."""
        return FilterBank({0: self.bits}).levels(keys, np.zeros(len(keys), np.int64))


class FilterBank:
    """Filters by number, their bits one after the other, so that keys of many filters are looked up at once."""

    def __init__(self, filters: dict[int, np.ndarray]):
        self.numbers = np.array([*filters], np.int64)
        self.sizes = np.array([len(b) for b in filters.values()], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bits = [*filters.values()][0] if len(filters) == 1 else np.concatenate([np.zeros(0, np.uint8), *filters.values()])

    def levels(self, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The level of each key in the filter at that place of `numbers`."""
        out, modulus = np.zeros(len(keys), np.int64), (self.sizes * 8).astype(np.uint64)
        # in order of filters, so that one after the other is in the processor's cache
        order = np.argsort(at.astype(np.uint16) if len(self.numbers) < 1 << 16 else at, kind="stable")
        for left in np.split(order, range(PROBED, len(order), PROBED)):
            j = 1
            while len(left):
                a, own = mix64(keys[left] + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64)), at[left]
                step, m, start = (a >> np.uint64(32)) | np.uint64(1), modulus[own], self.starts[own]
                inside = np.ones(len(left), bool)
                for i in range(HASHES):
                    place = (a + np.uint64(i) * step) % m
                    inside &= (self.bits[start + (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    some = np.flatnonzero(inside)
                    if 4 * len(some) < 3 * len(left):
                        left, a, step, m, start, inside = left[some], a[some], step[some], m[some], start[some], inside[some]
                    if not len(some):
                        break
                left = left[inside]
                out[left] = j
                j += 1
        return out


class WordCounts:
    """Exact counts of sorted 64-bit keys, nine bytes a key: counts of MANY and more are held apart, in order."""

    MANY = 255

    def __init__(self, keys: np.ndarray, few: np.ndarray, many: np.ndarray):
        self.keys, self.few, self.many, self.places = keys, few, many, np.flatnonzero(few == self.MANY)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = np.where(self.keys[at] == keys, self.few[at], 0).astype(np.int64)
        big = np.flatnonzero(found == self.MANY)
        found[big] = self.many[np.searchsorted(self.places, at[big])]
        return found


def bigram(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * np.uint64(0x9E3779B97F4A7C15) + w)


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word keys (END is number 0), the texts' word numbers with an end after each text, and tokens of each text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.lower().split()
        counts[i] = len(found)
        words += found
    distinct = dict.fromkeys(words)
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    number = dict(zip(distinct, range(1, len(distinct) + 1)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return np.concatenate([[np.uint64(END)], keys]), np.insert(ids, np.cumsum(counts), 0), counts + 1


def histories(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The key before each token; BEGIN before a text's first."""
    before = np.concatenate([[np.uint64(BEGIN)], tokens[:-1]])
    before[(np.cumsum(counts) - counts)] = np.uint64(BEGIN)
    return before


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, in order of keys."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key, of `parts` equal ranges of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def count_ngrams(docs: DataFrame, classes: int, parts: int) -> DataFrame:
    """kind (1 unigrams, 2 bigrams), class, part, keys, counts: sums over slices of the training documents, 64-bit keys as binary arrays."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, limit=CHUNK):
            train = [t for t, d in zip(texts, part.column("doc_id").to_pylist()) if not held_out(d)]
            if not train:
                continue
            keys, ids, counts = coded(train)
            tokens = keys[ids]
            pairs = bigram(histories(tokens, counts), tokens)
            order = np.argsort(pairs)
            first = np.flatnonzero(np.append(True, pairs[order][1:] != pairs[order][:-1]))
            times, second = np.diff(first, append=len(order)), tokens[order[first]]
            pairs = pairs[order[first]]
            words = np.bincount(ids, minlength=len(keys))
            seen = words > 0
            out: dict[str, list] = {"kind": [], "class": [], "part": [], "keys": [], "counts": []}
            for kind, k, c, where in ((1, keys[seen], words[seen], part_of(keys[seen], classes) * parts), (2, pairs, times, part_of(second, classes) * parts + part_of(pairs, parts))):
                to = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[to], np.arange(classes * parts + 1))
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    at = to[cuts[s] : cuts[s + 1]]
                    out["kind"].append(kind), out["class"].append(s // parts), out["part"].append(s % parts)
                    out["keys"].append(k[at].tobytes()), out["counts"].append(c[at].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("kind", pa.int32()), ("class", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "kind int, class int, part int, keys binary, counts binary")


def tables(counts: DataFrame, entry_bits: int = ENTRY_BITS) -> DataFrame:
    """kind, class, part, n_types, n_tokens, and in a to c keys and counts (unigrams, see WordCounts) or the filter's bits (bigrams)."""

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        keys, n = summed(np.frombuffer(b"".join(part["keys"]), np.uint64), np.frombuffer(b"".join(part["counts"]), np.uint32).astype(np.int64))
        row = {"kind": key[0], "class": key[1], "part": key[2], "n_types": len(keys), "n_tokens": int(n.sum()), "a": b"", "b": b"", "c": b""}
        if key[0] == 1:
            row |= {"a": keys.tobytes(), "b": np.minimum(n, WordCounts.MANY).astype(np.uint8).tobytes(), "c": n[n >= WordCounts.MANY].tobytes()}
        else:
            row |= {"a": LogFrequencyFilter.of(keys, n, entry_bits).bits.tobytes()}
        return pd.DataFrame([row])

    return counts.groupBy("kind", "class", "part").applyInPandas(build, "kind int, class int, part int, n_types long, n_tokens long, a binary, b binary, c binary")


def passes(words: dict[int, int], pairs: dict[tuple[int, int], int], classes: int, bound: int) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
    """(run of classes, filters) of each pass: bytes of words by class, of filters by class and part. Every class is in one run, every filter in one
    pass; a run's first pass is the one that counts words."""
    runs, held = [[0, 0]], 0
    for c in range(classes):
        size = words.get(c, 0)
        if held and held + size > bound // 2:
            runs.append([c, c])
            held = 0
        runs[-1][1] = c + 1
        held += size
    out = []
    for first, stop in runs:
        base = sum(words.get(c, 0) for c in range(first, stop))
        some: list[tuple[int, int]] = []
        used, began = base, len(out)
        for at in sorted(p for p in pairs if first <= p[0] < stop):
            if some and used + pairs[at] > bound:
                out.append(((first, stop), some))
                some, used = [], base
            some.append(at)
            used += pairs[at]
        if some or len(out) == began:
            out.append(((first, stop), some))
    return out


def score_documents(docs: DataFrame, shard_text: int = SHARD_TEXT, broadcast_bytes: int = BROADCAST_BYTES, entry_bits: int = ENTRY_BITS, mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of docs(doc_id long, text string, ...).

    A null or white text has its end as only token; a null doc_id counts as empty text for the split; rows equal in doc_id and text
    give equal rows. Without training documents every count is 0. An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_text))
    classes = min(CLASSES, max(1, math.isqrt(shards)))
    parts = -(-shards // classes)
    made = stored(tables(count_ngrams(docs, classes, parts), entry_bits), "lm")
    sizes = made.select("kind", "class", "part", "n_types", "n_tokens", (F.octet_length("a") + F.octet_length("b") + F.octet_length("c")).alias("size")).collect()  # a row for each shard
    n, v = (sum(r[c] for r in sizes if r.kind == 1) for c in ("n_tokens", "n_types"))
    plan = passes({r["class"]: r.size for r in sizes if r.kind == 1}, {(r["class"], r.part): r.size for r in sizes if r.kind == 2}, classes, broadcast_bytes)
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def unigrams(first: int, stop: int) -> WordCounts:
        found = made.where((F.col("kind") == 1) & F.col("class").between(first, stop - 1)).orderBy("class").select("a", "b", "c").toLocalIterator()
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64))]
        for r in found:  # classes are ranges of keys, so this is in order of keys
            held.append((np.frombuffer(r.a, np.uint64), np.frombuffer(r.b, np.uint8), np.frombuffer(r.c, np.int64)))
        return WordCounts(*(np.concatenate(x) for x in zip(*held)))

    def filters(some: list[tuple[int, int]]) -> FilterBank:
        ids = [c * parts + p for c, p in some]
        number = F.col("class").cast("long") * parts + F.col("part")
        found = made.where((F.col("kind") == 2) & number.between(ids[0], ids[-1])) if ids else made.limit(0)
        return FilterBank({r.id: np.frombuffer(r.a, np.uint8) for r in found.select(number.alias("id"), "a").toLocalIterator()})

    every = np.array([r["class"] * parts + r.part for r in sizes if r.kind == 2], np.int64)
    out, before = None, None
    for run, some in plan:
        shared = spark.sparkContext.broadcast((unigrams(*run), filters(some)))
        scored = rows.mapInArrow(_scorer(shared, run, run != before, every, classes, parts, n, v, mu), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        before = run
        if len(plan) > 1:  # a pass is written before the next one's tables are gathered
            scored = stored(scored, "pass")
            shared.destroy()
        out = scored if out is None else out.unionByName(scored)
    if len(plan) > 1:  # each pass gave a part; rows equal in doc_id and text share a sum and are divided again by their number
        key = ["row", "doc_id", "held_out", "n_tokens"]
        out = out.groupBy(*key).agg((F.count("*") / len(plan)).cast("int").alias("k"), *(F.sum(x).alias(x) for x in ("n_known", "base_score", "score")))
        out = out.select(*key, F.explode(F.sequence(F.lit(1), F.col("k"))), (F.col("n_known") / F.col("k")).cast("long").alias("n_known"), *((F.col(x) / F.col("k")).alias(x) for x in ("base_score", "score")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _scorer(shared, run: tuple[int, int], counts_words: bool, every: np.ndarray, classes: int, parts: int, n: int, v: int, mu: float):
    """A pass over all documents; `row` is a hash of doc_id and text that joins a row's parts, `every` the numbers of all filters."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, filters = shared.value
        slot, made = np.full(classes * parts, -1), np.zeros(classes * parts, bool)
        slot[filters.numbers] = np.arange(len(filters.numbers))
        made[every] = True

        for part, texts in text_chunks(batches, limit=CHUNK):
            names = part.column("doc_id").to_pylist()
            keys, ids, counts = coded(texts)
            doc = segment_ids(counts)
            of = part_of(keys, classes)
            here = (of >= run[0]) & (of < run[1])
            count = np.where(here, known.of(keys), 0)
            p1 = (count + 0.5) / (n + 0.5 * (v + 1))
            tokens = keys[ids]
            pair = bigram(histories(tokens, counts), tokens)
            shard = of[ids] * parts + part_of(pair, parts)
            levels, mine = np.zeros(len(ids), np.int64), slot[shard] >= 0
            levels[mine] = filters.levels(pair[mine], slot[shard[mine]])
            if counts_words:  # a bigram whose shard has no filter was never seen
                mine |= here[ids] & ~made[shard]
            total = np.where(mine, np.log10(LEAST[levels] + mu * p1[ids]), 0.0)
            base, held = np.zeros(len(ids)), np.zeros(len(ids), bool)
            if counts_words:
                # a text begins as often as training texts end
                before = np.concatenate([[0], ids[:-1]])
                before[np.cumsum(counts) - counts] = 0
                total -= np.where(here[before], np.log10(count[before] + mu), 0.0)
                base, held = np.where(here[ids], np.log10(p1[ids]), 0.0), count[ids] > 0
            add = lambda x: np.bincount(doc, x, len(texts))
            row = [xxhash.xxh3_64_intdigest(t, seed=7) - 2**63 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(names, pa.int64()), pa.array([held_out(d) for d in names]), pa.array(counts, pa.int64()), pa.array(add(held).astype(np.int64)), pa.array(add(base)), pa.array(add(total))],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return score
