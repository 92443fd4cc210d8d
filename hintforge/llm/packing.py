"""Best-fit packing by a grouping genetic algorithm (operator 9).

Documents become pieces of at most `capacity` tokens; whole pieces of that length are sequences of their own. The others are
dealt into shards of a bounded number of pieces. On each shard several islands evolve packings apart, from random groupings: a chromosome is
a list of bins; crossover injects whole well-filled bins of one parent into the other, removes the bins that hold duplicates and puts
the displaced documents back best fit, longest first. Then the elites migrate to the next island (a shuffle), are crossed with the elite there
and evolve on, and the best island's packing stands. Each island makes CROSSOVERS crossovers at least before and after the migration, and then
stops where the number of bins can't be less. A packing's better filled bins are final; the worst, with one in MERGE of the shard's pieces or so,
meet those of MERGE other shards and are packed again, until one shard is left. No shard grows with the input.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import SLICE, free_name, give_back, segment_ids, stored, text_chunks
from hintforge.llm.tokenizing import WordTokenizer

#: Pieces of a shard (on average), islands of each shard, population of an island, crossovers at least, generations at most (of few pieces
#: as many as place SMALL_WORK pieces) before and after migration.
SHARD_PIECES, ISLANDS, POPULATION, CROSSOVERS, GENERATIONS, SMALL_WORK = 4000, 2, 4, 2, 6, 4000
#: Shards whose worst bins meet in the next round, as one in so many of a shard's pieces moves on.
MERGE = 16
#: A bin's number within its shard takes the low bits of an integer.
BIN_BITS = 32
BIN_MASK = (1 << BIN_BITS) - 1
#: A bin's number within its shard takes the low bits of an integer.
BIN_BITS = 32
BIN_MASK = (1 << BIN_BITS) - 1

Packing = list[list[int]]


def best_fit(lengths: np.ndarray, items: list[int], bins: Packing, capacity: int) -> Packing:
    """Puts items, longest first, each into the fullest bin that has room."""
    return placed(lengths, sorted(items, key=lambda i: (-lengths[i], i)), bins, capacity)


def placed(lengths: np.ndarray, items: list[int], bins: Packing, capacity: int) -> Packing:
    """Puts items, in their order, each into the fullest bin that has room."""
    bins = [list(b) for b in bins]
    size_of = lengths.tolist()
    # a bin's room and number in one integer, in order of both
    room = sorted((capacity - sum([size_of[i] for i in b]) << BIN_BITS) + k for k, b in enumerate(bins))
    for i in items:
        size = size_of[i] << BIN_BITS
        at = bisect_left(room, size)
        if at < len(room):
            left = room.pop(at)
            bins[left & BIN_MASK].append(i)
            insort(room, left - size)
        else:
            bins.append([i])
            insort(room, (capacity << BIN_BITS) - size + len(bins) - 1)
    return bins


def fills(lengths: np.ndarray, bins: Packing, capacity: int) -> np.ndarray:
    """The filled share of each bin."""
    sizes = np.array([len(b) for b in bins])
    return np.add.reduceat(lengths[np.concatenate([np.asarray(b, np.int64) for b in bins])], np.cumsum(sizes) - sizes) / capacity


def fitness(lengths: np.ndarray, bins: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more uneven fill (sum of squares)."""
    return len(bins), -float((fills(lengths, bins, capacity) ** 2).sum())


def random_grouping(lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> Packing:
    """All pieces in a random order, each in the fullest bin that has room."""
    return placed(lengths, rng.permutation(len(lengths)).tolist(), [], capacity)


def crossover(lengths: np.ndarray, mother: Packing, father: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """Whole bins of the father, the better filled the likelier, go into the mother."""
    take = rng.random(len(father)) < 0.5 * fills(lengths, father, capacity) ** 8
    chosen = [b for b, t in zip(father, take) if t]
    moved = {i for b in chosen for i in b}
    kept = [b for b in mother if moved.isdisjoint(b)]
    inside = moved.union(*kept) if kept else moved
    displaced = [i for b in mother for i in b if i not in inside]
    return best_fit(lengths, displaced, [*chosen, *kept], capacity)


def mutate(lengths: np.ndarray, bins: Packing, capacity: int, rng: np.random.Generator) -> Packing:
    """Empties the worst bin and a few others; their pieces go back longest first, or at times in a random order."""
    out = {int(np.argmin(fills(lengths, bins, capacity)))} | set(np.flatnonzero(rng.random(len(bins)) < max(0.02, 0.5 / len(bins))).tolist())
    moved, kept = [i for k in out for i in bins[k]], [b for k, b in enumerate(bins) if k not in out]
    if rng.random() < 0.25:
        return placed(lengths, [moved[k] for k in rng.permutation(len(moved))], kept, capacity)
    return best_fit(lengths, moved, kept, capacity)


def evolve(lengths: np.ndarray, elites: list[Packing], capacity: int, seed: int, generations: int = GENERATIONS) -> Packing:
    """The best packing after some generations."""
    return evolution(lengths, elites, capacity, seed, generations)[0]


def evolution(lengths: np.ndarray, elites: list[Packing], capacity: int, seed: int, generations: int = GENERATIONS) -> tuple[Packing, int]:
    """The best packing after some generations, and the crossovers made.

    Without elites the population begins as random groupings, else as the elites and mutants of them; elites are crossed with each other first.
    """
    rng, bound = np.random.default_rng(seed), -(-int(lengths.sum()) // capacity)
    rated = lambda b: (fitness(lengths, b, capacity), b)
    population = [rated(b) for b in elites]
    while len(population) < POPULATION:
        population.append(rated(mutate(lengths, elites[len(population) % len(elites)], capacity, rng) if elites else random_grouping(lengths, capacity, rng)))
    made, generations = 0, max(generations, min(400, SMALL_WORK // max(1, len(lengths))))
    best = min(population, key=lambda x: x[0])
    while made < generations and (made < CROSSOVERS or best[0][0] > bound):
        a, b = (0, 1) if made == 0 else rng.choice(len(population), 2, replace=False)
        child = crossover(lengths, population[a][1], population[b][1], capacity, rng)
        population += [rated(child), rated(mutate(lengths, child, capacity, rng))]
        population = sorted(population, key=lambda x: x[0])[:POPULATION]
        best, made = population[0], made + 1
    return best[1], made


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids array<int> if keep_ids), and its copy's number.

    docs(doc_id long, text string, ...): a null text counts as empty and gives the end id alone; rows with one doc_id (or none)
    are packed one by one, told apart by `copy`, a number of the row within its task; other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, copy = WordTokenizer(tokenizer), 0
        for part, texts in text_chunks(batches, limit=SLICE):
            ids, counts = words.ids(texts)
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            pieces = -(-counts // capacity)
            doc = segment_ids(pieces)
            number = np.arange(len(doc)) - (np.cumsum(pieces) - pieces)[doc]
            start = number * capacity
            length = np.minimum(counts[doc] - start, capacity)
            raw, at = memoryview(ids.tobytes()), (np.cumsum(counts) - counts)[doc] + start
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            cols = [part.column("doc_id").take(pa.array(doc)), pa.array(doc + copy), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
            copy += len(texts)
            names = ["doc_id", "copy", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols.append(pa.ListArray.from_arrays(pa.array([*at, len(ids)], pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
        del words
        give_back()

    schema = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, capacity: int = 4096, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """pieces with sequence_id and offset. pieces has a long column `length` of 1 to capacity and any others; rows are kept as they are,
    but for columns named sequence_id or offset, which are replaced.

    An empty table gives an empty table. Equal rows are packed one by one. Which piece lands in which sequence depends on how
    Spark dealt the rows, the count of sequences hardly.
    """
    spark = pieces.sparkSession
    item = free_name(pieces, "_item")
    work = stored(pieces.drop("offset", "sequence_id").withColumn(item, F.monotonically_increasing_id()), "pieces")
    full = work.where(F.col("length") >= capacity).select(F.col(item).alias("_item"), F.col(item).alias("_bin"), F.lit(0).cast("long").alias("offset"))
    todo = work.where(F.col("length") < capacity).select(F.col(item).alias("_item"), "length")
    shards = max(1, -(-todo.count() // shard_pieces))
    done, turn = full, 1
    while True:
        packed = _pack_round(todo, shards, capacity, turn)
        final = ~F.col("_rest") if shards > 1 else F.lit(True)
        done = done.unionByName(packed.where(final).select("_item", "_bin", "offset"))
        if shards == 1:
            break
        todo = packed.where(~final).select("_item", "length")
        shards, turn = -(-shards // MERGE), turn + 1
    # a bin is known by its first piece, and a piece is placed once
    return work.join(done.select(F.col("_item").alias(item), F.col("_bin").alias("sequence_id"), "offset"), item).drop(item)


def _pack_round(todo: DataFrame, shards: int, capacity: int, turn: int) -> DataFrame:
    """_item, length, _bin (a piece of the bin), _rest (its bin moves on), offset: one evolution with migration on each shard."""
    spread = todo.withColumn("shard", F.pmod(F.xxhash64("_item", F.lit(turn)), F.lit(shards)))
    islands = spread.withColumn("island", F.explode(F.array(*(F.lit(k) for k in range(ISLANDS)))))

    def ordered(part: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        part = part.sort_values("_item").reset_index(drop=True)
        return part, part["length"].to_numpy(np.int64)

    def first(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part, lengths = ordered(part)
        best, made = evolution(lengths, [], capacity, seed=int(key[0]) * ISLANDS + int(key[1]))
        return pd.DataFrame({"shard": [key[0]] * 2, "island": [key[1], (key[1] + 1) % ISLANDS], "sizes": [[len(b) for b in best]] * 2, "members": [[i for b in best for i in b]] * 2, "made": [made] * 2})

    def again(key: tuple, part: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        part, lengths = ordered(part)
        guests = [[b.tolist() for b in np.split(np.asarray(m), np.cumsum(s)[:-1])] for s, m in zip(elites["sizes"], elites["members"])]
        best, made = evolution(lengths, guests, capacity, seed=(int(key[0]) * ISLANDS + int(key[1])) * 31 + 7)
        bins, fit = np.repeat(np.arange(len(best)), [len(b) for b in best]), fitness(lengths, best, capacity)
        at = np.concatenate([np.asarray(b, int) for b in best])
        offset = np.concatenate([np.cumsum(lengths[b]) - lengths[b] for b in best])
        names = part["_item"].to_numpy()[[b[0] for b in best]]
        worst = np.argsort([lengths[b].sum() for b in best], kind="stable")
        rest = np.zeros(len(best), bool)
        rest[worst] = np.cumsum([len(best[k]) for k in worst]) <= len(lengths) // MERGE
        rest[worst[:1]] = True
        return pd.DataFrame({"shard": key[0], "island": key[1], "_item": part["_item"].to_numpy()[at], "length": lengths[at], "_bin": names[bins], "_rest": rest[bins], "offset": offset, "n_bins": fit[0], "spread": fit[1], "crossovers": made + int(elites["made"].max())})

    elites = islands.groupBy("shard", "island").applyInPandas(first, "shard long, island int, sizes array<int>, members array<int>, made int")
    evolved = islands.groupBy("shard", "island").cogroup(elites.groupBy("shard", "island")).applyInPandas(again, "shard long, island int, _item long, length long, _bin long, _rest boolean, offset long, n_bins int, spread double, crossovers int")
    evolved = stored(evolved, "evolved")
    best = evolved.groupBy("shard").agg(F.min(F.struct("n_bins", "spread", "island")).alias("best")).select("shard", F.col("best.island").alias("island"))
    return evolved.join(best, ["shard", "island"]).select("_item", "length", "_bin", "_rest", "offset", "crossovers")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece of each document."""
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, capacity), capacity).drop("copy")
