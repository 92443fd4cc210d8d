"""Exact n-gram Jaccard join with signature trees (operator 6).

1. Documents with one set of shingles are one class; a class's name is a 64-bit hash of its set.
2. Classes that may link meet in groups without loss. Shingles are put in one order for all sets, rare ones first; two sets of Jaccard >= t
   share one of their first n - ceil(t n) + 1 shingles. Each of these is a key with the set's range of sizes, and a set near the top of its
   range also sends the keys of the next. The sets of one key are a group. The order only has to be the same everywhere: it comes from a
   table of fixed size that holds levels of how often shingles were seen.
3. A group's sets meet in signature trees: a node holds its sets' token bitmaps, combined by OR (and by AND), and their range of sizes. Two
   trees are walked together; a pair of nodes is dropped if the greatest overlap that its bitmaps and sizes allow is too small. Only sizes
   and bitmaps are moved here. Sets that a surviving pair of leaves joins, over all groups, are a cluster.
4. A cluster's whole sets are brought together once, walked in the same way, and surviving pairs not yet joined are verified on the sets.
5. Links make components; each document gets its component's smallest doc_id.

Groups and clusters beyond a block are dealt into chunks that also hold a few pivots. What isn't joined to the largest component
then meets all chunks of sizes that can link (see span_groups), so nothing is lost and near copies of one text cost one move each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import SLICE, maybe_broadcast, mix64, ragged_take, segment_ids, sorted_within, stored, text_chunks
from hintforge.llm.links import PACKED, SHARD_TEXT, connected_components, key_groups, packed
from hintforge.llm.signature_trees import BLOCK, own_bitmaps, span_groups

#: Cells of the table of levels, shingles that a task holds while it looks for repeated ones, level (log2) from which a key is frequent.
CELLS, CELL_CHUNK, HELD_SHINGLES, FREQUENT = 1 << 24, 1 << 14, 2 << 20, 10
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Stands for a null doc_id where a class's owner is named.
NOBODY = 2**63 - 1


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct n-word shingles as sorted 64-bit hashes, one text after the other, and their numbers.

    A text of 1 to n - 1 words has its whole sequence as one shingle.
    """
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.lower().split()
        counts[i] = len(found)
        words += found
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    doc = segment_ids(counts)
    starts = np.cumsum(counts) - counts
    rolling = code
    for k in range(1, n):
        follow = np.zeros(len(code), np.uint64)
        follow[: max(0, len(code) - k)] = code[k:]
        rolling = mix64(rolling * ODD + follow)
    whole = np.arange(len(code)) + n <= (starts + counts)[doc]
    short = np.flatnonzero((counts > 0) & (counts < n))
    few = np.array([xxhash.xxh3_64_intdigest(b" ".join(words[starts[i] : starts[i] + counts[i]]), seed=1 + int(counts[i])) for i in short], np.uint64)
    owner, hashes = np.concatenate([doc[whole], short]), np.concatenate([rolling[whole], few])
    order = sorted_within(owner, hashes)
    owner, hashes = owner[order], hashes[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])) if len(owner) else np.zeros(0, bool)
    return hashes[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def set_names(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (as signed), 0 for empty ones."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes + np.uint64(17)), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return np.where(sizes > 0, mix64(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)) | np.uint64(1), np.uint64(0)).view(np.int64)


def size_ranges(num: int, den: int, limit: int = 1 << 40) -> np.ndarray:
    """The least size of each range; a range ends a quarter, or den / num, above its least size: sets that link lie in one range or two neighbours."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4, -(-out[-1] * den // num)))
    return np.array(out, np.int64)


def prefix_keys(hashes: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, num: int, den: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) pairs of sets for the threshold num / den: those that share no key don't link."""
    keys, owner, _ = leveled_keys(hashes, sizes, num, den, levels)
    return keys, nodes[owner]


def leveled_keys(hashes: np.ndarray, sizes: np.ndarray, num: int, den: int, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, numbers of their sets, and levels of their shingles, ordered by set.

    levels are looked up by hash; any table gives a right order, a good one puts frequent shingles last.
    """
    doc = segment_ids(sizes)
    level = levels[(hashes % np.uint64(len(levels))).astype(np.int64)]
    place = (mix64(hashes ^ ODD) >> np.uint64(6)) | (level.astype(np.uint64) << np.uint64(58))
    order = sorted_within(doc, place)
    starts = np.cumsum(sizes) - sizes
    prefix = sizes - -(-num * sizes // den) + 1
    first = order[np.arange(len(order)) - starts[doc] < prefix[doc]]
    owner, of, ranges = doc[first], level[first], size_ranges(num, den)
    own = np.searchsorted(ranges, sizes, side="right") - 1
    mine = mix64(hashes[first] * ODD + own[owner].astype(np.uint64))
    guest = (den * sizes >= num * ranges[own + 1])[owner]
    above = mix64(hashes[first][guest] * ODD + (own[owner][guest] + 1).astype(np.uint64))
    keys, sets, of = np.concatenate([mine, above]), np.concatenate([owner, owner[guest]]), np.concatenate([of, of[guest]])
    by_set = np.argsort(sets, kind="stable")
    return keys[by_set], sets[by_set], of[by_set]


def distinct_sets(nodes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first place of each node whose set isn't empty, in order."""
    first = np.sort(np.unique(nodes, return_index=True)[1])
    return first[sizes[first] > 0]


def taken(flat: np.ndarray, sizes: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets numbered `some`."""
    return ragged_take(flat, (np.cumsum(sizes) - sizes)[some], sizes[some]), sizes[some]


#: What one pass over the texts finds: rows of documents, and shingles that several different sets of a task's buffer hold.
SETS = "doc_id long, copy long, size long, node long, low long, bits binary, shingle long, times long"
SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("size", pa.int64()), ("node", pa.int64()), ("low", pa.int64()), ("bits", pa.binary()), ("shingle", pa.int64()), ("times", pa.int64())])


def named_sets(docs: DataFrame, n: int) -> DataFrame:
    """A row for each row of docs (copy: a hash of the text, node: its set's name, low: its least hash), whose bits are null but for the first of a
    node in a task's buffer; and rows of repeated shingles alone. Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def repeated() -> pa.RecordBatch:
            flat = np.concatenate(held)
            held.clear(), seen.clear()
            flat.sort()
            again = flat[1:][flat[1:] == flat[:-1]]  # a shingle once less than it is there
            found, times = np.unique(again, return_counts=True)
            none = pa.nulls(len(found))
            cols = [none.cast(f.type) for f in list(SETS_ARROW)[:6]]
            return pa.RecordBatch.from_arrays([*cols, pa.array(found.view(np.int64)), pa.array(times + 1)], schema=SETS_ARROW)

        for part, texts in text_chunks(batches, limit=SLICE):
            flat, sizes = shingle_sets(texts, n)
            names = set_names(flat, sizes)
            once = distinct_sets(names, sizes)
            once = once[np.array([k not in seen for k in names[once].tolist()], bool)]
            seen.update(names[once].tolist())
            some, some_sizes = taken(flat, sizes, once)
            bits: list = [None] * len(texts)
            for k, row in zip(once.tolist(), own_bitmaps(some, some_sizes)):
                bits[k] = row
            low = np.zeros(len(texts), np.int64)
            full = sizes > 0
            low[full] = flat[(np.cumsum(sizes) - sizes)[full]].view(np.int64)
            none = pa.nulls(len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("copy"), pa.array(sizes), pa.array(names), pa.array(low), pa.array(bits, pa.binary()), none, none], schema=SETS_ARROW)
            held.append(some)
            if sum(map(len, held)) > HELD_SHINGLES:
                yield repeated()
        if held:
            yield repeated()

    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("copy"))
    return stored(texts.mapInArrow(run, SETS), "sets")


def shingle_levels(sets: DataFrame) -> Broadcast:
    """A broadcast table of CELLS levels, by hash: floor(log2) of how often the most frequent shingle of the cell was seen in buffers that
    had it twice, and one more; 0 for none. The driver gets CELLS bytes, whatever the corpus."""
    counts = sets.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("n"))
    # as the unsigned hash's remainder; CELLS is a power of two
    cell = F.col("shingle").bitwiseAND(F.lit(CELLS - 1)).cast("int")
    level = F.least(F.floor(F.log2("n")) + 1, F.lit(63)).cast("byte")
    cells = counts.select(cell.alias("cell"), level.alias("level")).groupBy("cell").agg(F.max("level").alias("level"))
    chunk = F.floor(F.col("cell") / CELL_CHUNK).cast("int").alias("chunk")
    listed = cells.groupBy(chunk).agg(F.collect_list("cell").alias("cells"), F.collect_list("level").alias("levels"))  # CELL_CHUNK at most
    table = np.zeros(CELLS, np.uint8)
    for r in listed.toLocalIterator():
        table[np.array(r["cells"], np.int64)] = np.array(r["levels"], np.uint8)
    return sets.sparkSession.sparkContext.broadcast(table)


def whole_sets(docs: DataFrame, owners: DataFrame, n: int) -> DataFrame:
    """group, node, size, low, data: the sets of owners(node, owner, copy, group), taken from the texts of the rows that own them."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("owner"), "text", F.xxhash64("text").alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_chunks(batches, limit=SLICE):
            flat, sizes = shingle_sets(some, n)
            once = distinct_sets(part.column("node").to_numpy(), sizes)
            ends = np.cumsum(sizes)
            sets = [flat[ends[k] - sizes[k] : ends[k]] for k in once]
            at = pa.array(once)
            low = np.array([s[0] for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("group").take(at), part.column("node").take(at), pa.array(sizes[once]), pa.array(low), pa.array([s.tobytes() for s in sets], pa.binary())], ["group", "node", "size", "low", "data"])

    return texts.join(maybe_broadcast(owners), ["owner", "copy"]).mapInArrow(run, "group long, node long, size long, low long, data binary").dropDuplicates(["node"])


def jaccard_components(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (8, 10), block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of docs(doc_id long, text string, ...).

    threshold is a fraction (numerator, denominator), compared in whole numbers. A null, empty or white text has no shingle and is
    linked with nothing; its component is its own doc_id. Rows with equal sets are linked; repeated rows each give a row; null doc_ids
    stay null and don't count for the smallest. An empty table gives an empty one; other columns are not read.
    """
    named = row_components(docs, n, threshold, block)
    full, empty = named.where("size > 0"), named.where("size = 0")
    # written before the join: both its sides are then plain shuffles, of which AQE splits a hot component over several tasks
    least = stored(full.groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    out = full.join(maybe_broadcast(least), "component").select("doc_id", F.col("size").alias("n_shingles"), F.col("least").alias("component_id"))
    return out.unionByName(empty.select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def row_components(docs: DataFrame, n: int, threshold: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """doc_id, copy, size, node, component for each row of docs; component is the name of a class of the component."""
    num, den = threshold
    sets = named_sets(docs, n)
    rows = sets.where("shingle IS NULL")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_TEXT))
    levels = shingle_levels(sets)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, limit=SLICE):
            flat, sizes = shingle_sets(texts, n)
            names = set_names(flat, sizes)
            once = distinct_sets(names, sizes)
            key, owner, level = leveled_keys(*taken(flat, sizes, once), num, den, levels.value)
            yield packed(key, names[once][owner], level >= FREQUENT, shards)

    groups = key_groups(docs.select("text").mapInArrow(keys, PACKED))
    near = stored(groups.select("node").distinct(), "near")
    owner = F.struct(F.coalesce("doc_id", F.lit(NOBODY)).alias("owner"), "copy")
    known = rows.where("size > 0").join(maybe_broadcast(near), "node").groupBy("node").agg(F.max("size").alias("size"), F.max("low").alias("low"), F.max("bits").alias("data"), F.min(owner).alias("first"))
    known = stored(known.select("node", "size", "low", "data", "first.owner", "first.copy"), "known")
    candidates = span_groups(groups.join(known.drop("owner", "copy"), "node"), False, num, den, block)
    clusters = stored(with_roots(connected_components(candidates)).withColumnRenamed("component", "group"), "clusters")
    owners = stored(known.select("node", "owner", "copy").join(clusters, "node"), "owners")
    links = connected_components(span_groups(whole_sets(docs, owners, n), True, num, den, block))
    plain = rows.select("doc_id", "copy", "size", "node")
    named = plain.where("size > 0").join(maybe_broadcast(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return named.unionByName(plain.where("size = 0").withColumn("component", F.col("node")))


def with_roots(components: DataFrame) -> DataFrame:
    """(node, component) with a row for each component's own node too."""
    return components.unionByName(components.select(F.col("component").alias("node"), "component").distinct())


def keep_one(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """One row of each component: that with the smallest doc_id (null last), then the smallest hash of the text.

    Each row is judged by its own text, whatever other rows share its doc_id. Rows without a shingle stay.
    """
    named = stored(row_components(docs, n, threshold).where("size > 0").select("doc_id", "copy", "component"), "components")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("first"))
    first = stored(first.select("component", F.col("first.doc_id").alias("first_id"), F.col("first.copy").alias("first_copy")), "firsts")
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("copy") == F.col("first_copy"))
    counted = named.join(maybe_broadcast(first), "component").groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), stays.alias("_stays")).agg(F.count("*").alias("_n"))
    # rows that go, and those that stay but once of several
    marks = stored(counted.where("NOT _stays OR _n > 1").select("_id", "_copy", "_stays"), "marks")
    here = lambda some: docs["doc_id"].eqNullSafe(some["_id"]) & (F.xxhash64(docs["text"]) == some["_copy"])
    marks = maybe_broadcast(marks)
    out = docs.join(marks, here(marks), "left_anti")
    several = marks.where("_stays")
    if several.isEmpty():
        return out
    once = docs.join(several, here(several), "left_semi").withColumn("_copy", F.xxhash64("text")).dropDuplicates(["doc_id", "_copy"]).drop("_copy")
    return out.unionByName(once)
