"""Substring dedup: repeated passages found as paragraphs by MinHash banding, verified and clustered (operator 7).

Two kinds of units cover all texts; both are sets of 5-word shingles, both are banded, and both are verified by exact Jaccard:

- paragraphs of at least MIN_LINE words, in BANDS bands of BAND_ROWS rows (a pair of Jaccard 0.8 meets in some band with probability 0.992, one
  of 0.5 with 0.32): long lines, and runs of short lines up to an empty or a long one. What is wrapped over short lines may stand among others, so
  a run is also read in overlapping parts: each from a border to the first border MIN_LINE words on, in PART_BANDS bands. Borders are line starts; where
  lines are shorter than STEP words, those whose hash is the least nearby.
- blocks of PASSAGE words, whatever lines they lie in. A block opens at each winnowed anchor (a 5-gram whose hash is the least of some REACH
  in a row), so that two texts with PASSAGE + REACH - 1 = 50 words in common have a block in common. As blocks overlap, a band is the anchor
  and the least hash of the other shingles; BLOCK_BANDS of them find a pair of Jaccard 0.8 with one anchor with probability 0.96.

Equal sets are one node. Nodes of one band meet in signature trees (see jaccard_join), and links of Jaccard 0.8 or more make components.
Blocks at the ends of what repeats are then moved word by word: all windows less than REACH words before a run's first block, or behind its last, in
every document that has that block, are joined by content, so that spans reach the first and last word of what is shared. Linked paragraphs of short
lines, and parts, shrink to the words from their first to their last shared shingle.

Of each component the occurrences in the document with the smallest doc_id stay; those in other documents are removed. Spans of one keeper that lie
GAP words or less apart are one, if what they share is then still 0.8 of what they hold. What adds up to less than SPAN words is left alone. Repeats
inside one document are left to the quality rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hintforge.llm.common import SLICE, discard, free_name, maybe_broadcast, mix64, passing, ragged_take, segment_ids, sorted_within, stored, stored_apart, text_chunks
from hintforge.llm.jaccard_join import ODD, set_names, with_roots
from hintforge.llm.links import ARROW, PACKED, SHARD_TEXT, connected_components, key_groups, packed
from hintforge.llm.signature_trees import span_groups

MIN_LINE, BANDS, BAND_ROWS, PART_BANDS, STEP = 50, 12, 5, 8, 8
PASSAGE, REACH, ANCHOR, BLOCK_BANDS = 28, 23, 5, 2
#: Words of the least span that counts.
SPAN = 50
#: Words between two spans of one keeper that may be one edited passage.
GAP = 5
#: Bytes of lists by document that may be broadcast, and what a document takes besides its list.
LIST_BYTES, DOC_BYTES = 32 << 20, 64
INVERSE = np.uint64(pow(int(ODD), -1, 2**64))


def paragraph_places(sizes: np.ndarray, doc: np.ndarray, rolled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and whether it is a part, for each paragraph and part of a run of short lines.

    sizes, doc: words and text of each line, in order; rolled: hashes of the ANCHOR words from each word on. Successive parts differ in STEP words or
    more at both ends and share less than MIN_LINE, so their Jaccard is below 0.75 and no chain of overlapping parts becomes a component. Parts that
    make up 0.8 of their run are left to the run.
    """
    ends = np.cumsum(sizes)
    begin = ends - sizes
    long = np.flatnonzero(sizes >= MIN_LINE)
    short = np.flatnonzero((sizes > 0) & (sizes < MIN_LINE))
    new = np.append(True, (np.diff(short) > 1) | (doc[short[1:]] != doc[short[:-1]]))[: len(short)]
    start, total = begin[short[new]], np.zeros(0, np.int64)
    run = np.cumsum(new) - 1
    if len(short):
        total = ends[short[np.append(new[1:], True)]] - start
    inside = total[run] >= MIN_LINE if len(run) else np.zeros(0, bool)
    whole = np.flatnonzero(total >= MIN_LINE)
    # borders: line starts and each run's end; both ends of a run always stay
    at = np.concatenate([begin[short[inside]], start[whole] + total[whole]])
    of = np.concatenate([run[inside], whole])
    order = np.lexsort((at, of))
    at, of = at[order], of[order]
    edge = np.append(True, of[1:] != of[:-1])[: len(of)] | np.append(of[1:] != of[:-1], True)[: len(of)]
    rank = np.where(edge, np.uint64(0), rolled[np.minimum(at, max(0, len(rolled) - 1))] if len(rolled) else np.zeros(len(at), np.uint64))
    beaten = np.zeros(len(at), bool)
    for k in range(1, min(STEP, len(at))):
        near = (of[k:] == of[:-k]) & (at[k:] - at[:-k] < STEP)
        first = rank[:-k] <= rank[k:]
        beaten[k:] |= near & first
        beaten[:-k] |= near & ~first
    at, of = at[~beaten], of[~beaten]
    to = np.searchsorted(at, at + MIN_LINE)
    held = np.flatnonzero(to < len(at))
    held = held[of[to[held]] == of[held]]
    held = held[np.append(to[held[1:]] != to[held[:-1]], True)[: len(held)]]  # of parts with one end the shortest
    n = at[to[held]] - at[held]
    part = (n - ANCHOR + 1) * 5 < (total[of[held]] - ANCHOR + 1) * 4
    first = np.concatenate([begin[long], start[whole], at[held][part]])
    return first, np.concatenate([sizes[long], total[whole], n[part]]), np.arange(len(first)) >= len(long) + len(whole)


class Words:
    """The words of some texts: their hashes one text after the other, those of ANCHOR words in a row, and what lies where."""

    def __init__(self, texts: list[bytes]):
        words: list[bytes] = []
        self.counts = np.zeros(len(texts), np.int64)
        lines, line_doc = [], []
        for i, text in enumerate(texts):
            before = len(words)
            for line in text.lower().split(b"\n"):
                found = line.split()
                words += found
                lines.append(len(found)), line_doc.append(i)
            self.counts[i] = len(words) - before
        self.code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.lines, self.line_doc = np.array(lines, np.int64), np.array(line_doc, np.int64)
        self.rolled, n = self.code.copy(), len(self.code)
        for k in range(1, min(ANCHOR, n)):
            self.rolled[: n - k] = mix64(self.rolled[: n - k] * ODD + self.code[k:])
        self.doc, self.place, self.left = places_of(self.counts)

    def paragraphs(self) -> tuple[np.ndarray, ...]:
        """Text number, first word's place, words, whether it is of short lines, whether it is a part, number of shingles and, one after the other, the sorted shingles of each paragraph."""
        first, n, part = paragraph_places(self.lines, self.line_doc, self.rolled)
        flat, owner = ragged_take(self.rolled, first, n - ANCHOR + 1), segment_ids(n - ANCHOR + 1)
        flat = flat[sorted_within(owner, flat)]
        new = np.append(True, (owner[1:] != owner[:-1]) | (flat[1:] != flat[:-1]))[: len(flat)]
        soft = np.arange(len(first)) >= (self.lines >= MIN_LINE).sum()
        return self.doc[first], self.place[first], n, soft, part, np.bincount(owner[new], minlength=len(first)), flat[new]

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks at winnowed anchors: text number, first word's place, and a row of the hashes of their shingles in order, the anchor first."""
        anchor, n, width = self.rolled, len(self.code), PASSAGE - ANCHOR + 1
        if n < PASSAGE + REACH - 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.uint64)
        # least anchor of each REACH in a row whose last still opens a whole block
        runs = np.flatnonzero(self.left >= PASSAGE + REACH - 1)
        least = np.zeros(n, np.uint64)
        low = anchor[runs]
        for k in range(1, REACH):
            low = np.minimum(low, anchor[runs + k])
        least[runs] = low
        # the greatest of these minima that a place takes part in; a place is an anchor if it is one of the minima
        best = least.copy()
        for k in range(1, REACH):
            best[k:] = np.maximum(best[k:], least[: n - k])
        at = np.flatnonzero((self.left >= PASSAGE) & (best == anchor))
        return self.doc[at], self.place[at], anchor[at[:, None] + np.arange(width)]


def band_keys(hashes: np.ndarray, sizes: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A row of keys, one a band, for each set; sets are not empty."""
    starts = np.cumsum(sizes) - sizes
    keys = np.zeros((len(sizes), bands), np.uint64)
    if not len(sizes):
        return keys
    for band in range(bands):
        for row in range(BAND_ROWS):
            salt = np.uint64((band * BAND_ROWS + row + 1) * 0x2545F4914F6CDD1D % 2**64)
            least = np.minimum.reduceat((hashes ^ salt) * (ODD ^ (salt << np.uint64(1))), starts)
            keys[:, band] = mix64(keys[:, band] + least + np.uint64(band))
    return keys


def some_bands(flat: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, some: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and their nodes of some of the sets, each node once."""
    once = some[np.unique(nodes[some], return_index=True)[1]]
    starts = np.cumsum(sizes) - sizes
    return band_keys(ragged_take(flat, starts[once], sizes[once]), sizes[once], bands).ravel(), np.repeat(nodes[once], bands)


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, one text after the other, and the texts' numbers of words."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = text.lower().split()
        counts[i] = len(found)
        words += found
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), counts


def places_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word its text's number, its place there and the words from it to the text's end."""
    doc = segment_ids(counts)
    place = np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc]
    return doc, place, counts[doc] - place


def block_sets(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct hashes in order, one row after the other, and their numbers."""
    rows = np.sort(shingles, axis=1)
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    return rows[new], new.sum(1)


def block_keys(shingles: np.ndarray) -> np.ndarray:
    """A row of BLOCK_BANDS keys for each block."""
    keys = np.zeros((len(shingles), BLOCK_BANDS), np.uint64)
    for band in range(BLOCK_BANDS):
        salt = np.uint64((band + 77) * 0x2545F4914F6CDD1D % 2**64)
        least = ((shingles[:, 1:] ^ salt) * (ODD ^ (salt << np.uint64(1)))).min(1) if len(shingles) else keys[:, band]
        keys[:, band] = mix64(mix64(shingles[:, 0] + np.uint64(band)) + least)
    return keys


def windows(texts: list[bytes], near: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of PASSAGE words by the places of near, those to look before and those to look behind: text number, first word's place and key of the content."""
    code, counts = word_codes(texts)
    if len(code) < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, place, left = places_of(counts)
    at = np.flatnonzero((left >= PASSAGE) & beside(near, counts))
    return doc[at], place[at], window_keys(code, at)


def window_keys(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys of the contents of windows at places of code."""
    n = len(code)
    power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, ODD), dtype=np.uint64)])
    back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, INVERSE), dtype=np.uint64)])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(code * power[:n], dtype=np.uint64)])
    return mix64((sums[at + PASSAGE] - sums[at]) * back[at]).view(np.int64)


def beside(near: list[tuple[np.ndarray, np.ndarray]], counts: np.ndarray) -> np.ndarray:
    """For each word whether it is less than REACH words before one of the first places of its text, or behind one of the second (or few before)."""
    starts = np.cumsum(counts) - counts
    edge = np.zeros(int(counts.sum()) + 1, np.int64)
    for (before, behind), start, n in zip(near, starts, counts):
        for low, high in ((before - REACH + 1, before + 1), (behind - ANCHOR, behind + REACH)):
            np.add.at(edge, start + np.clip(low, 0, n), 1)
            np.add.at(edge, start + np.clip(high, 0, n), -1)
    return np.cumsum(edge[:-1]) > 0


def text_names(texts: list[bytes]) -> np.ndarray:
    """Tells rows apart that share a doc_id but not the text."""
    return np.array([xxhash.xxh32_intdigest(t) - 2**31 for t in texts], np.int32)


def with_keepers(found: DataFrame, group: str) -> DataFrame:
    """The rows of groups that lie in two documents or more, with keeper, the group's smallest doc_id.

    Keepers are written before the join: both its sides are then plain shuffles, of which AQE splits hot groups over several tasks.
    """
    repeated = found.groupBy(group).agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("other")).where("keeper < other").drop("other")
    # merged, not broadcast: groups grow with the corpus
    return found.join(stored(repeated, "keepers").hint("merge"), group)


#: What one pass over the texts finds: rows of paragraphs, and rows of packed band keys alone (pack).
FOUND = "doc_id long, copy int, first int, size int, node long, block boolean, soft boolean, " + PACKED + ", pack boolean"
FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("copy", pa.int32()), ("first", pa.int32()), ("size", pa.int32()), ("node", pa.int64()), ("block", pa.bool_()), ("soft", pa.bool_()), *ARROW, ("pack", pa.bool_())])


def paragraphs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, copy, first, size, node, block, soft of every paragraph, part of a run of short lines and block; the packed band keys of their nodes. Both written."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_TEXT))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_chunks(batches, limit=SLICE):
            names, words = text_names(some), Words(some)
            doc, first, n, soft, part_of_run, sizes, flat = words.paragraphs()
            nodes = set_names(flat, sizes)
            block_doc, block_first, shingles = words.blocks()
            block_nodes = set_names(*block_sets(shingles))
            of, count = np.concatenate([doc, block_doc]), len(doc) + len(block_doc)
            cols = [part.column("doc_id").take(pa.array(of)), pa.array(names[of]), pa.array(np.concatenate([first, block_first]), pa.int32()), pa.array(np.concatenate([n, np.full(len(block_doc), PASSAGE)]), pa.int32())]
            cols += [pa.array(np.concatenate([nodes, block_nodes])), pa.array(np.arange(count) >= len(doc)), pa.array(np.append(soft, np.zeros(len(block_doc), bool)))]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.nulls(count, f.type) for f in ARROW), pa.repeat(False, count)], schema=FOUND_ARROW)
            lines = some_bands(flat, sizes, nodes, np.flatnonzero(~part_of_run), BANDS)
            parts = some_bands(flat, sizes, nodes, np.flatnonzero(part_of_run), PART_BANDS)
            block_once = np.unique(block_nodes, return_index=True)[1]
            keys = np.concatenate([lines[0], parts[0], block_keys(shingles[block_once]).ravel()])
            of_keys = np.concatenate([lines[1], parts[1], np.repeat(block_nodes[block_once], BLOCK_BANDS)])
            packs = packed(keys, of_keys, np.zeros(len(keys), bool), shards)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(packs.num_rows, f.type) for f in list(FOUND_ARROW)[:7]), *packs.columns, pa.repeat(True, packs.num_rows)], schema=FOUND_ARROW)

    rows, packs = stored_apart(texts.mapInArrow(find, FOUND), "paragraphs", "pack")
    return rows.drop(*ARROW.names), packs


def with_lists(texts: DataFrame, by_doc: DataFrame, size: int) -> DataFrame:
    """The texts that by_doc(doc_id, ...), written, has rows for, and its columns; size: bytes of its lists together.

    Beyond LIST_BYTES the texts are shuffled, a copy of them that lasts until the step is written.
    """
    return texts.join(F.broadcast(by_doc) if size + DOC_BYTES * by_doc.count() <= LIST_BYTES else by_doc, "doc_id")


def paragraph_sets(texts: DataFrame, rows: DataFrame, near: DataFrame) -> DataFrame:
    """node, size, low, data of the nodes of near, from the texts of the documents that own them."""
    first = rows.join(maybe_broadcast(near), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    owned = stored(first.groupBy("doc_id").agg(F.collect_list("node").alias("nodes")), "owned")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_chunks(batches, limit=SLICE):
            lists = part.column("nodes")
            wanted = lists.flatten().to_numpy()
            words = Words(some)
            *_, sizes, flat = words.paragraphs()
            more, more_sizes = block_sets(words.blocks()[2])
            flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, more_sizes])
            nodes, once = np.unique(set_names(flat, sizes), return_index=True)
            keep = np.isin(nodes, wanted)
            nodes, once = nodes[keep], once[keep]
            ends = np.cumsum(sizes)
            held = [flat[ends[k] - sizes[k] : ends[k]] for k in once]
            low = np.array([h[0] for h in held], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sizes[once]), pa.array(low), pa.array([h.tobytes() for h in held], pa.binary())], ["node", "size", "low", "data"])

    return with_lists(texts, owned, 8 * near.count()).mapInArrow(sets, "node long, size long, low long, data binary").dropDuplicates(["node"])


def paragraph_repeats(docs: DataFrame, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """doc_id, copy, first, size, component, block, soft, keeper: paragraphs, parts and blocks of a component that lies in two documents or more; keeper is
    the smallest doc_id, soft tells what is made of short lines and linked to other texts than its own. Written."""
    with passing() as tables:
        rows, packs = paragraphs(docs)
        groups = key_groups(packs.select(*ARROW.names))
        discard(packs)  # most of what is written so far
        with passing() as inner:
            near = stored(groups.select("node").distinct(), "near")
            texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
            sets = paragraph_sets(texts, rows, near)  # meet their groups where they were shuffled to, unwritten
            links = inner.keep(stored(with_roots(connected_components(span_groups(groups.join(sets, "node"), True, *threshold))), "components"))
        # linked blocks have their anchor's words in common and may differ in as many last words as the threshold allows shingles
        num, den = threshold
        differ = (PASSAGE - ANCHOR + 1) * (den - num) // (den + num)
        size = F.when(F.col("block") & F.col("component").isNotNull(), F.col("size") - differ).otherwise(F.col("size"))
        named = rows.join(maybe_broadcast(links), "node", "left").withColumn("size", size).withColumn("soft", F.col("soft") & F.col("component").isNotNull()).withColumn("component", F.coalesce("component", "node")).drop("node")
        return tables.keep(stored(with_keepers(named, "component"), "hits"))


def line_repeats(docs: DataFrame, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """doc_id, copy, first, size, keeper of the paragraphs and parts among paragraph_repeats."""
    return paragraph_repeats(docs, threshold).where("NOT block").select("doc_id", "copy", "first", "size", "keeper")


def soft_repeats(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """doc_id, copy, first, size, keeper of the soft hits, from the first to the last shingle that another document of the component has.

    What is alike may stand among other lines, and parts needn't end where it does. As a link leaves less than a fifth of a set unshared, a shared
    shingle lies in the first fifth and in the last; only these are compared.
    """
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    keys = ["doc_id", "copy", "first", "component"]
    soft = hits.where("soft").select(*keys, "size", "keeper")
    lists = stored(soft.groupBy("doc_id").agg(F.collect_list(F.struct("copy", "first", "size", "component")).alias("units")), "soft")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_chunks(batches, limit=SLICE):
            names, words = text_names(some), Words(some)
            units = part.column("units")
            row = segment_ids(pc.list_value_length(units).to_numpy())
            copy, first, size, component = (units.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            mine = names[row] == copy
            row, copy, first, size, component = (x[mine] for x in (row, copy, first.astype(np.int64), size.astype(np.int64), component))
            n = size - ANCHOR + 1
            some_of = n // 5 + 1
            unit = segment_ids(some_of)
            step = np.arange(len(unit)) - (np.cumsum(some_of) - some_of)[unit]
            at = np.concatenate([first[unit] + step, (first + n - some_of)[unit] + step])
            tail, unit = np.arange(len(at)) >= len(unit), np.concatenate([unit, unit])
            key = words.rolled[(np.cumsum(words.counts) - words.counts)[row[unit]] + at].view(np.int64)
            cols = [part.column("doc_id").take(pa.array(row[unit])), *(pa.array(x[unit], t) for x, t in ((copy, pa.int32()), (first, pa.int32()), (component, pa.int64())))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(at, pa.int32()), pa.array(tail), pa.array(key)], [*keys, "at", "tail", "key"])

    held = lists.agg(F.sum(F.size("units"))).first()[0] or 0
    every = stored(with_lists(texts, lists, 48 * held).mapInArrow(ends, "doc_id long, copy int, first int, component long, at int, tail boolean, key long"), "ends")
    shared = every.groupBy("component", "key").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("other")).where("one < other")
    met = every.join(stored(shared.select("component", "key"), "shared").hint("merge"), ["component", "key"])
    reach = met.groupBy(*keys).agg(F.min(F.when(~F.col("tail"), F.col("at"))).alias("begin"), F.max(F.when(F.col("tail"), F.col("at") + ANCHOR)).alias("end"))
    begin, end = F.coalesce("begin", "first"), F.coalesce("end", F.col("first") + F.col("size"))
    return soft.join(reach, keys, "left").select("doc_id", "copy", begin.alias("first"), (end - begin).cast("int").alias("size"), "keeper")


def edge_repeats(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """doc_id, copy, first, size, keeper: windows, around blocks where some document's run of repeated blocks ends, whose content lies in two
    documents or more; keeper is the smallest doc_id."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    parts = hits.where("block")
    along = Window.partitionBy("doc_id", "copy").orderBy("first")
    far = lambda x: F.coalesce(x > PASSAGE, F.lit(True))
    opens, closes = far(F.col("first") - F.lag("first").over(along)), far(F.lead("first").over(along) - F.col("first"))
    found = parts.select("component", opens.alias("opens"), closes.alias("closes"))
    sides = F.explode(F.array(F.when(F.col("opens"), True), F.when(F.col("closes"), False))).alias("before")
    ends = stored(found.select("component", sides).where("before IS NOT NULL").distinct(), "ends")
    held = stored(parts.join(maybe_broadcast(ends), "component").select("doc_id", "copy", "first", "before").distinct(), "edges")
    places = [F.collect_list(F.when(side, F.col("first"))).alias(name) for side, name in ((F.col("before"), "before"), (~F.col("before"), "behind"))]
    by_doc = stored(held.groupBy("doc_id", "copy").agg(*places).groupBy("doc_id").agg(F.collect_list(F.struct("copy", "before", "behind")).alias("copies")), "lists")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_chunks(batches, limit=SLICE):
            names, near = text_names(some), []
            for name, copies in zip(names.tolist(), part.column("copies").to_pylist()):
                mine = next((c for c in copies if c["copy"] == name), {"before": [], "behind": []})
                near.append(tuple(np.array(mine[side], np.int64) for side in ("before", "behind")))
            doc, place, keys = windows(some, near)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), pa.array(names[doc]), pa.array(place, pa.int32()), pa.array(keys)], ["doc_id", "copy", "first", "key"])

    every = stored(with_lists(texts, by_doc, 4 * held.count()).mapInArrow(around, "doc_id long, copy int, first int, key long"), "places")
    return with_keepers(every, "key").select("doc_id", "copy", "first", F.lit(PASSAGE).alias("size"), "keeper")


def repeated_spans(docs: DataFrame, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """doc_id, copy, spans array<struct<first, size, removed, keeper>>: maximal runs of repeated words of documents that have any.

    Places and sizes count words `[^\\x20\\x09-\\x0D]+`, A-Z compared without case. A removed span repeats what a document with a smaller
    doc_id has (keeper: the smallest such doc_id in the run); a span that isn't removed is what stays. Words covered by both a kept and a
    removed occurrence are removed; runs of less than SPAN words don't count. docs(doc_id long, text string, ...): rows without doc_id or text have no span and are no keeper;
    rows that share a doc_id are one document, told apart by `copy`, a hash of the text; other columns are not read.
    """
    found = paragraph_repeats(docs, threshold)
    hits = found.where("NOT soft").select("doc_id", "copy", "first", "size", "keeper").unionByName(edge_repeats(docs, found)).unionByName(soft_repeats(docs, found))
    by_doc = hits.groupBy("doc_id", "copy").agg(F.array_sort(F.collect_set(F.struct("first", "size", "keeper"))).alias("hits"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hits")
            flat = lists.flatten()
            first, size, keeper = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            counts = np.diff(lists.offsets.to_numpy())
            row = segment_ids(counts)
            gone = keeper < batch.column("doc_id").to_numpy()[row]
            spans = []
            starts = np.cumsum(counts) - counts
            for i, (a, n) in enumerate(zip(starts, counts)):
                part = slice(a, a + n)
                removed, kept = ([x for x in bridged(merged(first[part][side], size[part][side], keeper[part][side])) if x[1] >= SPAN] for side in (gone[part], ~gone[part]))
                kept = uncovered(kept, removed)
                spans.append(sorted([{"first": f, "size": s, "removed": True, "keeper": k} for f, s, k in removed] + [{"first": f, "size": s, "removed": False, "keeper": k} for f, s, k in kept], key=lambda s: s["first"]))
            kind = pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32()), ("removed", pa.bool_()), ("keeper", pa.int64())]))
            made = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), pa.array(spans, kind)], ["doc_id", "copy", "spans"])
            yield made.filter(pa.array([len(x) > 0 for x in spans], pa.bool_()))

    return by_doc.mapInArrow(merge, "doc_id long, copy int, spans array<struct<first:int,size:int,removed:boolean,keeper:long>>")


def merged(first: np.ndarray, size: np.ndarray, keeper: np.ndarray) -> list[tuple[int, int, int]]:
    """Overlapping or touching spans as one; first is in order."""
    if not len(first):
        return []
    end = np.maximum.accumulate(first + size)
    cut = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    stop = end[np.append(cut[1:], len(end)) - 1]
    return list(zip(first[cut].tolist(), (stop - first[cut]).tolist(), np.minimum.reduceat(keeper, cut).tolist()))


def bridged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in order, those of one keeper joined over gaps of GAP words or less.

    A gap is taken to be edited words, as many on either side: what is joined has Jaccard 0.8 or more of shingles if all else is alike.
    """
    out: list[tuple[int, int, int]] = []
    alike = apart = 0
    for first, size, keeper in spans:
        gap = first - sum(out[-1][:2]) if out else GAP + 1
        more, between = size - ANCHOR + 1, 2 * (gap + ANCHOR - 1)
        if gap <= GAP and keeper == out[-1][2] and 5 * (alike + more) >= 4 * (alike + more + apart + between):
            out[-1] = (out[-1][0], first + size - out[-1][0], keeper)
            alike, apart = alike + more, apart + between
        else:
            out.append((first, size, keeper))
            alike, apart = more, 0
    return out


def uncovered(spans: list[tuple[int, int, int]], over: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What of spans lies outside of over; both in order."""
    out, k = [], 0
    for f, n, keeper in spans:
        at, end = f, f + n
        while k < len(over) and over[k][0] + over[k][1] <= at:
            k += 1
        j = k
        while j < len(over) and over[j][0] < end:
            if over[j][0] > at:
                out.append((at, over[j][0] - at, keeper))
            at = max(at, over[j][0] + over[j][1])
            j += 1
        if at < end:
            out.append((at, end - at, keeper))
    return out


def drop_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of spans (first, size) in order; white space around them shrinks to the last before what follows."""
    places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    out, at = [], 0
    for first, size in spans:
        out.append(text[at : places[first][0]])
        at = places[first + size][0] if first + size < len(places) else len(text)
    return b"".join(out) + text[at:]


def remove_repeats(docs: DataFrame, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """docs with removed spans cut out of the texts and n_chars, if there, counted anew; documents left without a word go.

    Rows without doc_id or text stay as they are.
    """
    lists = free_name(docs, "_copies")
    spans = repeated_spans(docs, threshold).select("doc_id", F.col("copy").alias("_copy"), F.filter("spans", lambda s: s["removed"]).alias("_spans")).where(F.size("_spans") > 0)
    spans = stored(spans.groupBy("doc_id").agg(F.collect_list(F.struct("_copy", "_spans")).alias(lists)), "spans")
    spans = maybe_broadcast(spans, spans.agg(F.sum(F.aggregate(lists, F.lit(0), lambda n, c: n + F.size(c["_spans"])))).first()[0] or 0)
    names, columns, schema = docs.columns, docs.columns.index("text"), docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in text_chunks(batches, limit=SLICE):
            copies = batch.column(batch.num_columns - 1)
            new, keep = [], []
            for text, found in zip(batch.column(columns).cast(pa.binary()), copies):
                text, found = text.as_py(), found.as_py()
                mine = [c["_spans"] for c in found or [] if text is not None and c["_copy"] == xxhash.xxh32_intdigest(text) - 2**31]
                if mine:
                    text = drop_spans(text, [(s["first"], s["size"]) for s in mine[0]]).rstrip()
                new.append(text)
                keep.append(not mine or bool(text.split()))
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            kind = cols["text"].type
            # texts keep bytes that aren't UTF-8 as they are
            cols["text"] = pc.cast(pa.array(new, pa.binary()), options=pc.CastOptions.unsafe(kind))
            if "n_chars" in cols:
                cut_away = [t is not None and len(c) > 0 if (c := f.as_py()) else False for t, f in zip(new, copies)]
                counted = [len(t.decode("utf-8", "replace")) if a else o for t, a, o in zip(new, cut_away, cols["n_chars"].to_pylist())]
                cols["n_chars"] = pa.array(counted, cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols)).filter(pa.array(keep, pa.bool_()))

    joined = docs.join(spans, "doc_id", "left").select(*names, lists)
    return joined.mapInArrow(cut, schema)
