"""Links inside groups of sets, found by walking signature trees together.

A tree's node holds its sets' token bitmaps, combined by OR and by AND, and their least and greatest sizes. Two nodes are walked
further only if the greatest overlap that bitmaps and sizes allow reaches the threshold. Many groups are walked at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import give_back, maybe_broadcast, ragged_take, segment_ids, stored
from hintforge.llm.links import connected_components, thinned

#: Words of a bitmap at least, children of a tree's node, pairs of leaves that one step of a walk may open.
BITMAP_WORDS, FANOUT, STEP_PAIRS = 32, 8, 4 << 20
#: Sets of a chunk, bytes of a chunk, pivots that all chunks of a group share.
BLOCK, BLOCK_BYTES, PIVOTS = 800, 8 << 20, 4
#: Rows, bytes and pairs of one task of a walk.
TASK_ROWS, TASK_BYTES, TASK_PAIRS = 20_000, 24 << 20, 4 << 20
#: Columns of a walk's input: sides only of chunks that meet; comp: sets of one comp are joined already; low: the least hash.
COLUMNS = ("at", "side", "node", "comp", "size", "low", "data")


def width_of(sizes: np.ndarray) -> np.ndarray:
    """Words of a set's bitmap: a power of two with a bit for each shingle or more, so that unrelated sets stay apart."""
    return np.maximum(BITMAP_WORDS, 1 << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64))


def bitmaps(hashes: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """A row of `width` words for each set of hashes."""
    out = np.zeros((len(sizes), width), np.uint64)
    ends, many = np.cumsum(sizes), max(1, (1 << 23) // (64 * width))
    for a in range(0, len(sizes), many):
        part = sizes[a : a + many]
        flags = np.zeros((len(part), width * 64), bool)
        start = int(ends[a] - sizes[a])
        flags[segment_ids(part), (hashes[start : start + int(part.sum())] % np.uint64(width * 64)).astype(np.int64)] = True
        out[a : a + many] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
    return out


def own_bitmaps(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Each set's bitmap, of its own width."""
    out: list[bytes] = [b""] * len(sizes)
    widths, starts = width_of(sizes), np.cumsum(sizes) - sizes
    for width in np.unique(widths).tolist():
        some = np.flatnonzero(widths == width)
        for k, row in zip(some.tolist(), bitmaps(ragged_take(hashes, starts[some], sizes[some]), sizes[some], width)):
            out[k] = row.tobytes()
    return out


def folded(data: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of this width or more as rows of this width."""
    out = np.zeros((len(data), width), np.uint64)
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    for n in np.unique(lengths).tolist():
        some = np.flatnonzero(lengths == n)
        out[some] = np.bitwise_or.reduce(np.frombuffer(b"".join(data[some]), np.uint64).reshape(len(some), -1, width), axis=1)
    return out


class SignatureTrees:
    """One tree for each run of equal numbers in `tree`, built level by level from the leaves; all have the same depth."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, tree: np.ndarray):
        self.levels, self.children = [(bits, bits, sizes, sizes)], []
        while len(tree) and (tree[1:] == tree[:-1]).any():
            new = np.append(True, tree[1:] != tree[:-1])
            first = np.flatnonzero(new)
            place = np.arange(len(tree)) - first[np.cumsum(new) - 1]
            cut = np.flatnonzero(place % FANOUT == 0)
            has, all_, low, high = self.levels[-1]
            self.children.append((cut, np.diff(cut, append=len(tree))))
            self.levels.append((np.bitwise_or.reduceat(has, cut), np.bitwise_and.reduceat(all_, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))
            tree = tree[cut]

    def walk(self, i: np.ndarray, j: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of different leaves below the roots i and j (i = j: within a tree) that may link."""
        for level in range(len(self.levels) - 1, -1, -1):
            keep = may_link(self.levels[level], i, j, num, den)
            i, j = i[keep], j[keep]
            if level:
                start, n = self.children[level - 1]
                times = n[i] * n[j]
                pair = segment_ids(times)
                at = np.arange(len(pair)) - (np.cumsum(times) - times)[pair]
                wide = n[j][pair]
                left, right = start[i][pair] + at // wide, start[j][pair] + at % wide
                once = (i != j)[pair] | (left <= right)
                i, j = left[once], right[once]
        return i[i != j], j[i != j]


def may_link(level: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the greatest possible overlap of the nodes i and j reaches num / den of the least possible union."""
    has, every, least, most = level
    keep = np.zeros(len(i), bool)
    many = max(1, (1 << 20) // has.shape[1])
    for at in range(0, len(i), many):
        p, q = i[at : at + many], j[at : at + many]
        left = most[p] - np.bitwise_count(every[p] & ~has[q]).sum(1, dtype=np.int64)
        right = most[q] - np.bitwise_count(every[q] & ~has[p]).sum(1, dtype=np.int64)
        keep[at : at + many] = (den + num) * np.minimum(left, right) >= num * (least[p] + least[q])
    return keep


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least number reachable from each of 0..n-1 by links (i, j)."""
    label, before = np.arange(n), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
    return label


def verified(sets: list[np.ndarray], label: np.ndarray, i: np.ndarray, j: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links among the pairs (i, j), enough to span what is linked; sets of one label are joined already. label is changed."""
    order = np.argsort(np.abs(j - i), kind="stable")  # neighbours first: they are the likeliest partners
    i, j = i[order], j[order]
    for at in range(0, len(i), 4096):
        for p, q in zip(i[at : at + 4096].tolist(), j[at : at + 4096].tolist()):
            if label[p] == label[q]:
                continue
            s, t = sets[p], sets[q]
            both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            if den * both >= num * (len(s) + len(t) - both):
                label[label == label[q]] = label[p]
                yield p, q


def walk_groups(part: pd.DataFrame, exact: bool, num: int, den: int) -> pd.DataFrame:
    """(a, b) links inside the groups `at` of a task's rows; exact: verified on the sets in `data`, else what the bitmaps in `data` allow."""
    part = part.drop_duplicates(["at", "side", "node"])
    own = width_of(part["size"].to_numpy(np.int64))
    part = part.assign(width=pd.Series(own, part.index).groupby(part["at"]).transform("min")).sort_values(["width", "at", "side", "low", "size"], kind="stable")
    at, side, node, comp, width = (part[c].to_numpy() for c in ("at", "side", "node", "comp", "width"))
    sizes, data = part["size"].to_numpy(np.int64), part["data"].to_numpy()
    new_group = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    group_n = np.diff(new_group, append=len(at)).astype(np.int64)
    step = np.cumsum(group_n**2) // STEP_PAIRS + (width[new_group] << 32)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    cuts = [*new_group[np.flatnonzero(np.diff(step, prepend=-1))].tolist(), len(at)]
    for a, b in zip(cuts, cuts[1:]):
        n, words = b - a, int(width[a])
        tree_new = np.append(True, (at[a + 1 : b] != at[a : b - 1]) | (side[a + 1 : b] != side[a : b - 1]))
        tree = np.cumsum(tree_new) - 1
        first = np.flatnonzero(tree_new)
        flat = np.frombuffer(b"".join(data[a:b]), np.uint64) if exact else None
        bits = bitmaps(flat, sizes[a:b], words) if exact else folded(data[a:b], words)
        # sets of sides 0 and 1 meet; a group that has one side is walked within
        owner, here = at[a:b][first], side[a:b][first]
        paired = np.flatnonzero((owner[1:] == owner[:-1]) & (here[:-1] != here[1:]))
        alone = np.flatnonzero(here < 0)
        i, j = SignatureTrees(bits, sizes[a:b], tree).walk(np.concatenate([alone, paired]), np.concatenate([alone, paired + 1]), num, den)
        # a set may stand on both sides, and comps hold over all groups
        label = pd.factorize(comp[a:b])[0]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        names = node[a:b]
        if exact:
            ends = np.cumsum(sizes[a:b])
            sets = [flat[e - s : e] for e, s in zip(ends, sizes[a:b])]
            pairs = np.array(list(verified(sets, label, i, j, num, den)), np.int64).reshape(-1, 2)
            found.append((names[pairs[:, 0]], names[pairs[:, 1]]))
        else:
            least = components(n, *_both(label, i, j))
            moved = np.flatnonzero(least != np.arange(n))
            touched = np.isin(least, least[np.unique(np.concatenate([i, j]))]) if len(i) else np.zeros(n, bool)
            moved = moved[touched[moved]]
            found.append((names[least[moved]], names[moved]))
    if not found:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    out = pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})
    return out[out["a"] != out["b"]].drop_duplicates()


def _both(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) and those that join equal labels."""
    order = np.argsort(label, kind="stable")
    same = label[order][1:] == label[order][:-1]
    return np.concatenate([i, order[:-1][same]]), np.concatenate([j, order[1:][same]])


def span_groups(rows: DataFrame, exact: bool, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links that span what is linked inside each group of rows(group, node, size, low, data), node being distinct in a group.

    exact: data holds the sorted hashes and links have Jaccard num / den or more; else data holds bitmaps and links are the pairs that may have it.
    Groups beyond a block are dealt into chunks by hash, each with the group's pivots, so that a group of copies becomes one component with a
    single move of each set. What lies outside the group's largest component then meets every chunk, and is itself dealt into blocks.
    """
    rows = stored(rows.select("group", "node", "size", "low", "data"), "groups")
    weight = lambda: F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum(F.octet_length("data")) / BLOCK_BYTES)).cast("int")
    totals = rows.groupBy("group").agg(F.count("*").alias("n"), weight().alias("chunks"))
    big = stored(totals.where("chunks > 1 AND n > 2").select("group", "chunks"), "big")
    plain = rows.withColumn("at", F.col("group")).withColumn("side", F.lit(-1)).withColumn("comp", F.col("node"))
    if not big.count():
        return _walk(plain, exact, num, den)
    big = maybe_broadcast(big)
    small = _walk(plain.join(big, "group", "left_anti"), exact, num, den)
    many = stored(rows.join(big, "group"), "large")
    # chunks with pivots
    salted = [F.xxhash64("node", F.lit(k)) for k in range(PIVOTS)]
    least = maybe_broadcast(stored(many.groupBy("group").agg(F.array(*(F.min(s) for s in salted)).alias("least")), "pivots"))
    chunk = F.pmod(F.xxhash64("node", F.lit(-1)), F.col("chunks")).cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    pivots = many.join(least, "group").where(F.arrays_overlap(F.array(*salted), "least")).drop("least").withColumn("chunk", F.explode(every))
    dealt = many.withColumn("chunk", chunk).unionByName(pivots)
    dealt = dealt.withColumn("at", F.xxhash64("group", "chunk")).withColumn("side", F.lit(-1)).withColumn("comp", F.col("node"))
    first = stored(_walk(dealt, exact, num, den), "first-links")
    joined = connected_components(first)
    named = stored(many.select("group", "node", F.octet_length("data").alias("bytes")).join(maybe_broadcast(joined), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component"), "joined")
    sums = named.groupBy("group", "comp").agg(F.count("*").alias("n"))
    largest = sums.groupBy("group").agg(F.max(F.struct("n", "comp")).alias("top")).select("group", F.col("top.comp").alias("largest"))
    rest = stored(named.join(largest, "group").where("comp <> largest").select("group", "node", "comp", "bytes"), "rest")
    blocks = rest.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    blocks = stored(blocks, "blocks")
    if not blocks.count():
        return small.unionByName(first)
    blocks = maybe_broadcast(blocks)
    wall = many.join(blocks, "group").join(named.select("group", "node", "comp"), ["group", "node"]).withColumn("chunk", chunk)
    wall = wall.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    guests = many.join(rest.select("group", "node", "comp"), ["group", "node"]).join(blocks, "group").withColumn("other", F.pmod(F.xxhash64("node", F.lit(-2)), F.col("blocks")).cast("int"))
    guests = guests.withColumn("chunk", F.explode(every)).withColumn("side", F.lit(0))
    meet = wall.unionByName(guests.select(wall.columns)).withColumn("at", F.xxhash64("group", "chunk", "other"))
    return small.unionByName(first).unionByName(_walk(meet, exact, num, den))


def _walk(rows: DataFrame, exact: bool, num: int, den: int) -> DataFrame:
    """walk_groups, thinned, on tasks that hold whole groups `at`, as many tasks as the rows' number, bytes and pairs ask for."""
    rows = rows.select(*COLUMNS)
    each = rows.groupBy("at").agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("bytes"))
    sums = each.agg(F.sum("n"), F.sum("bytes"), F.sum(F.col("n") * F.col("n"))).first()
    tasks = max(1, *(-(-(x or 0) // bound) for x, bound in zip(sums, (TASK_ROWS, TASK_BYTES, TASK_PAIRS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            found = walk_groups(pa.Table.from_batches(held).to_pandas(), exact, num, den)
            yield from thinned(iter([pa.RecordBatch.from_pandas(found, preserve_index=False)]))
            del held, found
            give_back()

    return rows.repartition(tasks, "at").mapInArrow(run, "a long, b long")
