"""Links between things that share a key, and their connected components, without emitting a group's pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import give_back, mix64, ragged_take, stored

#: Columns of packed (key, node) arrays: 32-bit keys of a shard, or whole keys that are frequent.
PACKED = "shard int, frequent boolean, keys binary, nodes binary"
ARROW = pa.schema([("shard", pa.int32()), ("frequent", pa.bool_()), ("keys", pa.binary()), ("nodes", pa.binary())])
#: Text of one shard of keys.
SHARD_TEXT = 16 << 20


def packed(keys: np.ndarray, nodes: np.ndarray, frequent: np.ndarray, shards: int) -> pa.RecordBatch:
    """A task's distinct (key, node) pairs for the shuffle. A shard holds all pairs of its keys; frequent keys are kept out of the shards."""
    out: dict[str, list] = {n: [] for n in ARROW.names}
    often = np.flatnonzero(frequent)
    if len(often):
        out["shard"].append(int(keys[often[0]] % np.uint64(shards))), out["frequent"].append(True)
        out["keys"].append(keys[often].tobytes()), out["nodes"].append(nodes[often].tobytes())
    keys, nodes = keys[~frequent], nodes[~frequent]
    shard = ((keys >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")  # equal nodes stay side by side: the shuffle's compression takes them
    some, first = np.unique(shard[order], return_index=True)  # only shards that occur: their number follows the slice, not the corpus
    small = keys.astype(np.uint32)
    for s, at in zip(some.tolist(), np.split(order, first[1:])):
        out["shard"].append(s), out["frequent"].append(False), out["keys"].append(small[at].tobytes()), out["nodes"].append(nodes[at].tobytes())
    return pa.RecordBatch.from_pydict(out, schema=ARROW)


def shared_keys(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, node) of keys with two nodes or more; a group's name is a hash of its nodes, so keys of equal nodes are one group."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    same_key = keys[1:] == keys[:-1]
    once = np.append(True, ~(same_key & (nodes[1:] == nodes[:-1])))[: len(keys)]
    keys, nodes = keys[once], nodes[once]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(first, append=len(keys))
    if not len(first):
        return nodes, nodes
    names = np.add.reduceat(mix64(nodes.view(np.uint64) + np.uint64(3)), first)
    _, kept = np.unique(names, return_index=True)
    kept = kept[n[kept] > 1]
    return np.repeat(names[kept], n[kept]).view(np.int64), ragged_take(nodes, first[kept], n[kept])


def key_groups(packs: DataFrame) -> DataFrame:
    """(group, node), distinct and written: the nodes of each key that has two or more.

    A frequent key's pairs stay rows, so that no task holds all of them; any other key is met in its shard.
    """

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        often = part["frequent"].to_numpy(bool)
        read = lambda rows, kind: np.frombuffer(b"".join(rows), kind)
        group, node = shared_keys(read(part["keys"][~often], np.uint32), read(part["nodes"][~often], np.int64))
        key, member = read(part["keys"][often], np.int64), read(part["nodes"][often], np.int64)
        give_back()
        return pd.DataFrame({"frequent": np.repeat([False, True], [len(group), len(key)]), "group": np.concatenate([group, key]), "node": np.concatenate([node, member])})

    # frequent pairs are spread by the row they came in, not by their keys
    spread = packs.withColumn("shard", F.when(F.col("frequent"), F.pmod(F.xxhash64("nodes"), F.lit(1 << 20)).cast("int")).otherwise(F.col("shard")))
    made = stored(spread.groupBy("frequent", "shard").applyInPandas(meet, "frequent boolean, group long, node long").distinct(), "keys")
    often = made.where("frequent").select("group", "node")
    several = often.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    return made.where("NOT frequent").select("group", "node").unionByName(often.join(stored(several, "frequent"), "group"))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch that a spanning forest needs."""
    for batch in batches:
        a, b = (batch.column(n).to_numpy() for n in ("a", "b"))
        names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(names))
        keep = [forest.join(x, y) for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


#: Links up to which one task joins them: a bounded number, so it isn't a task that grows with the corpus.
TASK_LINKS = 250_000


def connected_components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component), written, for the nodes of links(a long, b long): component is the least node reachable.

    Beyond task_links links, large-star and small-star steps alternate until the links don't change; each round's links are written to the shared
    folder. Nodes without links, a component's own node and a link from a node to itself give no row. No Python runs over the links before they are
    written: a task with two Python steps keeps two workers, and executors keep them all.
    """
    start = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = stored(start.distinct(), "links"), None
    if now.count() <= task_links:
        return stored(now.coalesce(1).mapInArrow(joined, "node long, component long"), "components")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = stored(small.distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all links of a task."""
    held = [np.stack([b.column(n).to_numpy() for n in ("a", "b")]) for b in batches]
    a, b = np.concatenate([np.zeros((2, 0), np.int64), *held], axis=1)
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    forest = Forest(len(names))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
        forest.join(x, y)
    roots = np.array([forest.root(k) for k in range(len(names))], np.int64)
    rest = roots != np.arange(len(names))
    yield pa.RecordBatch.from_arrays([pa.array(names[rest]), pa.array(names[roots[rest]])], ["node", "component"])
