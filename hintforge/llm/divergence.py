"""How far the sources of a language diverge in their terms (operator 11).

Of two sources' smoothed term shares p and q, a term's divergence is f = floor((p - q)^2 / (p + q)). Most terms are in neither source. So each
pair starts at V times the f of two zero counts, V being the number of kept terms, and an inverted index corrects it: a term's postings, the
sources that use it, emit the difference to that baseline for the pairs that have at least one of them, and nothing else. Sources are dealt
into blocks and terms into shards, so that a task holds postings of two blocks in one shard, however many sources or terms there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hintforge.llm.common import maybe_broadcast, stored, text_chunks

#: Term bytes as they count: A-Z in lower case, a-z and all of a code point beyond ASCII; any other byte separates.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counters that a task holds before they leave.
HELD = 200_000
SCALE = 1_000_000_000
#: Sources of a block; postings of a block that a shard should have.
BLOCK, SHARD_POSTINGS = 64, 100_000
#: Terms looked at together inside of a task.
TERM_ROWS = 4096

COUNTED = "lang string, source string, term string, n long, docs long"


def utf8(text: bytes) -> bytes:
    """text, with U+FFFD for what isn't UTF-8."""
    try:
        text.decode()
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()
    return text


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs) of a task, and one with a null term for each group, which may have no terms."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def leave() -> pa.RecordBatch:
        out = [(lang, source, term, n, docs[term]) for (lang, source), (counts, docs) in held.items() for term, n in [(None, 0), *counts.items()]]
        held.clear()
        terms = pa.array([r[2] for r in out], pa.binary()).cast(pa.string())
        cols = zip(*((a, b, n, d) for a, b, _, n, d in out)) if out else ((), (), (), ())
        lang, source, n, docs = cols
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip((lang, source, n, docs), kinds)]
        return pa.RecordBatch.from_arrays([*arrays[:2], terms, *arrays[2:]], ["lang", "source", "term", "n", "docs"])

    entries = 0
    for part, texts in text_chunks(batches):
        for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            entries -= len(counts)
            words = utf8(text).translate(TERM_BYTES).split()
            counts.update(words)
            docs.update(set(words))
            entries += len(counts)
            if entries > HELD:
                yield leave()
                entries = 0
    yield leave()


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)), exact: counts of a corpus times 10^9 can leave 64 bits."""
    return 1 + F.call_function("div", F.lit(SCALE).cast("decimal(38,0)") * (n + 2), (total + 2 * v).cast("decimal(20,0)"))


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def corrections(rows: pd.DataFrame, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source, source, correction) of the pairs across two blocks, or inside of one, from the postings of one shard.

    rows has block (0 or 1), idx, term and p; a row without term holds its source's p of a zero count.
    """
    none = rows["term"].isna().to_numpy()
    head, rows = rows[none], rows[~none]
    side = [np.unique(head["idx"][head["block"] == b].to_numpy()) for b in ((0, 0) if same else (0, 1))]
    zero = [head.drop_duplicates("idx").set_index("idx")["p"].loc[s].to_numpy(np.int64) for s in side]
    total = np.zeros((len(side[0]), len(side[1])), np.int64)
    base = gap(zero[0][:, None], zero[1][None, :])
    term, _ = pd.factorize(rows["term"])
    block, idx, p = (rows[c].to_numpy(np.int64) for c in ("block", "idx", "p"))
    for low in range(0, int(term.max(initial=-1)) + 1, TERM_ROWS):
        here = (term >= low) & (term < low + TERM_ROWS)
        size = min(TERM_ROWS, int(term.max()) + 1 - low)
        shares, used = [], []
        for b, (names, z) in enumerate(zip(side, zero)):
            mine = here if same else here & (block == b)
            shares.append(np.tile(z, (size, 1))), used.append(np.zeros((size, len(z)), bool))
            at = term[mine] - low, np.searchsorted(names, idx[mine])
            shares[b][at], used[b][at] = p[mine], True
        for a in range(len(side[0])):  # the postings of a, against all of the other block
            t = np.flatnonzero(used[0][:, a])
            total[a] += (gap(shares[0][t, a][:, None], shares[1][t]) - base[a]).sum(axis=0)
        for b in range(len(side[1])):  # and those of b that a hasn't
            t = np.flatnonzero(used[1][:, b])
            total[:, b] += np.where(used[0][t], 0, gap(shares[0][t], shares[1][t, b][:, None]) - base[:, b]).sum(axis=0)
    a, b = np.nonzero(side[0][:, None] < side[1][None, :]) if same else map(np.ravel, np.indices(total.shape))
    return side[0][a], side[1][b], total[a, b]


def term_counts(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Written: (lang, source, term, n, lang_n, one) of kept terms, `one` being 1 in a single row of each term; and the groups (lang, source, total, v)."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    parts = docs.select(clean("lang"), clean("source"), "text").mapInArrow(count_terms, COUNTED)
    # one shuffle by (lang, term) serves the sums of a source's counts and the look at all sources of a term
    of_term = Window.partitionBy("lang", "term")
    summed = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    seen = summed.withColumns({"all_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "one": (F.row_number().over(of_term.orderBy("source")) == 1).cast("int")})
    kept = stored(seen.where((F.col("all_docs") >= min_docs) | F.col("term").isNull()).select("lang", "source", "term", "n", "lang_n", "one"), "terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("term").isNotNull(), F.col("one")).otherwise(0)).alias("firsts"), F.count("term").alias("postings"))
    lang = Window.partitionBy("lang")
    whole = {"v": F.sum("firsts").over(lang), "lang_total": F.sum("total").over(lang), "lang_postings": F.sum("postings").over(lang), "idx": F.row_number().over(lang.orderBy("source")) - 1, "blocks": F.ceil(F.count("*").over(lang) / BLOCK)}
    groups = stored(totals.withColumns(whole).drop("firsts", "postings"), "groups")
    return kept.where("term IS NOT NULL"), groups


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value: the sum of f over all kept terms, for both directions."""
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("lang_postings") / F.greatest(F.lit(1), F.col("blocks")) / SHARD_POSTINGS))
    placed = groups.select("lang", "source", "total", "v", "idx", "blocks", n_shards.alias("shards"), F.floor(F.col("idx") / BLOCK).alias("block"))
    use = kept.join(maybe_broadcast(placed, rows=groups.count()), ["lang", "source"])
    postings = use.select("lang", "block", "blocks", "idx", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"))
    heads = placed.where("v > 0").select("lang", "block", "blocks", "idx", F.lit(None).cast("string").alias("term"), share(F.lit(0), F.col("total"), F.col("v")).alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = postings.unionByName(heads).select("*", other).select("lang", "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "idx", "term", "p")

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, low, high = key
        a, b, value = corrections(rows.assign(block=(rows["block"] != low).astype(np.int64)), low == high)
        return pd.DataFrame({"lang": lang, "a": a, "b": b, "value": value})

    fixed = dealt.groupBy("lang", "shard", "low", "high").applyInPandas(meet, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("fix"))
    one = placed.select("lang", "v", F.col("idx").cast("long").alias("a"), F.col("source").alias("a_source"), F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).alias("a_zero"))
    two = one.select("lang", *(F.col(c).alias(c.replace("a", "b", 1)) for c in ("a", "a_source", "a_zero")))
    pairs = one.join(two, "lang").where("a < b").join(fixed, ["lang", "a", "b"], "left")  # every pair is a row of the result
    base = F.col("v") * F.call_function("div", (F.col("a_zero") - F.col("b_zero")) * (F.col("a_zero") - F.col("b_zero")), F.col("a_zero") + F.col("b_zero"))
    value = F.coalesce(base + F.coalesce("fix", F.lit(0)), F.lit(0)).cast("long")
    both = F.inline(F.array(*(F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("a_source", "b_source"), ("b_source", "a_source")))))
    return pairs.select("lang", both, value.alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term that the source uses more than its language does), value."""
    known = kept.join(maybe_broadcast(groups.select("lang", "source", "total", "v", "lang_total"), rows=groups.count()), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    both = known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    return both.select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank of docs(text, lang, source): how far each source is from each other one of its language (`pair`),
    and the terms that it uses more than its language does (`term`, top_terms at most).

    Terms are `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z in lower case; those in at least min_docs documents of the language are kept. Null
    text, lang and source are ''. A group without kept terms takes part with zero counts; a language without kept terms has values of 0. A
    source alone in its language has no pair. Rows count as documents, repeated or not; other columns are not read; an empty table gives an
    empty one. Bytes that aren't UTF-8 are U+FFFD, which is a term letter.
    """
    kept, groups = term_counts(docs, min_docs)
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(w).alias("rank"))
    return ranked(pair_divergence(kept, groups), "pair").unionByName(ranked(term_divergence(kept, groups), "term").where(F.col("rank") <= top_terms))
