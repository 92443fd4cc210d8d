"""Repetition coverage of whole texts (operator 1).

Words are `[^\\x20\\x09-\\x0D]+`. Over a slice of documents the words become 64-bit codes, and rolling hashes of every n-gram
length come from one another (H[n + 1] = H[n] * BASE + next code). A window is duplicated if its hash occurs again in the same
document; the characters of words under such windows, and of lines seen before, are measured against the document's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import SLICE, mix64, segment_ids, text_chunks

BASE = np.uint64(0x9E3779B97F4A7C15)
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


@dataclass(frozen=True)
class RepetitionRules:
    """A document fails if a share is over its limit. Limits are the widely used published ones for 5- to 10-grams and lines."""

    min_words: int = 50
    max_repeat_words_percent: int = 50
    ngram_chars: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    line_count: float = 0.30
    line_chars: float = 0.20


def covered(hashes: np.ndarray, valid: np.ndarray, n: int) -> np.ndarray:
    """For each word whether it lies under a window of n words whose hash occurs twice or more among the valid ones."""
    at = np.flatnonzero(valid)
    if not len(at):
        return np.zeros(len(hashes), bool)
    order = np.argsort(hashes[at], kind="stable")
    ranked = hashes[at][order]
    same = ranked[1:] == ranked[:-1]
    twice = at[order[np.append(same, False) | np.append(False, same)]]
    edge = np.zeros(len(hashes) + n, np.int64)
    edge[twice] += 1
    edge[twice + n] -= 1
    return np.cumsum(edge)[: len(hashes)] > 0


def measure(texts: list[bytes], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """All measures of the texts, in arrays by text."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    symbols, lines, line_dups, line_dup_chars = (np.zeros(len(texts), np.int64) for _ in range(4))
    for i, text in enumerate(texts):
        found = text.split()
        counts[i] = len(found)
        words += found
        symbols[i] = IS_SYMBOL[np.frombuffer(text, np.uint8)].sum()
        full = [x for x in text.split(b"\n") if x and not x.isspace()]
        distinct = set(full)
        lines[i], line_dups[i] = len(full), len(full) - len(distinct)
        if line_dups[i]:
            size = lambda some: sum(len(w.decode("utf-8", "replace")) for x in some for w in x.split())
            line_dup_chars[i] = size(full) - size(distinct)
    distinct_words = dict.fromkeys(words)
    chars = np.fromiter((len(w.decode("utf-8", "replace")) for w in distinct_words), np.int64, len(distinct_words))
    number = dict(zip(distinct_words, range(len(distinct_words))))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    doc, ends = segment_ids(counts), np.cumsum(counts)
    size = chars[ids]

    def per_text(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[ends] - sums[ends - counts]

    out = {"n_words": counts, "word_chars": per_text(size), "n_symbols": symbols, "n_lines": lines, "n_dup_lines": line_dups, "line_dup_chars": line_dup_chars}
    code, salt = mix64(ids.astype(np.uint64) + np.uint64(1)), mix64(doc.astype(np.uint64) + np.uint64(1 << 40))
    left = ends[doc] - np.arange(len(ids))
    rolling = np.zeros(len(ids), np.uint64)
    for n in range(1, max(3, *lengths) + 1):
        follow = np.zeros(len(ids), np.uint64)
        follow[: max(0, len(ids) - n + 1)] = code[n - 1 :]
        rolling = rolling * BASE + follow
        if n == 3 or n in lengths:
            under = covered(rolling ^ salt, left >= n, n)
            if n == 3:
                out["n_repeat_words"] = per_text(under)
            if n in lengths:
                out[f"dup_{n}gram_chars"] = per_text(np.where(under, size, 0))
    return out


def repetition_measures(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """doc_id with all counts, base_failed and kept, one row for each row of docs(doc_id long, text string, ...).

    A null or white text has no words: all counts are 0 and it fails the base rule. Repeated rows each give a row, null doc_ids
    stay null, other columns are not read, and an empty table gives an empty one. Bytes that aren't UTF-8 count as U+FFFD.
    """
    lengths = tuple(sorted(rules.ngram_chars))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "line_dup_chars", *(f"dup_{n}gram_chars" for n in lengths)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, limit=SLICE):
            found = measure(texts, lengths)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(found[n], pa.int64()) for n in names)], ["doc_id", *names])

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_words_percent * F.col("n_words"))
    bad = (F.col("n_dup_lines") > rules.line_count * F.col("n_lines")) | (F.col("line_dup_chars") > rules.line_chars * F.col("word_chars"))
    for n in lengths:
        bad = bad | (F.col(f"dup_{n}gram_chars") > rules.ngram_chars[n] * F.col("word_chars"))
    return counted.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~bad)


def keep_good(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of docs that pass, with their columns as they were; whole rows travel once through the Python workers.

    docs needs a column text; a null text goes.
    """
    lengths = tuple(sorted(rules.ngram_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, limit=SLICE):
            m = measure(texts, lengths)
            bad = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_words_percent * m["n_words"])
            bad |= (m["n_dup_lines"] > rules.line_count * m["n_lines"]) | (m["line_dup_chars"] > rules.line_chars * m["word_chars"])
            for n in lengths:
                bad |= m[f"dup_{n}gram_chars"] > rules.ngram_chars[n] * m["word_chars"]
            yield part.filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)
