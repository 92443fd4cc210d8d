"""The pipeline's stages on odd tables: nulls, repeated ids and rows, columns with names of the operators' own, no rows at all."""

import os
import random

import pytest

import corpus_pipeline
from hintforge.llm.common import stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
rng = random.Random(31)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, copy string, component string, shingle string, _item string, _copies string, item_id string, size string"


def say(n):
    return " ".join(f"q{rng.randint(0, 10**7)}" for _ in range(n))


def rows():
    passage, other, own = say(70), say(90), say(80)
    found = [
        (1, passage + "\n" + say(100)), (2, say(30) + "\n" + passage + "\n" + say(60)), (None, other), (None, other), (None, say(75)), (3, own), (3, own), (3, say(120)),
        (4, None), (5, ""), (6, "few words"), (7, "again " * 200), (8, other), (None, None),
    ]
    return [(d, t, None, "s", None if t is None else len(t), "n", "c", "k", "h", "i", "x", "y", "z") for d, t in found]


def run(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_nulls_repeated_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    quality, near, cut, clean, packed = run(spark, docs)
    for stage in (quality, near, cut, clean):
        assert stage.columns == docs.columns and {r.node for r in stage.select("node").collect()} == {"n"}
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    # rows without 50 words and repetitive ones go; of equal texts one row stays, that with an id
    assert ids(quality) == [(False, 1), (False, 2), (False, 3), (False, 3), (False, 3), (False, 8), (True, 0), (True, 0), (True, 0)]
    assert ids(near) == [(False, 1), (False, 2), (False, 3), (False, 3), (False, 8), (True, 0)]
    texts = {r.doc_id: r.text for r in cut.where("doc_id IN (1, 2)").collect()}
    assert len(texts[1].split()) == 170 and len(texts[2].split()) == 90  # the passage stays in document 1
    assert {r.doc_id: r.n_chars for r in cut.collect()}[2] == len(texts[2])
    assert ids(clean) == ids(near)
    assert {r.doc_id for r in packed.collect()} == {1, 2, 3, 8, None} and packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for stage in run(spark, docs):
        assert stage.count() == 0
