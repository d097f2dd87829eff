"""Callers' columns stay as they are, whatever their names."""

from postloom.llm import mixing, packing, simhash, substring
from pyspark.sql import functions as F

NAMES = ["_id", "_mark", "_nth", "_key", "_text", "_uid", "_group", "_taken", "_size", "_body", "row", "f0", "part", "rest", "spans"]


def docs(spark):
    rows = [(i, text, "s", *[f"{n}-{i}" for n in NAMES]) for i, text in enumerate(["a b c d e", "a b c d e", "p q r s t u", "v w"])]
    return spark.createDataFrame(rows, ["doc_id", "text", "source", *NAMES])


def kept(df):
    rows = df.collect()
    assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in NAMES)
    return sorted(r.doc_id for r in rows)


def test_near_duplicates(spark):
    assert kept(simhash.keep_one(docs(spark))) == [0, 2, 3]


def test_mixture(spark):
    assert set(kept(mixing.apply_mix(docs(spark)))) <= {0, 1, 2, 3}


def test_copied_passages(spark):
    assert kept(substring.remove_copied(docs(spark))) == [0, 1, 2, 3]


def test_packing(spark):
    pieces = docs(spark).withColumn("length", F.lit(3)).withColumn("offset", F.lit("gone"))
    out = packing.pack(pieces, capacity=8, group=2)
    assert kept(out) == [0, 1, 2, 3] and set(out.columns) == {*pieces.columns, "sequence_id"}
