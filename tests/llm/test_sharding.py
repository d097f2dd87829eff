import random
import re
import zlib

import pytest

from postloom.llm import ranking, sharding
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, shard string, size int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("shards", [40, 7])
def test_shards(spark, shards):
    rng = random.Random(shards)
    rows = [(d, "é" * rng.randrange(50), rng.choice(["hot"] * 5 + ["a", "b", None])) for d in range(1003)]
    rows += [(None, None, "a"), (None, "", None), rows[5], rows[5]]
    got = sharding.shard(frame(spark, rows), shards).collect()
    want = sorted((str(d), 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    source = {d: s for d, _, s in rows}
    for name in ("hot", "a", "b"):
        share = sum(s == name for _, _, s in rows) / shards
        for shard in range(shards):
            assert abs(sum(source[r.doc_id] == name for r in got if r.shard == shard and r.doc_id is not None) - share) <= 3
    again = sharding.shard(frame(spark, rows[::-1]).repartition(5), shards).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_few_rows_and_none(spark):
    got = sharding.shard(frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, None, None)])).collect()
    assert len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}
    assert sharding.shard(frame(spark, [(1, "a", "x")]).limit(0)).count() == 0


def test_native_plan(spark, plan, tmp_path):
    spark.range(50).selectExpr("id AS doc_id", "'a' AS text", "'s' AS source").write.parquet(str(tmp_path / "d"))
    text = plan(sharding.shard(spark.read.parquet(str(tmp_path / "d"))))
    assert not re.search("Python|Arrow|Pandas|ExistingRDD|MapPartitions", text)


def test_positions_and_running_totals(spark):
    rng = random.Random(1)
    values = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randrange(9)) for i in range(200)]
    df = spark.createDataFrame(values, "k int, i int, v int").repartition(6)
    got = {r.i: (r.position, r.before) for r in ranking.positions(df, [F.col("k"), F.col("i")], "v").collect()}
    total = 0
    for n, (_, i, v) in enumerate(sorted(values)):
        assert got[i] == (n, total)
        total += v
