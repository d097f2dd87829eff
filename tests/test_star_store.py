import os
import pytest
from pyspark.sql import functions as F

from postloom.operators import star
from postloom.plans.export_job import export_star, load_exports
from postloom.schemas import ASPECTS, BARRIERS, BRANDS, CAUSES, STAR
from postloom.sources.star_store import StarStore

SCHEMA = (
    "tweet_id string, screen_name string, followers_count bigint, full_text string, created_at string, lang string, "
    "source string, intent string, sentiment string, embedding array<float>, retweet_count bigint, like_count bigint, "
    "reply_count bigint, view_count bigint, user_location string, coded_by string, is_spam boolean, "
    f"causes {CAUSES}, products array<string>, barriers {BARRIERS}, aspects {ASPECTS}, brands_raw {BRANDS}, "
    "brands_canonical map<string,string>"
)


def post(i, text="t", causes=(), products=(), barriers=(), aspects=(), brands=(), canonical=None, vector=(0.5, 0.5)):
    return (
        i, "s", 1, text, "", "", "", "other", "neutral", list(vector) if vector is not None else None, 0, 0, 0, 0, "", "m", False,
        list(causes), list(products), [(b,) for b in barriers], list(aspects), [(b, None) for b in brands], canonical or {},
    )


def tables(spark, *posts):
    return star.star_tables(spark.createDataFrame(list(posts), SCHEMA))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_child_rules(spark):
    t = tables(
        spark,
        post("1", causes=[("stress", "a"), ("age", "b"), ("stress", "c")], products=["x", "y", "x"], barriers=["p", "p"],
             aspects=[("s", "positive", "z")] * 2, brands=["Dove", "dove", "Dove"], canonical={"Dove": "DOVE"}, vector=()),
        post("2"),
    )
    assert rows(t["tweet_causes"]) == [("1", "age", "b"), ("1", "stress", "c")]
    assert rows(t["tweet_products"]) == [("1", "x"), ("1", "y")]
    assert rows(t["tweet_brands"]) == [("1", "Dove", "DOVE"), ("1", "dove", "dove")]
    assert rows(t["tweet_barriers"]) == [("1", "p", "m")]
    assert rows(t["tweet_aspects"]) == [("1", "s", "positive", "z")] * 2
    assert [r.embedding for r in t["tweets"].orderBy("tweet_id").collect()] == [None, [0.5, 0.5]]
    for name in STAR:
        assert t[name].columns == star.star_columns(name)


def test_children_need_no_shuffle(spark, plan):
    for name, df in tables(spark, post("1")).items():
        assert "Exchange" not in plan(df), name


def test_upsert(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    assert all(store.read(t).count() == 0 for t in STAR)
    first = tables(spark, post("1", products=["a", "b"]), post("2", products=["a"]), post("3"))
    second = tables(spark, post("2", "new", causes=[("age", "")]), post("4", products=["z"]))
    assert store.load(first) == 1
    assert store.load(second) == 2
    want = {"tweets": [("1", "t"), ("2", "new"), ("3", "t"), ("4", "t")], "products": [("1", "a"), ("1", "b"), ("4", "z")]}

    def state():
        return {"tweets": rows(store.read("tweets").select("tweet_id", "full_text")), "products": rows(store.read("tweet_products"))}

    assert state() == want and rows(store.read("tweet_causes")) == [("2", "age", "")]
    store.load(second)
    assert state() == want
    # a reader opened before a load keeps its version
    before = store.read("tweets")
    store.load(tables(spark, post("9")))
    assert before.count() == 4 and store.read("tweets").count() == 5


def test_batches_commute_when_ids_are_disjoint(spark, tmp_path):
    a, b = (post("1", products=["x"]),), (post("2", products=["y"]), post("3"))
    one, two = StarStore(spark, str(tmp_path / "one")), StarStore(spark, str(tmp_path / "two"))
    one.load(tables(spark, *a))
    one.load(tables(spark, *b))
    two.load(tables(spark, *a, *b))
    for t in STAR:
        assert rows(one.read(t)) == rows(two.read(t))


def test_a_load_writes_its_own_rows_only(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, *[post(str(i)) for i in range(60)]))
    store.load(tables(spark, post("7", "again")))
    _, loads = store.current()
    written = spark.read.parquet(str(tmp_path / "s" / loads[-1]["folder"] / "tweets"))
    assert [r.tweet_id for r in written.collect()] == ["7"]
    assert rows(store.read("tweets").filter("tweet_id = '7'").select("full_text")) == [("again",)]
    assert store.read("tweets").count() == 60


def test_loads_are_merged_by_tiers(spark, tmp_path, monkeypatch):
    from postloom.sources import star_store

    monkeypatch.setattr(star_store, "FAN", 2)
    store, want = StarStore(spark, str(tmp_path / "s")), {}
    for n in range(5):
        ids = [str(n), str(n + 1), "hot"]
        store.load(tables(spark, *[post(i, f"t{n}", products=["x"] * (n % 2)) for i in ids]))
        want |= {i: (f"t{n}", n % 2) for i in ids}
        assert rows(store.read("tweets").select("tweet_id", "full_text")) == sorted((i, t) for i, (t, _) in want.items())
        assert rows(store.read("tweet_products")) == sorted((i, "x") for i, (_, k) in want.items() if k)
    assert [load["tier"] for load in store.current()[1]] == [2, 0]


def test_two_writers_do_not_destroy_each_other(spark, tmp_path):
    from postloom.sources.star_store import Conflict

    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, post("1")))
    seen = store.current()
    other = StarStore(spark, str(tmp_path / "s"))
    other.load(tables(spark, post("2")))
    store.current = lambda: seen
    with pytest.raises(Conflict):
        store.load(tables(spark, post("3")))
    del store.current
    assert rows(store.read("tweets").select("tweet_id")) == [("1",), ("2",)]
    store.load(tables(spark, post("3")))
    assert store.read("tweets").count() == 3


def test_a_failed_load_shows_nothing(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, post("1", products=["a"])))
    bad = tables(spark, post("1", "new", products=["b"]))
    bad["tweet_aspects"] = bad["tweet_aspects"].withColumn("aspect", F.raise_error(F.lit("boom"))).union(
        spark.createDataFrame([("1", "a", "b", "c")], STAR["tweet_aspects"]).withColumn("aspect", F.raise_error(F.lit("boom")).cast("string"))
    )
    with pytest.raises(Exception, match="boom"):
        store.load(bad)
    assert rows(store.read("tweets").select("full_text")) == [("t",)] and rows(store.read("tweet_products")) == [("1", "a")]
    store.load(tables(spark, post("1", "fixed")))
    assert rows(store.read("tweets").select("full_text")) == [("fixed",)] and store.read("tweet_products").count() == 0


def test_last_per_id(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "tweet_id string, o int, v string")
    assert rows(star.last_per_id(df, "o").select("tweet_id", "v")) == [("a", "z"), ("b", "q")]


def test_views_export_and_warehouse(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, post("1", 'a "b",\nc', causes=[("age", "")]), post("2", vector=None)))
    store.register_views()
    sql = "SELECT cause_category, COUNT(DISTINCT t.tweet_id) n FROM tweets t JOIN tweet_causes c ON t.tweet_id = c.tweet_id GROUP BY 1"
    assert rows(spark.sql(sql)) == [("age", 1)]
    report = export_star(spark, str(tmp_path / "s"), str(tmp_path / "csv"))
    assert report == {"tweets": 2, "tweet_causes": 1, "tweet_products": 0, "tweet_brands": 0, "tweet_barriers": 0, "tweet_aspects": 0}
    loaded = load_exports(spark, str(tmp_path / "csv"), str(tmp_path / "wh"))
    assert loaded["tweets"] == 2 and loaded["tweet_causes"] == 1
    back = spark.read.parquet(str(tmp_path / "wh" / "tweets")).orderBy("tweet_id").collect()
    assert [(r.full_text, r.embedding, r.is_spam) for r in back] == [('a "b",\nc', "[0.5,0.5]", 0), ("t", None, 0)]
    assert load_exports(spark, str(tmp_path / "none"), str(tmp_path / "wh2"))["tweets"] is None


def test_a_load_that_fails_midway_leaves_the_old_tables(spark, tmp_path):
    from postloom.sources.export import load_warehouse

    src, target = tmp_path / "csv", tmp_path / "wh"
    schemas = {"a": "i int, s string", "b": "i int"}

    def put(table, name, data):
        (src / table).mkdir(parents=True, exist_ok=True)
        (src / table / name).write_bytes(data)

    def state():
        return {t: rows(spark.read.parquet(str(target / t))) for t in ("a", "b")}

    put("a", "1.csv", b'i,s\n1,"x\ny"\n2,\n')
    put("b", "1.csv", b"i\n7\n")
    load = lambda: load_warehouse(spark, str(src), ["a", "b", "c"], str(target), schemas=schemas)
    assert load() == {"a": 2, "b": 1, "c": None}
    old = state()
    # the first table would load; the second ends in the middle of a broken file
    put("a", "2.csv", b"i,s\n3,z\n")
    put("b", "2.csv.gz", b"not gzip at all")
    with pytest.raises(Exception, match="(?i)gzip|exception"):
        load()
    assert state() == old
    assert sorted(os.listdir(target)) == ["a", "b"]
    os.truncate(src / "b" / "2.csv.gz", 0)
    put("b", "2.csv.gz", __import__("gzip").compress(b"i\n8\n9\n"))
    assert load() == {"a": 3, "b": 3, "c": None}
    assert state()["b"] == [(7,), (8,), (9,)]
    assert sorted(os.listdir(target)) == ["a", "b"]


def test_a_copy_that_lost_rows_is_refused(spark, tmp_path):
    from postloom.sources.export import _verify

    df = spark.createDataFrame([(1,), (2,)], "i int")
    df.write.parquet(str(tmp_path / "t"))
    _verify(spark, str(tmp_path / "t"), "parquet", {}, df.schema, 2)
    with pytest.raises(ValueError, match="2 rows instead of 3"):
        _verify(spark, str(tmp_path / "t"), "parquet", {}, df.schema, 3)
    with pytest.raises(ValueError, match="columns"):
        _verify(spark, str(tmp_path / "t"), "parquet", {}, df.select(F.col("i").cast("string").alias("i")).schema, 2)


def test_one_bad_table_does_not_stop_the_others(spark, tmp_path):
    from postloom.sources.export import export_csv

    good = spark.createDataFrame([(1,)], "i int")
    bad = good.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    report = export_csv({"bad": bad, "good": good}, str(tmp_path))
    assert "boom" in report["bad"] and report["good"] == 1


def test_a_claim_of_a_dead_writer_is_taken_over(spark, tmp_path):
    from postloom.sources.files import create_file, read_text

    path = str(tmp_path / "m" / "1.json")
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.json.claim").write_text("")
    assert not create_file(spark, path, "early")  # its writer may still be at work
    assert create_file(spark, path, "late", patience=-1)
    assert not create_file(spark, path, "again", patience=-1) and read_text(spark, path) == "late"
    assert sorted(f for f in os.listdir(tmp_path / "m") if not f.endswith(".crc")) == ["1.json", "1.json.claim"]


def test_whole_reads_shuffle_no_row_where_few_ids_were_replaced(spark, tmp_path, plan):
    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, *[post(str(i), products=["p"]) for i in range(9)]))
    store.load(tables(spark, post("1", "new"), post("9")), removed=spark.createDataFrame([("2",)], "tweet_id string"))
    whole = store.read("tweets")
    assert "BroadcastHashJoin" in plan(whole) and "hashpartitioning" not in plan(whole)
    kept = [(str(i), "new" if i == 1 else "t") for i in range(10) if i != 2]
    assert rows(whole.select("tweet_id", "full_text")) == kept
    assert rows(store.read("tweet_products")) == [(str(i), "p") for i in range(9) if i not in (1, 2)]


def test_a_load_computes_its_batch_once(spark, tmp_path):
    store, count = StarStore(spark, str(tmp_path / "s")), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    batch = tables(spark, post("1"), post("2"))
    batch["tweets"] = batch["tweets"].coalesce(1).mapInArrow(seen, batch["tweets"].schema)
    assert store.load(batch) == 1 and count.value == 2
    none = {t: df.limit(0) for t, df in tables(spark, post("0")).items()}
    assert store.load(none) == 1 and len([f for f in os.listdir(tmp_path / "s") if f.startswith("load-")]) == 1


def test_reads_of_few_ids_shuffle_no_row(spark, tmp_path, plan):
    store = StarStore(spark, str(tmp_path / "s"))
    store.load(tables(spark, *[post(str(i)) for i in range(9)]))
    store.load(tables(spark, post("1", "new")))
    some = store.read("tweets", spark.createDataFrame([("1",), ("2",)], "tweet_id string"))
    assert "BroadcastHashJoin" in plan(some) and "hashpartitioning" not in plan(some)
    assert rows(some.select("tweet_id", "full_text")) == [("1", "new"), ("2", "t")]
