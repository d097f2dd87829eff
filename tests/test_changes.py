"""Changed rows only, from stream to star, against the batch job over everything."""

import csv
import json

import pytest

from postloom.plans.changes_job import enrich_changes
from postloom.plans.enrich_job import EnrichConfig, enrich
from postloom.schemas import STAR
from postloom.sources.lookup import lookup_table
from postloom.sources.star_store import Conflict, StarStore
from postloom.streaming.landing import ingest_new_files
from tests.test_star_store import post, rows, tables

HEADER = ["tweet_id", "text", "likes"]


def factory(log, down):
    def make():
        def label(texts):
            with open(log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            if "refuse" in texts[0] or ("flaky" in texts[0] and down.exists()):
                raise RuntimeError("no connection")
            return [json.dumps({
                "intent": "Venting", "sentiment": "negative", "causes": [{"cause_category": "stress", "matched_sentence": texts[0]}],
                "products": ["shampoo"], "barriers": [{"barrier_code": "price"}], "brands_raw": [{"brand_raw": "dove"}],
                "aspects": [{"aspect": "sensory", "sentiment": "positive", "span_text": texts[0][:4]}],
            })]

        return label

    return make


class Arrivals:
    def __init__(self, spark, path):
        self.spark, self.path, self.log, self.down = spark, path, path / "calls.txt", path / "down"
        self.raw = path / "raw"
        self.raw.mkdir()
        self.log.touch()

    def arrive(self, name, *posts):
        with open(self.raw / name, "w", newline="") as f:
            csv.writer(f).writerows([HEADER, *posts])
        p = self.path
        return ingest_new_files(self.spark, str(self.raw), HEADER, str(p / "merged"), str(p / "ckpt"))

    def config(self, name):
        p = self.path
        return EnrichConfig(
            input=str(p / "merged"), store=str(p / name / "star"), cache=str(p / name / "cache"), dead_letters=str(p / name / "dead"),
            labeller=factory(str(self.log), self.down), model_name="m", chunks=1, call_pause=0, retry_wait=0, skip_embeddings=True)

    def step(self):
        self.log.write_text("")
        return enrich_changes(self.spark, self.config("steps"), lookup_table(self.spark, {"dove": "Dove"}))

    def calls(self):
        return sorted(set(self.log.read_text().splitlines()))

    def tables(self, name):
        store = StarStore(self.spark, self.config(name).store)
        return {t: sorted(str(tuple(r)) for r in store.read(t).collect()) for t in STAR}

    def whole(self, name):
        enrich(self.spark, self.config(name), lookup_table(self.spark, {"dove": "Dove"}))
        return self.tables(name)


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


def test_three_arrivals_equal_one_run(spark, arrivals):
    arrivals.arrive("b.csv", *[[i, f"text of number {i} as it came", 5] for i in range(8)], ["x", "short", 1], ["y", "please refuse this one text", 1])
    first = arrivals.step()
    assert first.counts["extracted"] == 10 and first.counts["enriched"] == 8
    # 0: same winner; 1: other text; 2: only its likes; 3: becomes spam; 9: new; " 4": the later row of an id; x: long enough
    arrivals.arrive("c.csv", [0, "a weaker copy of number 0", 2], [1, "number 1 has other words now", 9], [2, "text of number 2 as it came", 7],
                    [3, "no", 9], [9, "text of number 9 as it came", 1], [" 4", "what number 4 says at last", 3], ["x", "this one is long enough now", 2])
    second = arrivals.step()
    # rows cleaned: 1, 2, 3, 9, x, " 4" with 4, and y, which failed; asked: 1, 4 once more, 9, x, y
    assert second.counts["extracted"] + second.counts["skipped"] == 8
    assert arrivals.calls() == sorted([
        "number 1 has other words now", "text of number 4 as it came", "text of number 9 as it came", "this one is long enough now",
        "please refuse this one text"])
    # an earlier file by name: the first row of an id moves, and with it the text that is asked for " 5" and "5"
    arrivals.arrive("a.csv", [" 5", "what number 5 said before", 1], [3, "number 3 is a proper text again", 20])
    third = arrivals.step()
    assert third.counts["extracted"] + third.counts["skipped"] == 4
    assert arrivals.tables("steps") == arrivals.whole("once")
    # nothing has come: nothing but the failed post is read, and the version stays
    version = StarStore(spark, arrivals.config("steps").store).current()[0]
    last = arrivals.step()
    assert last.counts["extracted"] == 1 and arrivals.calls() == ["please refuse this one text"]
    assert StarStore(spark, arrivals.config("steps").store).current()[0] == version


def test_a_failed_call_is_tried_again(spark, arrivals):
    arrivals.arrive("a.csv", [1, "a steady text with words", 1], [2, "a flaky text with words", 1])
    arrivals.down.touch()
    arrivals.step()
    assert [r.tweet_id for r in StarStore(spark, arrivals.config("steps").store).read("tweets").collect()] == ["1"]
    arrivals.down.unlink()
    assert arrivals.step().counts["calls"] == 1
    assert sorted(r.tweet_id for r in StarStore(spark, arrivals.config("steps").store).read("tweets").collect()) == ["1", "2"]


def test_many_arrivals_across_a_merge_of_loads(spark, arrivals):
    for n in range(10):
        store = arrivals.arrive(f"{n}.csv", [n, f"text of number {n} as it came", 1], [n - 1, f"number {n - 1} once more", n + 1])
        if n in (2, 9):
            counts = arrivals.step().counts
    assert len(store.state()["loads"]) < 10 and counts["extracted"] == 8
    assert arrivals.tables("steps") == arrivals.whole("once")


def test_a_run_from_an_old_state_loads_nothing(spark, arrivals):
    arrivals.arrive("a.csv", [1, "a steady text with words", 1])
    arrivals.step()
    target = StarStore(spark, arrivals.config("steps").store)
    with pytest.raises(Conflict):
        target.load(tables(spark, post("7")), mark=9, base=target.current()[0] - 1)
    assert target.state()["mark"] == 1 and target.read("tweets").count() == 1


def test_no_rows_at_all_and_limits(spark, arrivals):
    assert arrivals.step().stopped_after == "clean"
    with pytest.raises(ValueError):
        cfg = arrivals.config("steps")
        enrich_changes(spark, EnrichConfig(**{**cfg.__dict__, "limit": 3}), lookup_table(spark, {}))


def test_removals_hold_across_merges_until_an_id_comes_back(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    nothing = {t: df.limit(0) for t, df in tables(spark, post("0")).items()}
    gone = lambda *ids: spark.createDataFrame([(i,) for i in ids], "tweet_id string")
    store.load(tables(spark, *[post(str(i), products=["p"]) for i in range(6)]))
    for _ in range(7):
        store.load(tables(spark, post("9")))
    assert [load["tier"] for load in store.state()["loads"]] == [1]
    store.load(nothing, removed=gone("1", "2"))
    store.load(tables(spark, post("2", "back")), removed=gone("3"))
    want = [("0", "t"), ("2", "back"), ("4", "t"), ("5", "t"), ("9", "t")]
    state = lambda: rows(store.read("tweets").select("tweet_id", "full_text"))
    assert state() == want and rows(store.read("tweet_products")) == [("0", "p"), ("4", "p"), ("5", "p")]
    for _ in range(6):
        store.load(tables(spark, post("9")), mark=4)
    held = store.state()
    assert [load["tier"] for load in held["loads"]] == [1, 1] and held["loads"][1]["removed"] and held["mark"] == 4
    assert state() == want and rows(store.read("tweet_products")) == [("0", "p"), ("4", "p"), ("5", "p")]
    assert rows(store.changes(8, held["version"]).select("tweet_id")) == [("2",)]


def test_reads_of_some_ids_filter_before_they_group(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "star"))
    for n in range(3):
        store.load(tables(spark, post(str(n), products=["a"]), post("x", str(n))))
    ids = spark.createDataFrame([("x",), ("1",)], "tweet_id string")
    assert rows(store.read("tweets", ids).select("tweet_id", "full_text")) == [("1", "t"), ("x", "2")]
    assert rows(store.read("tweet_products", ids)) == [("1", "a")]
