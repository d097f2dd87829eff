import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from postloom.operators import clean
from postloom.plans import reports
from postloom.plans.enrich_job import EnrichConfig, enrich
from postloom.plans.ingest_job import ingest_landing
from postloom.schemas import STAR
from postloom.sources.cache_store import read_cache, read_dead_letters
from postloom.sources.csv_tables import read_merged
from postloom.sources.lookup import lookup_table, noise_table
from postloom.sources.star_store import StarStore
from postloom.streaming.landing import ingest_new_files

HEADER = ["tweet_id", "text", "likes", "retweets", "comments", "user_screen_name"]
TEXTS = {
    "1": "pantene makes my hair fall badly", "2": "stress stress stress again today", "3": "too short", "4": "broken answer for this one",
    "5": "the model is down for this text", "6": "dovee is good and cheap enough",
}


def factory(log):
    def make():
        def label(texts):
            with open(log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            text = texts[0]
            if "down" in text:
                raise RuntimeError("no connection")
            if "broken" in text:
                return ['{"aspects": [{"aspect": "sensory"}]}']
            return [json.dumps({
                "intent": "Complaining", "sentiment": "negative" if "badly" in text else "positive",
                "causes": [{"cause_category": "Stress", "matched_sentence": "a"}, {"cause_category": "stress", "matched_sentence": "b"}],
                "products": ["shampoo", "Shampoo"], "barriers": [{"barrier_code": "price"}],
                "brands_raw": [{"brand_raw": w} for w in text.split() if w in ("pantene", "dovee", "the", "stress")],
            })]

        return label

    return make


@pytest.fixture
def job(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "a.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(HEADER)
        out.writerows([[i, t, "3", "1", "", "u" + i] for i, t in TEXTS.items()])
        out.writerow([" 2", "the later copy of two wins here", "9", "", "", "x"])
    ingest_landing(spark, str(raw), str(tmp_path / "merged"))
    log = tmp_path / "calls.txt"
    log.touch()

    def run(**kw):
        cfg = EnrichConfig(
            **{**dict(
                input=str(tmp_path / "merged"), store=str(tmp_path / "star"), cache=str(tmp_path / "cache"), dead_letters=str(tmp_path / "dead"),
                labeller=factory(str(log)), model_name="m", chunks=2, call_pause=0, retry_wait=0), **kw})
        return enrich(spark, cfg, lookup_table(spark, {"pantene": "Pantene", "dove": "Dove"}), noise_table(spark, ["the", "stress"]))

    run.calls = lambda: log.read_text().splitlines()
    run.store = StarStore(spark, str(tmp_path / "star"))
    run.path = tmp_path
    return run


def test_texts_are_written_where_they_are_made_and_joined_only(spark, job, monkeypatch):
    """Of the cut points only the cleaned and the final rows hold whole texts; keys, answers and labels travel without."""
    from postloom.plans import enrich_job

    long = "pantene " + "hair falls badly " * 100
    rows = [[str(i), long + str(i), "1", "1", "", "u"] for i in range(5)] + [[" 3", long + "later", "2", "", "", "u"]]
    with open(job.path / "raw" / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows([HEADER, *rows])
    ingest_landing(spark, str(job.path / "raw"), str(job.path / "long"))
    made, write = {}, enrich_job.materialize
    monkeypatch.setattr(enrich_job, "materialize", lambda df, name, **kw: made.setdefault(name, write(df, name, **kw)))
    job(input=str(job.path / "long"), chunks=1)
    holds = {n for n, df in made.items() for r in df.collect() if any(isinstance(v, str) and len(v) > 500 for v in r)}
    assert holds == {"clean", "final"}
    got = {r.tweet_id: r.full_text for r in job.store.read("tweets").collect()}
    assert got == {str(i): (long + (str(i) if i != 3 else "later")) for i in range(5)}
    assert sorted(t[-1] for t in job.calls()) == list("01234")  # the first copy of 3 was asked


def test_a_run_hands_python_small_batches_and_writes_posts_where_they_stay(spark, job, monkeypatch):
    from postloom.plans import enrich_job

    key, made, write = "spark.sql.execution.arrow.maxBytesPerBatch", {}, enrich_job.materialize
    before = spark.conf.get(key)

    def watched(df, name, **kw):
        made[name] = (write(df, name, **kw), spark.conf.get(key), df._jdf.queryExecution().executedPlan().toString())
        return made[name][0]

    monkeypatch.setattr(enrich_job, "materialize", watched)
    result = job()
    assert {made[n][1] for n in ("clean", "answers")} == {"4m"} and spark.conf.get(key) == before
    star = str(job.path / "star")
    files = made["final"][0].inputFiles()
    assert files and all(star in f for f in files) and set(files) == set(job.store.read("tweets").inputFiles())
    # the texts are hashed to their labels, not sorted
    assert "ShuffledHashJoin" in made["final"][2] and "Sort" not in made["final"][2]
    assert sorted(r.tweet_id for r in result.enriched.collect()) == ["1", "2", "6"]


def test_few_and_many_misses_ask_the_same_posts(spark, job):
    """Posts are asked by a join with the rows to ask or with the others, whichever are fewer."""
    job(limit=2)
    assert len(job.calls()) == 2
    job(limit=5)
    asked = job.calls()
    assert sorted(set(asked)) == sorted(TEXTS[i] for i in "1245") and asked.count(TEXTS["1"]) == 1
    job()
    assert job.calls().count(TEXTS["6"]) == 1 and job.calls().count(TEXTS["2"]) == 1
    assert sorted(r.tweet_id for r in job.store.read("tweets").collect()) == ["1", "2", "6"]


def test_full_run_then_replay(spark, job):
    result = job()
    assert result.counts == {
        "skipped": 0, "extracted": 7, "spam": 1, "hits": 0, "calls": 4, "dead": 2, "enriched": 4, "embedded": 3,
        "mentions": 2, "normalized": 1, "noise": 3, "unknown": 1,
    }
    tables = {t: sorted(tuple(r) for r in job.store.read(t).collect()) for t in STAR}
    assert [r[0] for r in tables["tweets"]] == ["1", "2", "6"]
    assert dict((r.tweet_id, r.full_text) for r in job.store.read("tweets").collect())["2"] == "the later copy of two wins here"
    assert tables["tweet_brands"] == [("1", "pantene", "Pantene"), ("6", "dovee", "Dove")]
    assert tables["tweet_causes"] == [(i, "stress", "b") for i in "126"]
    assert tables["tweet_barriers"] == [(i, "price", "m") for i in "126"]
    dead = {r.tweet_id: (r.error, r.raw_response is None) for r in read_dead_letters(spark, str(job.path / "dead")).collect()}
    assert dead == {"4": ("aspects.sentiment:not_allowed; aspects.span_text:missing", False), "5": ("no connection", True)}
    assert job.calls().count(TEXTS["5"]) == 3
    assert read_cache(spark, str(job.path / "cache")).count() == 3  # both copies of 2 were asked once

    before = len(job.calls())
    again = job(skip_annotate=True)
    assert again.counts["hits"] == 4 and again.counts["calls"] == 0 and again.counts["dead"] == 0
    assert len(job.calls()) == before
    assert {t: sorted(tuple(r) for r in job.store.read(t).collect()) for t in STAR} == tables
    # rejected answers were not cached: the next full run asks for those two only
    job()
    assert set(job.calls()[before:]) == {TEXTS["4"], TEXTS["5"]}


def test_dry_run_limit_offset_and_stops(spark, job):
    dry = job(dry_run=True, skip_embeddings=True, limit=2, offset=1)
    assert dry.counts["extracted"] == 2 and dry.version is None and "embedded" not in dry.counts
    assert job.store.read("tweets").count() == 0
    assert [r.tweet_id for r in dry.enriched.collect()] == ["2"]
    nothing = job(offset=1000)
    assert nothing.stopped_after == "clean" and nothing.enriched is None
    empty = job(skip_annotate=True, cache=str(job.path / "other"))
    assert empty.stopped_after == "label"


def test_a_cached_answer_that_fails_stays_cached_and_dies_every_time(spark, job):
    bad = spark.createDataFrame([("1", "[]", "m")], "tweet_id string, response string, model string")
    bad.withColumn("cached_at", F.current_timestamp()).write.parquet(str(job.path / "bad"))
    for expected in (1, 2):
        out = job(cache=str(job.path / "bad"), skip_annotate=True)
        assert out.counts["dead"] == 1 and out.stopped_after == "label"
        assert read_dead_letters(spark, str(job.path / "dead")).count() == expected


def write_csv_file(path, rows, header=HEADER):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def raw_rows(seed, n):
    rng = random.Random(seed)
    return [[rng.choice(["", *map(str, range(9))]), f"text {seed} {i}", str(rng.randrange(4)), "", "", "u"] for i in range(n)]


COLS = ["tweet_id", "text", "likes", "user_screen_name", "user_username"]


def merged_rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.mark.parametrize("max_files", [1, 3, 100])
def test_stream_equals_batch(spark, tmp_path, max_files):
    """Ties, rows without an id, several files in one micro-batch, the larger one later by name."""
    folder = tmp_path / "raw"
    folder.mkdir()
    args = (spark, str(folder), HEADER, str(tmp_path / "store"), str(tmp_path / "ckpt"))
    write_csv_file(folder / "c.csv", raw_rows(1, 5))
    write_csv_file(folder / "d.csv", raw_rows(2, 60))
    ingest_new_files(*args, max_files=max_files)
    write_csv_file(folder / "a.csv", raw_rows(3, 10))
    write_csv_file(folder / "b.csv", raw_rows(4, 40))
    store = ingest_new_files(*args, max_files=max_files)
    ingest_landing(spark, str(folder), str(tmp_path / "merged"), missing_ids="file")
    batch = read_merged(spark, str(tmp_path / "merged"))
    want = merged_rows(batch)
    assert any(r[0].startswith("unknown_b.csv_") for r in want)
    assert merged_rows(store.read("merged")) == want
    # the order of first sight is the same as well, and the store can feed the enrichment job
    first = lambda df: [r.tweet_id for r in df.orderBy("row_ord").collect()]
    assert first(read_merged(spark, str(tmp_path / "store"))) == first(batch)
    # nothing new: nothing changes
    ingest_new_files(*args)
    assert merged_rows(store.read("merged")) == want


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for i, name in enumerate(["a.csv", "b.csv", "c.csv"]):
        write_csv_file(folder / name, raw_rows(i, 30))
    args = (spark, str(folder), HEADER, str(tmp_path / "store"))
    store = ingest_new_files(*args, str(tmp_path / "one"))
    want = merged_rows(store.read("merged"))
    # a lost checkpoint, other packing of files into tasks: all rows arrive again
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        ingest_new_files(*args, str(tmp_path / "two"), max_files=2)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert merged_rows(store.read("merged")) == want


def test_stream_feeds_clean_and_star(spark, job):
    raw = job.path / "raw"
    store = ingest_new_files(spark, str(raw), HEADER, str(job.path / "stream"), str(job.path / "ckpt"))
    result = job(input=str(job.path / "stream"))
    assert result.counts["extracted"] == 7 and result.counts["enriched"] == 4
    assert sorted(r.tweet_id for r in job.store.read("tweets").collect()) == ["1", "2", "6"]
    assert clean.clean_posts(store.read("merged")).count() == 7


def test_merge_job_takes_its_own_output_as_base(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_csv_file(folder / "a.csv", raw_rows(1, 40))
    ingest_landing(spark, str(folder), str(tmp_path / "first"), missing_ids="file")
    before = read_merged(spark, str(tmp_path / "first"))
    again = ingest_landing(spark, str(folder), str(tmp_path / "second"), base=str(tmp_path / "first"), missing_ids="file")
    assert merged_rows(read_merged(spark, str(tmp_path / "second"))) == merged_rows(before)
    assert again.after == before.count() and again.before == before.count() + 40


def test_counts_beyond_64_bits_do_not_end_the_job(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    big = "9000000000000000000"
    write_csv_file(folder / "a.csv", [["1", "most", big, big, big, "u"], ["1", "less", big, big, "", "u"], ["2", "x", "1", "", "", "u"]])
    assert ingest_landing(spark, str(folder), str(tmp_path / "m")).after == 2
    assert {r.tweet_id: r.text for r in read_merged(spark, str(tmp_path / "m")).collect()} == {"1": "most", "2": "x"}


def test_stored_vectors_are_reused(spark, job):
    job()
    seen = []

    def encoder(df, text_col, out_col):
        seen.extend(r[0] for r in df.select("tweet_id").collect())
        return df.withColumn(out_col, F.array(F.lit(9.0).cast("float")))

    result = job(skip_annotate=True, reuse_vectors=True, encoder=encoder)
    assert seen == [] and result.counts["embedded"] == 3
    assert all(len(r.embedding) == 384 for r in job.store.read("tweets").collect())


def test_trends_skip_no_silent_period(spark):
    rows = [("a", 1), ("a", 1), ("a", 4), ("b", 1), ("b", 2)]
    df = spark.createDataFrame(rows, "k string, d int")
    got = {(r.k, r.period): (r.n, r.delta) for r in reports.rising(df, "k", F.col("d"), F.lit(1)).collect()}
    assert got == {("a", 1): (2, None), ("a", 4): (1, 1), ("b", 1): (1, None), ("b", 2): (1, 0)}
    # days 0 to 9 without a negative, a long silence, one negative day: nothing recent to compare with
    days = spark.createDataFrame([("k", d, d == 50) for d in [*range(10), 50]], "k string, d int, neg boolean")
    assert reports.negative_spikes(days, "k", F.col("d"), F.col("neg")).filter("is_spike").count() == 0


def test_report_edges(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, f string")
    pred = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "a")], "id int, f string")
    acc = reports.passes_gate(reports.field_accuracy(pred, gold, "id", ["f"])).first()
    assert (acc.n, acc.accuracy, acc.passed) == (4, 0.75, False)
    got = {r.label: (r.support, r.precision, r.recall) for r in reports.class_scores(pred, gold, "id", "f").collect()}
    assert got["a"] == (2, 1.0, 0.5) and got["b"] == (1, 0.5, 1.0)
    days = spark.createDataFrame([("k", d, d == 9) for d in range(10) for _ in range(2)], "k string, d int, neg boolean")
    spikes = reports.negative_spikes(days, "k", F.col("d"), F.col("neg")).filter("is_spike").collect()
    assert [r.period for r in spikes] == [9]
