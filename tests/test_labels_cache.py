import json
import random
import re

import pytest
from pyspark.sql import functions as F

from postloom import Vocabulary, VocabularyTable, default_vocabulary
from postloom.operators import annotate as ann
from postloom.operators import cache, labels
from postloom.sources import cache_store

VOCAB = default_vocabulary()


def reference_normalize(raw):
    """The rules of SURVEY 2.9, in plain Python: (labels, error codes)."""

    def tok(v, snake=True):
        t = ("None" if v is None else str(v)).strip().lower()
        return t.replace(" ", "_") if snake else t

    def word(name, v, snake=True):
        return VOCAB.mapping(name).get(tok(v, snake), VOCAB.default(name))

    if not isinstance(raw, dict):
        return None, ["response:not_an_object"]
    errors, items = [], {}
    for f in labels.LISTS:
        if f in raw and not isinstance(raw[f], list):
            errors.append(f"{f}:not_a_list")
        items[f] = [x for x in raw.get(f) or [] if isinstance(x, dict)] if isinstance(raw.get(f), list) else []
    if any("matched_sentence" in c and not isinstance(c["matched_sentence"], str) for c in items["causes"]):
        errors.append("causes.matched_sentence:not_a_string")
    if any(a.get("sentiment") not in ("positive", "negative", "neutral") for a in items["aspects"]):
        errors.append("aspects.sentiment:not_allowed")
    if any(not isinstance(a.get("span_text"), str) or not a["span_text"] for a in items["aspects"]):
        errors.append("aspects.span_text:missing")
    if any(not isinstance(b.get("brand_raw"), str) or not b["brand_raw"] for b in items["brands_raw"]):
        errors.append("brands_raw.brand_raw:missing")
    products = raw.get("products") if isinstance(raw.get("products"), list) else []
    out = {
        "intent": word("intent", raw.get("intent", ""), False),
        "sentiment": word("sentiment", raw.get("sentiment", ""), False),
        "causes": [(word("cause", c.get("cause_category", "")), c.get("matched_sentence", "")) for c in items["causes"]],
        "products": [word("product", p) for p in products],
        "barriers": [(word("barrier", b.get("barrier_code", "")),) for b in items["barriers"]],
        "aspects": [(word("aspect", a.get("aspect", "")), a.get("sentiment"), a.get("span_text")) for a in items["aspects"]],
        "brands_raw": [
            (b.get("brand_raw"), None if b.get("product_type") is None else word("product", b["product_type"]))
            for b in items["brands_raw"]
        ],
    }
    return out, errors


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, response string")
    return labels.normalize_labels(df, VOCAB).orderBy("i").collect()


def check(spark, docs):
    for doc, row in zip(docs, run(spark, [json.dumps(d) for d in docs])):
        want, errors = reference_normalize(doc)
        assert row.errors == errors, doc
        if not errors:
            got = {
                k: [tuple(x) if not isinstance(x, str) else x for x in row[k]] if isinstance(row[k], list) else row[k]
                for k in want
            }
            assert got == want, doc


def test_edges(spark):
    check(spark, [
        {}, [], "x", 5, None, {"causes": None}, {"causes": []}, {"causes": "x"}, {"products": "x"}, {"products": None},
        {"products": [None, 1, {"a": 1}, ["shampoo"], " Dry Shampoo ", "HAIR OIL"]},
        {"intent": " VENTING "}, {"intent": "asking question"}, {"intent": 5}, {"intent": None}, {"intent": "promotion"},
        {"sentiment": "Negative"}, {"sentiment": "meh"},
        {"causes": [1, "a", None, [], {"cause_category": "Weather"}, {"cause_category": "water quality", "matched_sentence": "m"}]},
        {"causes": [{"matched_sentence": None}]}, {"causes": [{"matched_sentence": 3}]},
        {"barriers": [{"barrier_code": "availability"}, {"x": 1}, 2]}, {"barriers": {}},
        {"aspects": [{"aspect": "ingredient", "sentiment": "positive", "span_text": " "}]},
        {"aspects": [{"aspect": "sensory", "sentiment": "Positive", "span_text": "x"}]},
        {"aspects": [{"aspect": "sensory", "sentiment": "positive", "span_text": ""}]},
        {"aspects": [{"aspect": "sensory", "sentiment": "positive", "span_text": None}]},
        {"brands_raw": [{"brand_raw": "A"}, {"brand_raw": " ", "product_type": None}, {"brand_raw": "B", "product_type": "hair mask"}]},
        {"brands_raw": [{"brand_raw": ""}]}, {"brands_raw": [{"product_type": "x"}]}, {"extra": {"deep": [1]}},
    ])


def test_random_documents(spark):
    rnd = random.Random(3)
    atoms = [None, 1, True, "", " ", "Stress", "price", "positive", "neutral", "hair oil", {}, [], "other", "Sensory"]
    keys = ["cause_category", "matched_sentence", "barrier_code", "aspect", "sentiment", "span_text", "brand_raw", "product_type"]

    def item():
        return rnd.choice(atoms) if rnd.random() < 0.15 else {
            k: rnd.choice([a for a in atoms if a is None or isinstance(a, str)] if rnd.random() < 0.8 else atoms)
            for k in rnd.sample(keys, rnd.randrange(1, 7))
        }

    def doc():
        d = {}
        for f in (*labels.LISTS, "products"):
            if rnd.random() < 0.5:
                d[f] = [item() for _ in range(rnd.randrange(3))] if rnd.random() < 0.9 else rnd.choice(atoms)
        for f in ("intent", "sentiment"):
            if rnd.random() < 0.7:
                d[f] = rnd.choice(atoms[3:])
        return d

    docs = [doc() for _ in range(400)]
    # str() of a container or a boolean differs between languages, but none of them is a label
    check(spark, docs)


def test_broken_json(spark):
    rows = run(spark, ["not json", "", '{"a": NaN}', '{"intent": "venting", "intent": "discovery"}', ' \n{"intent": "venting"}', None])
    assert [r.errors for r in rows] == [["response:not_an_object"]] * 3 + [[], []] + [["response:not_an_object"]]
    assert rows[3].intent == "discovery" and rows[4].intent == "venting"


def test_normalizing_twice_changes_nothing(spark):
    doc = {"intent": "recommendation", "causes": [{"cause_category": "weather"}], "products": ["hair mask"],
           "brands_raw": [{"brand_raw": "A", "product_type": "toner"}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "response string")
    once = labels.normalize_labels(df, VOCAB).select(labels.response_json().alias("response"))
    twice = labels.normalize_labels(once, VOCAB).select(labels.response_json().alias("response"))
    assert once.first() == twice.first()


def test_vocabulary_from_table(spark):
    rows = [(f, "ok", "ok") for f in ("intent", "sentiment", "cause", "product", "barrier", "aspect")]
    vocab = Vocabulary.from_table(spark.createDataFrame([*rows, ("intent", "o'k", "ok")], "field string, raw_value string, canonical_value string"))
    df = spark.createDataFrame([('{"intent": "O\'K", "sentiment": "zzz"}',)], "response string")
    row = labels.normalize_labels(df, vocab).first()
    assert (row.intent, row.sentiment) == ("ok", "neutral")


def vocabulary_rows(vocab):
    own = [(f, v, v) for f, values in vocab.values.items() for v in values]
    return own + [(f, raw, value) for f, said in vocab.synonyms.items() for raw, value in said.items()]


TABLE = "field string, raw_value string, canonical_value string"


def test_a_table_gives_what_the_literal_gives(spark):
    """Random responses, repeated rows, broken and null ones, and clashing spellings of two fields."""
    rnd = random.Random(5)
    vocab = Vocabulary({**VOCAB.values, "cause": (*VOCAB.values["cause"], "price")}, VOCAB.synonyms, VOCAB.defaults)
    said = [v for _, raw, value in vocabulary_rows(vocab) for v in (raw, value.upper(), f" {value.replace('_', ' ')} ")]
    said += [None, "", "no such", 5, "price:", "cause:stress", {"a": 1}]
    pick = lambda: rnd.choice(said)

    def doc():
        return json.dumps({
            "intent": pick(), "sentiment": pick(), "products": [pick() for _ in range(rnd.randrange(4))],
            "causes": [{"cause_category": pick(), "matched_sentence": "s"} for _ in range(rnd.randrange(3))],
            "barriers": rnd.choice([None, "x", [{"barrier_code": pick()}], [7, {"barrier_code": pick()}]]),
            "aspects": [{"aspect": pick(), "sentiment": rnd.choice(["positive", "Positive", "neutral", None, 3]), "span_text": "t"}][: rnd.randrange(2)],
            "brands_raw": [{"brand_raw": "b", "product_type": pick()}],
        })

    docs = [doc() for _ in range(300)]
    docs += docs[:20] + [None, "", "[1]", "{", "{}"]
    df = spark.createDataFrame(list(enumerate(docs)), "n int, response string")
    rows = vocabulary_rows(vocab)
    table = spark.createDataFrame([*rows, *rows[:5], ("cause", None, "stress"), (None, "x", "y")], TABLE)
    read = lambda v: [str(r) for r in labels.normalize_labels(df, v).orderBy("n").collect()]
    assert read(VocabularyTable(table, vocab.defaults)) == read(vocab)


def test_a_vocabulary_of_many_rows_is_joined(spark, plan):
    table = spark.range(20_000).selectExpr("'product' AS field", "'spelling_' || id AS raw_value", "'kind_' || id % 100 AS canonical_value")
    df = spark.createDataFrame([(i, json.dumps({"products": [f"Spelling {i * 977}", "kind 7", "kind 100"]})) for i in range(20)], "n int, response string")
    out = labels.normalize_labels(df, VocabularyTable(table))
    assert {r.n: r.products for r in out.collect()} == {i: [f"kind_{i * 977 % 100}", "kind_7", "other"] for i in range(20)}
    assert "Cartesian" not in plan(out) and "NestedLoop" not in plan(out)
    assert out.columns == labels.normalize_labels(df, VOCAB).columns
    # of several values for one spelling the greatest
    twice = spark.createDataFrame([("product", "a", "x"), ("product", "a", "y"), ("product", "a", "a")], TABLE)
    one = spark.createDataFrame([('{"products": ["A"]}',)], "response string")
    assert labels.normalize_labels(one, VocabularyTable(twice)).first().products == ["y"]
    assert labels.normalize_labels(one.limit(0), VocabularyTable(twice)).count() == 0
    with pytest.raises(ValueError, match="VocabularyTable"):
        Vocabulary.from_table(table)


def test_what_comes_back_from_a_vocabulary_is_merged(spark, plan, tmp_path):
    # From files, whose size the planner takes for that of what is grouped.
    spark.range(3000).selectExpr("'product' AS field", "'no_' || id AS raw_value", "'kind' AS canonical_value").write.parquet(f"{tmp_path}/v")
    spark.range(500).selectExpr("id", """'{"products": ["No ' || id || '"]}' AS response""").write.parquet(f"{tmp_path}/r")
    out = labels.normalize_labels(spark.read.parquet(f"{tmp_path}/r"), VocabularyTable(spark.read.parquet(f"{tmp_path}/v")))
    assert re.search(r"SortMergeJoin \[_row#\d+L?\], \[_row#\d+L?\], LeftOuter", plan(out))
    assert "BuildLeft" not in plan(out)
    assert out.filter("products = array('kind')").count() == 500


def test_cache_joins_and_import(spark, tmp_path):
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({
        "1": {"response": {"intent": "venting"}, "model": "m", "cached_at": "2024-01-01T00:00:00+00:00"},
        "2": {"response": None, "model": "m"}, "3": {"response": {}}, "4": {"response": {}, "model": None},
    }))
    stored = cache_store.read_json_cache(spark, str(path))
    posts = spark.createDataFrame([(str(i),) for i in range(1, 6)], "tweet_id string")
    assert sorted(r.tweet_id for r in cache.cache_misses(posts, stored).collect()) == ["2", "5"]
    hits = cache.cache_hits(posts, stored)
    assert sorted((r.tweet_id, r.model or "null") for r in hits.collect()) == [("1", "m"), ("3", "cached"), ("4", "null")]
    judged = labels.require_model(labels.normalize_labels(hits, VOCAB))
    assert sorted(r.tweet_id for r in labels.valid_rows(judged).collect()) == ["1", "3"]
    dead = labels.dead_letters(judged.withColumn("full_text", F.lit("t" * 300))).collect()
    assert [(d.tweet_id, d.error, len(d.tweet_text)) for d in dead] == [("4", "model:null", 200)]
    looked = cache.cache_lookup(posts, stored)
    assert looked.count() == 5 and looked.filter("response is null").count() == 2


def test_newest_answer_wins(spark):
    rows = [("1", "old", "a", "2024-01-01"), ("1", "new", "b", "2024-01-02"), ("1", None, "c", "2024-01-03"), ("2", "x", "d", None)]
    df = spark.createDataFrame(rows, "tweet_id string, response string, model string, at string")
    df = df.select("tweet_id", "response", "model", F.col("at").cast("timestamp").alias("cached_at"))
    assert sorted(tuple(r) for r in cache.usable_answers(df, df).collect()) == [("1", "new", "b"), ("2", "x", "d")]


def test_annotate_retries_and_isolates_failures(spark):
    def factory():
        seen = {}

        def label(texts):
            for t in texts:
                seen[t] = seen.get(t, 0) + 1
                if t == "bad" or (t == "flaky" and seen[t] < 3):
                    raise RuntimeError("down")
            return ["{" if t == "nojson" else "" if t == "empty" else '{"n": %d}' % len(t) for t in texts]

        return label

    posts = spark.createDataFrame([("a", 1), ("bad", 2), ("flaky", 3), ("nojson", 4), ("empty", 5), ("bb", 6)], "full_text string, i int").coalesce(1)
    for batch in (1, 4):
        out = ann.annotate(posts, factory, batch_size=batch, retry_wait=0, call_pause=0).orderBy("i").collect()
        assert [r.response for r in out] == ['{"n": 1}', None, '{"n": 5}', None, None, '{"n": 2}']
        assert [r.call_error for r in out] == [None, "down", None, "answer is not JSON after 3 tries", "empty answer", None]


@pytest.mark.parametrize("chunks", [1, 5])
def test_chunks_are_stable_and_cover(spark, chunks):
    ids = spark.range(100).select(F.col("id").cast("string").alias("tweet_id"))
    seen = [ids.filter(ann.chunk_of("tweet_id", chunks) == c).count() for c in range(chunks)]
    assert sum(seen) == 100


def test_annotate_holds_few_texts_at_a_time(spark, plan):
    posts = spark.createDataFrame([(i, f"text {i}") for i in range(3 * ann.ROWS)], "i int, full_text string").coalesce(1)
    factory = lambda: lambda texts: [json.dumps([t, len(texts)]) for t in texts]
    out = ann.annotate(posts, factory, batch_size=100, retry_wait=0, call_pause=0)
    assert "MapInArrow" in plan(out)
    # In slices of the first multiple of the batch size that reaches ROWS.
    said = [json.loads(r.response) for r in out.orderBy("i").collect()]
    assert [t for t, _ in said] == [f"text {i}" for i in range(768)] and [n for _, n in said] == [100] * 700 + [68] * 68
