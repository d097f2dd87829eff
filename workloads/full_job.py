"""The enrichment job end to end: labels of every kind, noise and typos in names, rejects, replay, export."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from postloom.plans.changes_job import enrich_changes
from postloom.plans.enrich_job import EnrichConfig, enrich
from postloom.plans.export_job import export_star, load_exports
from postloom.plans.ingest_job import ingest_landing
from postloom.schemas import STAR
from postloom.session import TEXTS, scratch_path
from postloom.sources.cache_store import read_cache, read_dead_letters
from postloom.sources.csv_tables import WRITE, read_merged, write_csv
from postloom.sources.lookup import lookup_table, noise_table
from postloom.sources.star_store import StarStore
from postloom.streaming.landing import ingest_new_files
from workloads.base import URL, query, table
from workloads.jobs import _STAGE, merged_documents
from workloads.labels import rule_labeller
from workloads.text import CLEAN_SQL, POST

# What the labeller writes for a text of k characters, by k modulo the number of choices, and what becomes of it.
INTENT = (("Venting", "venting"), ("COMPLAINING", "complaining"), ("recommendation", "seeking_recommendation"), ("no such", "other"))
SENTIMENT = (("Negative", "negative"), ("meh", "neutral"), (" positive", "positive"))
CAUSE_1 = (("Stress", "stress"), ("water quality", "water_quality"), ("weather", "seasonal"), ("luck", "other"))
CAUSE_2 = (("stress", "stress"), ("AGE ", "age"), ("seasonal", "seasonal"))
PRODUCT = (("Hair Lotion", "hair_tonic"), ("shampoo", "shampoo"), ("hair color", "other"))
BARRIER = (("Price", "price"), ("side effects", "side_effects"), ("sensory", "other"))
ASPECT = (("hair quality", "hair_quality"), ("ingredients", "other"))
# (name as written, canonical name): exact, exact after folding, a typo, unknown, and three kinds of noise.
BRAND = (("dove", "Dove"), ("PANTENE", "Pantene"), ("dovee", "Dove"), ("Zeta Labs", "Zeta Labs"), ("zz", None), ("my link bio", None), ("yang", None))
LOOKUP = {"dove": "Dove", "pantene": "Pantene"}


def labeller():
    def pick(choices, k):
        return choices[k % len(choices)][0]

    def one(text):
        k = len(text)
        if k < 20:
            raise ValueError("too short to judge")
        span = {} if k % 10 == 9 else {"span_text": f"s{k}"}
        return json.dumps({
            "intent": pick(INTENT, k), "sentiment": pick(SENTIMENT, k), "products": [pick(PRODUCT, k)] * 2,
            "causes": [{"cause_category": pick(CAUSE_1, k), "matched_sentence": f"m{k}"}, {"cause_category": pick(CAUSE_2, k)}],
            "barriers": [{"barrier_code": pick(BARRIER, k)}], "brands_raw": [{"brand_raw": pick(BRAND, k), "product_type": None}],
            "aspects": [{"aspect": pick(ASPECT, k), "sentiment": "positive", **span}],
        })

    return lambda texts: [one(t) for t in texts]


def _case(choices) -> str:
    value = lambda v: "NULL" if v is None else f"'{v}'"
    return f"(CASE n_clean % {len(choices)} " + " ".join(f"WHEN {i} THEN {value(v)}" for i, (_, v) in enumerate(choices)) + " END)"


_RAW_BRAND = "(CASE n_clean % 7 " + " ".join(f"WHEN {i} THEN '{r}'" for i, (r, _) in enumerate(BRAND)) + " END)"
_LABELLED = _STAGE + """
    , asked AS (SELECT CAST(doc_id AS VARCHAR) AS tweet_id, n_clean FROM c WHERE accepted AND NOT is_spam),
    v AS (SELECT * FROM asked WHERE n_clean >= 20 AND n_clean % 10 <> 9)
"""


def _config(root: str, **options) -> EnrichConfig:
    plain = dict(
        input=f"{root}/merged", store=f"{root}/star", cache=f"{root}/cache", dead_letters=f"{root}/dead", labeller=labeller,
        model_name="rules", chunks=2, call_pause=0, retry_wait=0,
    )
    return EnrichConfig(**{**plain, **options})


def finished(spark, sf_dir: str):
    """Folder of a job that has just run over every document, its counters, and its lookup tables."""
    root = scratch_path(spark, "job")
    merged_documents(spark, sf_dir).write.options(**TEXTS).parquet(f"{root}/merged")
    lookup, noise = lookup_table(spark, LOOKUP), noise_table(spark, ["yang"])
    result = enrich(spark, _config(root), lookup, noise)
    return root, dict(result.counts), lookup, noise


def stored(spark, sf_dir, name):
    return StarStore(spark, f"{finished(spark, sf_dir)[0]}/star").read(name)


@query(
    "enrich_tweets",
    _LABELLED + f"SELECT tweet_id, {_case(INTENT)} AS intent_label, {_case(SENTIMENT)} AS sentiment, 'rules' AS coded_by, "
    "384 AS dimensions FROM v",
)
def enrich_tweets(spark, sf_dir):
    rows = stored(spark, sf_dir, "tweets")
    return rows.select("tweet_id", "intent_label", "sentiment", "coded_by", F.size("embedding").alias("dimensions"))


@query(
    "enrich_causes",
    _LABELLED + f"""
    , l AS (SELECT tweet_id, {_case(CAUSE_1)} AS cause_category, 'm' || n_clean AS matched_sentence, 1 AS pos FROM v
            UNION ALL SELECT tweet_id, {_case(CAUSE_2)}, '', 2 FROM v)
    SELECT tweet_id, cause_category, arg_max(matched_sentence, pos) AS matched_sentence FROM l GROUP BY ALL
    """.replace("GROUP BY ALL", "GROUP BY tweet_id, cause_category"),
)
def enrich_causes(spark, sf_dir):
    return stored(spark, sf_dir, "tweet_causes")


@query("enrich_products", _LABELLED + f"SELECT tweet_id, {_case(PRODUCT)} AS product_type FROM v")
def enrich_products(spark, sf_dir):
    return stored(spark, sf_dir, "tweet_products")


@query(
    "enrich_brands",
    _LABELLED + f"SELECT tweet_id, {_RAW_BRAND} AS brand_raw, {_case(BRAND)} AS brand_canonical FROM v WHERE {_case(BRAND)} IS NOT NULL",
)
def enrich_brands(spark, sf_dir):
    return stored(spark, sf_dir, "tweet_brands")


@query("enrich_barriers", _LABELLED + f"SELECT tweet_id, {_case(BARRIER)} AS barrier_code, 'rules' AS coded_by FROM v")
def enrich_barriers(spark, sf_dir):
    return stored(spark, sf_dir, "tweet_barriers")


@query(
    "enrich_aspects",
    _LABELLED + f"SELECT tweet_id, {_case(ASPECT)} AS aspect, 'positive' AS sentiment, 's' || n_clean AS span_text FROM v",
)
def enrich_aspects(spark, sf_dir):
    return stored(spark, sf_dir, "tweet_aspects")


@query(
    "enrich_counters",
    _LABELLED + f"""
    SELECT (SELECT count(*) FROM c WHERE accepted) AS extracted, (SELECT count(*) FROM c WHERE NOT accepted) AS skipped,
           (SELECT count(*) FROM c WHERE accepted AND is_spam) AS spam, CAST(0 AS BIGINT) AS hits,
           (SELECT count(*) FROM asked WHERE n_clean >= 20) AS calls,
           (SELECT count(*) FROM asked WHERE n_clean < 20 OR n_clean % 10 = 9) AS dead,
           (SELECT count(*) FROM v) AS enriched, (SELECT count(*) FROM v) AS embedded,
           (SELECT count(*) FROM v WHERE {_case(BRAND)} IS NOT NULL) AS mentions,
           (SELECT count(*) FROM v WHERE n_clean % 7 < 2) AS normalized, (SELECT count(*) FROM v WHERE n_clean % 7 > 3) AS noise,
           (SELECT count(DISTINCT n_clean % 7) FROM v WHERE n_clean % 7 IN (2, 3)) AS unknown
    """,
)
def enrich_counters(spark, sf_dir):
    """The counters that the job gathers with ``observe`` while it runs."""
    counts = finished(spark, sf_dir)[1]
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts))


@query(
    "enrich_dead",
    _LABELLED + """
    SELECT tweet_id, CASE WHEN n_clean < 20 THEN 'too short to judge' ELSE 'aspects.span_text:missing' END AS error,
           n_clean < 20 AS no_response FROM asked WHERE n_clean < 20 OR n_clean % 10 = 9
    """,
)
def enrich_dead(spark, sf_dir):
    """The dead-letter log, read back."""
    dead = read_dead_letters(spark, f"{finished(spark, sf_dir)[0]}/dead")
    return dead.select("tweet_id", "error", F.col("raw_response").isNull().alias("no_response"))


@query(
    "enrich_replay",
    _LABELLED + "SELECT tweet_id, 'rules' AS model, true AS again FROM v",
)
def enrich_replay(spark, sf_dir):
    """The cache, read back, and whether a run that may only use the cache yields the id again, as a dry run."""
    root, _, lookup, noise = finished(spark, sf_dir)
    again = enrich(spark, _config(root, skip_annotate=True, skip_embeddings=True, dry_run=True, labeller=None), lookup, noise)
    cache = read_cache(spark, f"{root}/cache").select("tweet_id", "model")
    ids = again.enriched.select("tweet_id", F.lit(True).alias("again"))
    return cache.join(ids, "tweet_id", "full").withColumn("again", F.coalesce("again", F.lit(False)))


@query(
    "export_load",
    _LABELLED + f"""
    , n AS (SELECT count(*) AS all_rows, count({_case(BRAND)}) AS brands,
                   count(*) FILTER (WHERE {_case(CAUSE_1)} <> {_case(CAUSE_2)}) AS second_causes FROM v)
    SELECT name, CASE name WHEN 'tweet_brands' THEN brands WHEN 'tweet_causes' THEN all_rows + second_causes ELSE all_rows END AS exported,
           CASE name WHEN 'tweet_brands' THEN brands WHEN 'tweet_causes' THEN all_rows + second_causes ELSE all_rows END AS loaded
    FROM n, (SELECT unnest(['tweets', 'tweet_causes', 'tweet_products', 'tweet_brands', 'tweet_barriers', 'tweet_aspects']) AS name)
    """,
)
def export_load(spark, sf_dir):
    """Rows of each table that the export job wrote to CSV and the load job took from there."""
    root = finished(spark, sf_dir)[0]
    out = scratch_path(spark, "exports")
    written = export_star(spark, f"{root}/star", f"{out}/csv")
    loaded = load_exports(spark, f"{out}/csv", f"{out}/warehouse")
    rows = [(name, written[name], loaded[name]) for name in STAR]
    return spark.createDataFrame(rows, "name string, exported bigint, loaded bigint")


@query(
    "export_tweets",
    _LABELLED + f"""
    SELECT tweet_id, {_case(INTENT)} AS intent_label, {_case(SENTIMENT)} AS sentiment, CAST(0 AS INTEGER) AS is_spam,
           CAST(384 AS INTEGER) AS dimensions FROM v
    """,
)
def export_tweets(spark, sf_dir):
    """The parent table after its way through CSV into the warehouse: flags as numbers, vectors as text that reads back."""
    root = finished(spark, sf_dir)[0]
    export_star(spark, f"{root}/star", f"{root}/csv")
    load_exports(spark, f"{root}/csv", f"{root}/warehouse")
    rows = spark.read.parquet(f"{root}/warehouse/tweets")
    vector = F.size(F.from_json("embedding", "array<float>"))
    return rows.select("tweet_id", "intent_label", "sentiment", "is_spam", vector.alias("dimensions"))


# What the last arrival of a document says: one in five is reworded, one in eleven is cut to a text that counts as spam.
_LATEST = f"CASE WHEN doc_id % 11 = 0 THEN 'gone' WHEN doc_id % 5 = 0 THEN 'once more ' || {POST} ELSE {POST} END"


@query(
    "stream_to_star",
    f"""
    WITH p AS (SELECT doc_id, n_chars, {_LATEST} AS post FROM documents),
    c AS (SELECT doc_id, n_chars, post, {CLEAN_SQL} AS clean FROM p),
    k AS (SELECT *, length(clean) AS n_clean FROM c WHERE clean <> '' AND NOT (length(clean) < 10
          OR 2 * coalesce(list_sum(list_transform(regexp_extract_all(post, '{URL}'), lambda u: length(u))), 0) > length(post)))
    SELECT CAST(doc_id AS VARCHAR) AS tweet_id, 10 * n_chars + CASE WHEN doc_id % 11 = 0 OR doc_id % 5 = 0 THEN 1 ELSE 0 END AS like_count,
           CAST(n_clean AS INTEGER) AS n_clean, CASE n_clean % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM k WHERE n_clean >= 20
    """,
)
def stream_to_star(spark, sf_dir):
    """Documents that arrive as CSV files in three steps, after each of which only the changed rows of the merged store are
    cleaned, labelled and loaded. The second brings new documents, reworded ones and ones that turn into spam, the third
    weaker copies, which change nothing. The star must be that of one run over everything."""
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "CAST(doc_id AS STRING) AS tweet_id", f"{POST} AS first", f"{_LATEST} AS latest", "10 * n_chars AS likes"
    )
    root, names = scratch_path(spark, "changes"), ["tweet_id", "text", "likes"]
    changed = "doc_id % 5 = 0 OR doc_id % 11 = 0"
    arrivals = [
        docs.filter("doc_id % 7 <> 3").selectExpr("tweet_id", "first AS text", "likes"),
        docs.filter(f"doc_id % 7 = 3 OR {changed}").selectExpr("tweet_id", "latest AS text", f"likes + CAST({changed} AS INT) AS likes"),
        docs.filter("doc_id % 4 = 0").selectExpr("tweet_id", "'a weaker copy of a post' AS text", "likes - 1 AS likes"),
    ]
    cfg = _config(root, labeller=rule_labeller, skip_embeddings=True, chunks=1)
    for rows in arrivals:
        rows.write.mode("append").options(**WRITE, compression="gzip").csv(f"{root}/landing")
        ingest_new_files(spark, f"{root}/landing", names, f"{root}/merged", f"{root}/checkpoint")
        enrich_changes(spark, cfg, lookup_table(spark, LOOKUP))
    star = StarStore(spark, f"{root}/star").read("tweets")
    return star.select("tweet_id", "like_count", F.length("full_text").alias("n_clean"), "sentiment")


@query(
    "ingest_job",
    """
    WITH r AS (SELECT 'u' || user_id AS tweet_id, event_type AS text, CAST(trunc(value) AS BIGINT) AS likes, event_id FROM events),
    w AS (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY likes DESC, event_id) AS rn FROM r)
    SELECT tweet_id, text, CAST(likes AS VARCHAR) AS likes, (SELECT count(*) FROM r) + (SELECT count(*) FROM w WHERE rn = 1) AS before,
           (SELECT count(*) FROM w WHERE rn = 1) AS after
    FROM w WHERE rn = 1
    """,
)
def ingest_job(spark, sf_dir):
    """The merge job over a landing folder, then again with its own Parquet output as base: nothing changes but the
    number of rows that came in."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "'u' || user_id AS tweet_id", "event_type AS text", "CAST(CAST(value AS BIGINT) AS STRING) AS likes"
    )
    root = scratch_path(spark, "ingest")
    write_csv(events.orderBy("event_id").select("tweet_id", "text", "likes"), f"{root}/landing")
    ingest_landing(spark, f"{root}/landing", f"{root}/first")
    counts = ingest_landing(spark, f"{root}/landing", f"{root}/second", base=f"{root}/first")
    rows = read_merged(spark, f"{root}/second").select("tweet_id", "text", "likes")
    return rows.withColumns({"before": F.lit(counts.before).cast("bigint"), "after": F.lit(counts.after).cast("bigint")})
