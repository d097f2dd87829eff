"""Reports over a star schema made of orders (posts), parts (entities) and line items (children)."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.plans import reports
from postloom.schemas import STAR
from workloads.base import query, table

TWEETS = (
    "SELECT CAST(o_orderkey AS {s}) AS tweet_id, CASE o_orderstatus WHEN 'F' THEN 'negative' WHEN 'O' THEN 'neutral' "
    "ELSE 'positive' END AS sentiment, CASE o_orderpriority WHEN '1-URGENT' THEN 'complaining' WHEN '2-HIGH' THEN "
    "'venting' ELSE 'other' END AS intent_label, CAST(o_custkey AS BIGINT) AS like_count FROM orders"
)
BRANDS = (
    "SELECT DISTINCT CAST(l_orderkey AS {s}) AS tweet_id, p_brand AS brand_canonical FROM lineitem "
    "JOIN part ON p_partkey = l_partkey"
)
PRODUCTS = (
    "SELECT DISTINCT CAST(l_orderkey AS {s}) AS tweet_id, p_type AS product_type FROM lineitem "
    "JOIN part ON p_partkey = l_partkey"
)
CAUSES = (
    "SELECT DISTINCT CAST(l_orderkey AS {s}) AS tweet_id, CASE l_returnflag WHEN 'A' THEN 'stress' WHEN 'N' THEN 'age' "
    "ELSE 'seasonal' END AS cause_category FROM lineitem"
)
BARRIERS = (
    "SELECT DISTINCT CAST(l_orderkey AS {s}) AS tweet_id, CASE l_linestatus WHEN 'O' THEN 'price' ELSE 'no_trust' END "
    "AS barrier_code FROM lineitem"
)
STAR_SQL = "WITH " + ", ".join(
    f"{name} AS ({sql.format(s='VARCHAR')})"
    for name, sql in (
        ("tweets", TWEETS), ("tweet_brands", BRANDS), ("tweet_products", PRODUCTS), ("tweet_causes", CAUSES),
        ("tweet_barriers", BARRIERS),
    )
)


def star(spark, sf_dir):
    for name in ("orders", "lineitem", "part"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return [spark.sql(sql.format(s="STRING")) for sql in (TWEETS, BRANDS, PRODUCTS, CAUSES, BARRIERS)]


def rounded(df, *cols, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "q_causes",
    STAR_SQL + """
    SELECT cause_category, count(DISTINCT t.tweet_id) AS tweet_count FROM tweets t JOIN tweet_causes c ON t.tweet_id = c.tweet_id
    GROUP BY cause_category ORDER BY tweet_count DESC
    """,
)
def q_causes(spark, sf_dir):
    tweets, _, _, causes, _ = star(spark, sf_dir)
    return reports.posts_per_cause(tweets, causes)


@query(
    "q_complaints",
    STAR_SQL + """
    SELECT brand_canonical, count(t.tweet_id) AS complaints_count, round(avg(like_count), 4) AS avg_likes
    FROM tweets t JOIN tweet_brands b ON t.tweet_id = b.tweet_id WHERE sentiment = 'negative'
    GROUP BY brand_canonical HAVING count(t.tweet_id) > 5 ORDER BY avg_likes DESC
    """,
)
def q_complaints(spark, sf_dir):
    tweets, brands, _, _, _ = star(spark, sf_dir)
    return rounded(reports.entity_complaints(tweets, brands), "avg_likes")


@query(
    "q_product_barrier",
    STAR_SQL + """
    SELECT product_type, barrier_code, count(*) AS occurrence_count
    FROM tweet_products p JOIN tweet_barriers b ON p.tweet_id = b.tweet_id
    GROUP BY product_type, barrier_code ORDER BY product_type, occurrence_count DESC
    """,
)
def q_product_barrier(spark, sf_dir):
    _, _, products, _, barriers = star(spark, sf_dir)
    return reports.barriers_per_product(products, barriers)


@query(
    "q_cause_sentiment",
    STAR_SQL + """
    SELECT cause_category, sentiment, count(DISTINCT t.tweet_id) AS n
    FROM tweets t JOIN tweet_causes c ON t.tweet_id = c.tweet_id WHERE sentiment = 'negative'
    GROUP BY cause_category, sentiment
    """,
)
def q_cause_sentiment(spark, sf_dir):
    tweets, _, _, causes, _ = star(spark, sf_dir)
    return reports.causes_by_sentiment(tweets, causes)


@query(
    "q_cause_avg",
    STAR_SQL + """
    SELECT cause_category, round(avg(like_count), 4) AS avg_likes
    FROM tweets t JOIN tweet_causes c ON t.tweet_id = c.tweet_id WHERE intent_label = 'complaining'
    GROUP BY cause_category ORDER BY avg_likes DESC
    """,
)
def q_cause_avg(spark, sf_dir):
    tweets, _, _, causes, _ = star(spark, sf_dir)
    return rounded(reports.likes_per_cause(tweets, causes), "avg_likes")


@query(
    "q_entity_cause",
    STAR_SQL + """
    SELECT brand_canonical, cause_category, count(*) AS n
    FROM tweets t JOIN tweet_brands b ON t.tweet_id = b.tweet_id JOIN tweet_causes c ON t.tweet_id = c.tweet_id
    GROUP BY brand_canonical, cause_category
    """,
)
def q_entity_cause(spark, sf_dir):
    tweets, brands, _, causes, _ = star(spark, sf_dir)
    return reports.entities_by_cause(tweets, brands, causes)


@query(
    "q_sql_views",
    STAR_SQL + """
    SELECT brand_canonical, count(t.tweet_id) AS complaints_count
    FROM tweets t JOIN tweet_brands b ON t.tweet_id = b.tweet_id WHERE sentiment = 'negative'
    GROUP BY brand_canonical HAVING count(t.tweet_id) > 5
    """,
)
def q_sql_views(spark, sf_dir):
    """The same report as plain SQL over views, with a select alias in HAVING."""
    tweets, brands, *_ = star(spark, sf_dir)
    assert "tweet_brands" in STAR
    tweets.createOrReplaceTempView("tweets")
    brands.createOrReplaceTempView("tweet_brands")
    return spark.sql(
        """
        SELECT tb.brand_canonical, COUNT(t.tweet_id) AS complaints_count
        FROM tweets t JOIN tweet_brands tb ON t.tweet_id = tb.tweet_id
        WHERE t.sentiment = 'negative'
        GROUP BY tb.brand_canonical HAVING complaints_count > 5
        """
    )


@query(
    "influence_tier",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 500 THEN 'mid' ELSE 'low' END AS influence_tier
    FROM customer
    """,
)
def influence_tier(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", reports.influence_tier(F.col("c_acctbal")).alias("influence_tier"))


@query(
    "share",
    "SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM events "
    "GROUP BY event_type",
)
def share(spark, sf_dir):
    return rounded(reports.shares(table(spark, sf_dir, "events"), "event_type"), "share", digits=6)


@query(
    "rising",
    """
    WITH c AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period,
                      count(*) FILTER (WHERE event_type = 'purchase') AS n FROM events GROUP BY ALL)
    SELECT c.user_id, c.period, c.n,
           CASE WHEN c.period > (SELECT min(period) FROM c) THEN c.n - coalesce(b.n, 0) END AS delta
    FROM c LEFT JOIN c b ON b.user_id = c.user_id AND b.period + INTERVAL 1 DAY = c.period
    """,
)
def rising(spark, sf_dir):
    """Purchases stand for positive mentions, users for brands: most are silent on some days."""
    day, step = F.date_trunc("day", "ts").cast("timestamp_ntz"), F.expr("INTERVAL 1 DAY")
    return reports.rising(table(spark, sf_dir, "events"), "user_id", day, step, F.col("event_type") == "purchase")


@query(
    "spike",
    """
    WITH c AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS n,
                      count(*) FILTER (WHERE event_type = 'error') AS negatives FROM events GROUP BY ALL),
    s AS (SELECT *, negatives / n AS share FROM c),
    w AS (SELECT *, avg(share) OVER p AS m, stddev_samp(share) OVER p AS sd FROM s
          WINDOW p AS (PARTITION BY user_id ORDER BY period
                       RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT user_id, period, n, negatives, round(share, 6) AS share, coalesce(share > m + 2 * sd + 1e-9, false) AS is_spike
    FROM w
    """,
)
def spike(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    number = F.datediff("period", F.lit("1970-01-01").cast("date"))
    out = reports.negative_spikes(
        table(spark, sf_dir, "events"), "user_id", day, F.col("event_type") == "error", number=number
    )
    return out.select("user_id", "period", "n", "negatives", F.round("share", 6).alias("share"), "is_spike")


_EVAL = (
    "(SELECT l.doc_id, quality AS g, CASE WHEN n_chars > 200 THEN 1 ELSE 0 END AS p, toxic AS gt, "
    "CASE WHEN n_chars < 50 THEN 1 ELSE 0 END AS pt FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
)


def evaluated(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 200, 1).otherwise(0).alias("quality"),
        F.when(F.col("n_chars") < 50, 1).otherwise(0).alias("toxic"),
    )
    return docs, table(spark, sf_dir, "labels")


@query(
    "evaluate",
    f"""
    SELECT 'quality' AS field, count(*) AS n, round(avg(CASE WHEN p = g THEN 1 ELSE 0 END), 6) AS accuracy,
           avg(CASE WHEN p = g THEN 1 ELSE 0 END) >= 0.85 AS passed FROM {_EVAL}
    UNION ALL
    SELECT 'toxic', count(*), round(avg(CASE WHEN pt = gt THEN 1 ELSE 0 END), 6),
           avg(CASE WHEN pt = gt THEN 1 ELSE 0 END) >= 0.85 FROM {_EVAL}
    """,
)
def evaluate(spark, sf_dir):
    accuracy = reports.field_accuracy(*evaluated(spark, sf_dir), "doc_id", ["quality", "toxic"])
    return rounded(reports.passes_gate(accuracy), "accuracy", digits=6)


@query(
    "evaluate_classes",
    f"""
    WITH v AS (SELECT g AS label FROM {_EVAL} UNION SELECT p FROM {_EVAL})
    SELECT label, (SELECT count(*) FROM {_EVAL} WHERE g = label) AS support,
           round((SELECT count(*) FILTER (WHERE g = p) / nullif(count(*), 0) FROM {_EVAL} WHERE p = label), 6) AS precision,
           round((SELECT count(*) FILTER (WHERE g = p) / nullif(count(*), 0) FROM {_EVAL} WHERE g = label), 6) AS recall
    FROM v
    """,
)
def evaluate_classes(spark, sf_dir):
    out = reports.class_scores(*evaluated(spark, sf_dir), "doc_id", "quality")
    return rounded(out, "precision", "recall", digits=6)


@query(
    "cost_estimate",
    """
    SELECT lang, count(*) AS n, CAST(sum(CAST(ceil(n_chars / 4.0) AS BIGINT) + 200) AS BIGINT) AS tokens,
           round(sum(ceil(n_chars / 4.0) + 200) * 0.43 / 1e6, 6) AS price
    FROM documents GROUP BY lang
    """,
)
def cost_estimate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = reports.cost_estimate(docs, F.col("n_chars"), 4.0, 200, 0.43, "lang")
    return rounded(out, "price", digits=6)
