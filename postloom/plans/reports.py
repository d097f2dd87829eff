"""Reports over the star schema. Any SQL works too: ``StarStore.register_views`` and ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import materialize

ID = "tweet_id"


def posts_per_cause(tweets: DataFrame, causes: DataFrame) -> DataFrame:
    """Distinct posts per cause, most first."""
    joined = tweets.select(ID).join(causes.select(ID, "cause_category"), ID)
    out = joined.groupBy("cause_category").agg(F.countDistinct(ID).alias("tweet_count"))
    return out.orderBy(F.desc("tweet_count"), "cause_category")


def entity_complaints(tweets: DataFrame, brands: DataFrame, more_than: int = 5) -> DataFrame:
    """Negative posts and mean likes per entity with more than ``more_than`` of them."""
    negative = tweets.filter(F.col("sentiment") == "negative").select(ID, "like_count")
    out = (
        negative.join(brands.select(ID, "brand_canonical"), ID)
        .groupBy("brand_canonical")
        .agg(F.count(ID).alias("complaints_count"), F.avg("like_count").alias("avg_likes"))
        .filter(F.col("complaints_count") > more_than)
    )
    return out.orderBy(F.desc("avg_likes"), "brand_canonical")


def barriers_per_product(products: DataFrame, barriers: DataFrame) -> DataFrame:
    joined = products.select(ID, "product_type").join(barriers.select(ID, "barrier_code"), ID)
    out = joined.groupBy("product_type", "barrier_code").agg(F.count("*").alias("occurrence_count"))
    return out.orderBy("product_type", F.desc("occurrence_count"), "barrier_code")


def causes_by_sentiment(tweets: DataFrame, causes: DataFrame, sentiment: str = "negative") -> DataFrame:
    chosen = tweets.filter(F.col("sentiment") == sentiment).select(ID, "sentiment")
    joined = chosen.join(causes.select(ID, "cause_category"), ID)
    return joined.groupBy("cause_category", "sentiment").agg(F.countDistinct(ID).alias("n"))


def likes_per_cause(tweets: DataFrame, causes: DataFrame, intent: str = "complaining") -> DataFrame:
    chosen = tweets.filter(F.col("intent_label") == intent).select(ID, "like_count")
    out = (
        chosen.join(causes.select(ID, "cause_category"), ID)
        .groupBy("cause_category")
        .agg(F.avg("like_count").alias("avg_likes"))
    )
    return out.orderBy(F.desc("avg_likes"), "cause_category")


def entities_by_cause(tweets: DataFrame, brands: DataFrame, causes: DataFrame) -> DataFrame:
    joined = tweets.select(ID).join(brands.select(ID, "brand_canonical"), ID)
    joined = joined.join(causes.select(ID, "cause_category"), ID)
    return joined.groupBy("brand_canonical", "cause_category").agg(F.count("*").alias("n"))


def influence_tier(followers: Column, high: float = 5000, mid: float = 500) -> Column:
    return F.when(followers > high, "high").when(followers > mid, "mid").otherwise("low")


def shares(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and share of all rows per group. The groups are written down; their total is a scalar subquery, so the input
    is read once and no task sees all groups."""
    groups = materialize(df.groupBy(*keys).agg(F.count("*").alias("n")), "groups")
    total = groups.agg(F.sum("n").alias("total"))
    return groups.withColumn("share", F.col("n") / total.scalar())


def rising(df: DataFrame, key: str, period: Column, step: Column, positive: Column | None = None) -> DataFrame:
    """Rows (those that are ``positive``) per group and period with the change against the period just before, ``step``
    earlier, in which a group without rows counts 0; null in the earliest period of all."""
    counted = F.count("*") if positive is None else F.count_if(positive)
    counts = materialize(df.groupBy(F.col(key), period.alias("period")).agg(counted.alias("n")), "counts")
    before = counts.select(key, (F.col("period") + step).alias("period"), F.col("n").alias("_before"))
    first = counts.agg(F.min("period").alias("first")).scalar()
    delta = F.when(F.col("period") > first, F.col("n") - F.coalesce("_before", F.lit(0)))
    return counts.join(before, [key, "period"], "left").withColumn("delta", delta).drop("_before")


def negative_spikes(
    df: DataFrame, key: str, period: Column, negative: Column, trailing: int = 7, sigmas: float = 2.0,
    number: Column | None = None,
) -> DataFrame:
    """Negative share per group and period, flagged where it exceeds the mean of the ``trailing`` periods before it by
    ``sigmas`` standard deviations, and by more than rounding does. ``number`` numbers the periods (the period itself
    where it is a number): a period in which the group is silent has no share, and older ones do not take its place.
    Windows run over one row per group and period."""
    per = df.groupBy(F.col(key), period.alias("period")).agg(
        F.count("*").alias("n"), F.count_if(negative).alias("negatives")
    )
    per = per.withColumn("share", F.col("negatives") / F.col("n"))
    per = per.withColumn("_at", F.col("period") if number is None else number)
    past = Window.partitionBy(key).orderBy("_at").rangeBetween(-trailing, -1)
    per = per.withColumns(
        {"past_mean": F.avg("share").over(past), "past_sd": F.stddev_samp("share").over(past)}
    )
    spike = F.col("share") > F.col("past_mean") + sigmas * F.col("past_sd") + 1e-9
    return per.withColumn("is_spike", F.coalesce(spike, F.lit(False))).drop("_at")


def field_accuracy(predicted: DataFrame, golden: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Per field: compared rows and share of exact agreement."""
    joined = predicted.select(id_col, *fields).join(
        golden.select(id_col, *[F.col(f).alias(f"_gold_{f}") for f in fields]), id_col
    )
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).eqNullSafe(F.col(f"_gold_{f}")).alias("same")) for f in fields]
    )
    out = joined.select(F.inline(pairs)).groupBy("field")
    return out.agg(F.count("*").alias("n"), F.avg(F.col("same").cast("int")).alias("accuracy"))


def class_scores(predicted: DataFrame, golden: DataFrame, id_col: str, field: str) -> DataFrame:
    """Per class of one field: support, precision and recall, from grouped confusion counts."""
    joined = predicted.select(id_col, F.col(field).alias("p")).join(
        golden.select(id_col, F.col(field).alias("g")), id_col
    )
    cells = joined.groupBy("p", "g").agg(F.count("*").alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("p").alias("label"), F.col("n").alias("as_p"), F.lit(0).cast("bigint").alias("as_g"),
                         F.when(F.col("p") == F.col("g"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("g").alias("label"), F.lit(0).cast("bigint").alias("as_p"), F.col("n").alias("as_g"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("label").agg(
        F.sum("as_g").alias("support"), F.sum("as_p").alias("_p"), F.sum("hit").alias("_hit")
    )
    return per.select(
        "label",
        "support",
        F.when(F.col("_p") > 0, F.col("_hit") / F.col("_p")).alias("precision"),
        F.when(F.col("support") > 0, F.col("_hit") / F.col("support")).alias("recall"),
    )


def passes_gate(accuracy: DataFrame, minimum: float = 0.85) -> DataFrame:
    """Add ``passed`` per field."""
    return accuracy.withColumn("passed", F.col("accuracy") >= minimum)


def failure_rate(gated: DataFrame) -> DataFrame:
    """Rows and share of rows with a non-empty ``errors`` array."""
    failed = F.size("errors") > 0
    return gated.agg(
        F.count("*").alias("n"), F.count_if(failed).alias("failed"), F.avg(failed.cast("int")).alias("failure_rate")
    )


def cost_estimate(
    df: DataFrame, chars: Column, chars_per_token: float = 4.0, overhead_tokens: int = 0,
    price_per_million: float = 0.43, *keys: str
) -> DataFrame:
    """Estimated tokens and price of labelling every row, in all or per group."""
    tokens = F.ceil(chars / F.lit(chars_per_token)) + overhead_tokens
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(tokens).alias("tokens"))
    return out.withColumn("price", F.col("tokens") * F.lit(price_per_million / 1e6))
