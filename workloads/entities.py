"""Entity names: exact, noise, unknown, fuzzy, mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.operators import entities
from postloom.session import materialize, scratch_path
from postloom.sources.lookup import noise_table, read_lookup, read_noise
from workloads.base import query, table

# Aliases are the lower-case part names, canonical names their capitals.
LOOKUP_SQL = "(SELECT DISTINCT lower(p_name) AS alias, upper(p_name) AS canonical FROM part)"
MENTION = (
    "CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN ' ' || upper(p_name) || chr(9) WHEN 2 THEN p_brand "
    "WHEN 3 THEN CAST(p_partkey AS STRING) WHEN 4 THEN p_type ELSE substr(p_type, 1, 2) END"
)
NOISE = ("standard", "promo", "small")


def lookup(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.select(F.lower("p_name").alias("alias"), F.upper("p_name").alias("canonical")).distinct()


def mentions(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{MENTION} AS brand_raw")


_RESOLVED = f"""
    WITH m AS (SELECT DISTINCT {MENTION} AS brand_raw FROM part),
    c AS (SELECT brand_raw, lower(regexp_replace(brand_raw, '^[\\s]+|[\\s]+$', '', 'g')) AS name FROM m),
    r AS (SELECT brand_raw, name, l.canonical FROM c LEFT JOIN {LOOKUP_SQL} l ON l.alias = c.name),
    s AS (SELECT *, CASE WHEN canonical IS NOT NULL THEN NULL WHEN length(name) < 3 THEN 'short'
                         WHEN NOT regexp_matches(name, '\\p{{L}}') THEN 'no_letter'
                         WHEN name IN ('standard', 'promo', 'small') THEN 'listed' END AS noise FROM r)
"""


@query(
    "entity_exact",
    _RESOLVED + """
    SELECT brand_raw, CASE WHEN noise IS NULL THEN coalesce(canonical, brand_raw) END AS brand_canonical,
           CASE WHEN noise IS NOT NULL THEN NULL WHEN canonical IS NOT NULL THEN 'exact' ELSE 'raw' END AS matched_by, noise
    FROM s
    """,
)
def entity_exact(spark, sf_dir):
    """No mention here is within fuzzy reach of an alias, so SQL can state the full result."""
    return entities.resolve_names(mentions(spark, sf_dir), lookup(spark, sf_dir), noise_table(spark, NOISE))


@query(
    "entity_noise",
    _RESOLVED + f"SELECT noise, count(*) AS n FROM part p JOIN s ON s.brand_raw = {MENTION} WHERE noise IS NOT NULL "
    "GROUP BY noise",
)
def entity_noise(spark, sf_dir):
    """Noise mentions by reason, counted per mention."""
    found = mentions(spark, sf_dir)
    resolved = entities.resolve_names(found, lookup(spark, sf_dir), noise_table(spark, NOISE))
    per_name = found.groupBy("brand_raw").count().join(resolved.filter("noise IS NOT NULL"), "brand_raw")
    return per_name.groupBy("noise").agg(F.sum("count").alias("n"))


@query(
    "entity_unknown",
    _RESOLVED + "SELECT brand_raw FROM s WHERE noise IS NULL AND canonical IS NULL ORDER BY brand_raw LIMIT 10",
)
def entity_unknown(spark, sf_dir):
    """The first ten unknown names; ten is the report's size."""
    resolved = entities.resolve_names(mentions(spark, sf_dir), lookup(spark, sf_dir), noise_table(spark, NOISE))
    return entities.unknown_names(resolved)


@query("entity_known", f"SELECT alias AS name FROM {LOOKUP_SQL} UNION SELECT lower(canonical) FROM {LOOKUP_SQL}")
def entity_known(spark, sf_dir):
    return entities.known_names(lookup(spark, sf_dir))


TYPO = "substr(p_name, 1, CAST(p_partkey % length(p_name) AS INT)) || substr(p_name, CAST(p_partkey % length(p_name) AS INT) + 2)"


@query(
    "entity_fuzzy",
    f"""
    WITH t AS (SELECT {TYPO} AS name, max(lower(p_name)) AS source FROM part GROUP BY 1)
    SELECT name, coalesce(l.alias, source) AS alias, upper(coalesce(l.alias, source)) AS canonical,
           CASE WHEN l.alias IS NOT NULL THEN 1.0::DOUBLE ELSE round(2 * length(name) / (2 * length(name) + 1), 9) END AS score
    FROM t LEFT JOIN {LOOKUP_SQL} l ON l.alias = t.name
    """,
)
def entity_fuzzy(spark, sf_dir):
    """Part names with one letter missing, against the names.

    The similarity has no SQL form in general. Here the nearest name is the typo itself if it is a name, else the one it
    came from, all but one letter of which match, so SQL can state the answer; tests compare with brute force.
    """
    names = table(spark, sf_dir, "part").selectExpr(f"{TYPO} AS name").distinct()
    return entities.fuzzy_match(names, lookup(spark, sf_dir)).withColumn("score", F.round("score", 9))


@query(
    "entity_mentions",
    """
    WITH m AS (SELECT l_orderkey, lower(p_name) AS name FROM lineitem JOIN part ON p_partkey = l_partkey)
    SELECT CAST(l_orderkey AS VARCHAR) AS tweet_id, count(*) AS n_mentions, count(DISTINCT name) AS n_names FROM m
    GROUP BY l_orderkey
    """,
)
def entity_mentions(spark, sf_dir):
    """Orders as posts that mention their parts: mentions resolved by name and regrouped with the canonical map."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    named = lines.join(parts, lines.l_partkey == parts.p_partkey)
    item = F.struct(F.col("p_name").alias("brand_raw"), F.lit(None).cast("string").alias("product_type"))
    # An order has at most a handful of lines: the group is the record itself.
    posts = named.groupBy(F.col("l_orderkey").cast("string").alias("tweet_id")).agg(F.collect_list(item).alias("brands_raw"))
    posts = materialize(posts, "posts")
    names = parts.select(F.col("p_name").alias("brand_raw"))
    resolved = materialize(entities.resolve_names(names, lookup(spark, sf_dir)), "names")
    out = entities.resolve_mentions(posts, resolved)
    return out.select(
        "tweet_id", F.size("brands_raw").cast("bigint").alias("n_mentions"),
        F.size("brands_canonical").cast("bigint").alias("n_names"),
    )


@query(
    "lookup_file",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN n_name || ' Inc' END AS brand_canonical,
           CASE WHEN c_custkey % 3 = 2 THEN 'listed' END AS noise
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def lookup_file(spark, sf_dir):
    """Customers name their nation in lower or upper case, or their region; the lookup is a JSON file of nations, the noise
    list a text file of regions, both of a fixed size."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    root = scratch_path(spark, "lookup")
    pairs = F.collect_list(F.struct(F.lower("n_name"), F.concat("n_name", F.lit(" Inc"))))
    nation.agg(F.to_json(F.map_from_entries(pairs)).alias("value")).write.text(f"{root}/entities")
    region.select(F.concat(F.lit(" "), F.lower("r_name")).alias("value")).write.text(f"{root}/noise")
    said = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    said = said.selectExpr(
        "c_custkey", "CASE c_custkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN n_name ELSE lower(r_name) END AS brand_raw")
    found = entities.resolve_names(said, read_lookup(spark, f"{root}/entities"), read_noise(spark, f"{root}/noise"))
    return said.join(found, "brand_raw").select("c_custkey", "brand_canonical", "noise")
