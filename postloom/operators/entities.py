"""Resolving entity names: exact lookup, fuzzy lookup, noise rules.

Everything runs over distinct names and is joined back, so a name mentioned a billion times is resolved once and its
mentions are collapsed inside each task before any shuffle.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import token
from postloom.session import materialize

CUTOFF = 0.8

# A name that contains one of these is advertising, not an entity.
NOISE_PHRASES = (
    "best find", "link bio", "shopee find", "racun shopee", "spill link", "keranjang kuning", "toko oren", "toko ijo",
    "link shopee", "toko orange",
)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(keys: pd.Series, names: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; the lookup key comes first, because the measure is not symmetric."""
    matcher = difflib.SequenceMatcher()
    out, last = [], None
    for key, name in zip(keys, names):
        if name != last:  # the matcher indexes its second sequence, so keep it while it repeats
            matcher.set_seq2(name)
            last = name
        matcher.set_seq1(key)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


# Keeps the optimizer from copying the call into the filter on its result, which would run Python twice per pair.
sequence_ratio = sequence_ratio.asNondeterministic()


def bigrams(c: Column) -> Column:
    """Pairs of neighbouring characters, with marks for both ends, each followed by how often it has occurred so far."""
    padded = F.concat(F.lit("\u0002"), c, F.lit("\u0003"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(c) + 1), lambda i: F.substring(padded, i, F.lit(2)))
    return F.transform(
        pairs, lambda p, i: F.concat(p, F.size(F.filter(F.slice(pairs, 1, i + 1), lambda q: q == p)).cast("string"))
    )


def _rarest(items: DataFrame, counts: DataFrame, cutoff: float) -> DataFrame:
    """``(text, _items)``: of each ``(text, _item)`` group the rarest items that a match cannot do without, in an order
    that is the same for all."""
    ranked = items.join(counts, "_item").groupBy("text").agg(
        F.array_sort(F.collect_list(F.struct("_n", "_item"))).alias("_all")
    )
    # The shortest partner that the length test allows has n * cutoff / (2 - cutoff) characters.
    n = F.length("text")
    total = n + F.ceil(n * cutoff / (2 - cutoff) - 1e-9)
    shared = F.greatest(F.lit(1), F.ceil((1 - cutoff) * total - 1e-9).cast("int") - 1)
    kept = F.slice("_all", F.lit(1), F.greatest(F.lit(1), F.size("_all") - shared + 1))
    return ranked.select("text", F.transform(kept, lambda x: x["_item"]).alias("_items"))


def fuzzy_candidates(names: DataFrame, lookup: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Pairs ``(name, alias, canonical)`` that include every pair of similarity >= ``cutoff``, by an equi-join.

    Let T be the summed length and M the matched characters, 2M/T >= 0.8. The matched blocks are separated by unmatched
    characters, so there are at most T-2M+1 of them, and they keep at least 3M-T-1 neighbouring pairs. That is positive
    for every T except 2 and 5, where the end marks give the shared pair. So true matches share at least
    o = max(1, ceil((1-cutoff)*T) - 1) numbered bigrams. Two sets that share o items share one among the |B| - o + 1 that
    come first in any common order; with the rarest first, a frequent bigram pairs few names with few aliases. A pair is
    emitted at its first shared item only. Length and edit distance (at most T-2M, so ``lev <= (1-cutoff)*T``) are
    further lossless tests; they run inside the join, before Python sees anything. Counts items in a job.
    """
    if not CUTOFF <= cutoff <= 1.0:
        raise ValueError(f"cutoff must lie in [{CUTOFF}, 1]: below, matches need not share a bigram")
    split = lambda df, c: df.select(F.col(c).alias("text"), F.explode(bigrams(F.col(c))).alias("_item"))
    written = materialize(split(names, "name").withColumn("_alias", F.lit(False)).unionByName(
        split(lookup, "alias").withColumn("_alias", F.lit(True))), "bigrams")
    counts = materialize(written.groupBy("_item").agg(F.count("*").alias("_n")), "bigram_counts")
    mine = _rarest(written.filter("not _alias").drop("_alias"), counts, cutoff)
    theirs = _rarest(written.filter("_alias").drop("_alias"), counts, cutoff).join(
        lookup.select(F.col("alias").alias("text"), "canonical"), "text")
    left = mine.select(F.col("text").alias("name"), F.col("_items").alias("_nb"), F.explode("_items").alias("_b"))
    right = theirs.select(F.col("text").alias("alias"), "canonical", F.col("_items").alias("_ab"), F.explode("_items").alias("_b"))
    ln, la = F.length("name"), F.length("alias")
    slack = 1e-9
    near = left.join(right, "_b").filter(
        (2 * F.least(ln, la) >= F.lit(cutoff) * (ln + la) - slack)
        & (F.element_at(F.array_intersect("_nb", "_ab"), 1) == F.col("_b"))
        & (F.levenshtein("name", "alias") <= F.lit(1 - cutoff) * (ln + la) + slack)
    )
    return near.select("name", "alias", "canonical")


def fuzzy_match(names: DataFrame, lookup: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Best alias per name, ``(name, alias, canonical, score)``; ties go to the greatest alias."""
    scored = fuzzy_candidates(names, lookup, cutoff).withColumn("score", sequence_ratio("alias", "name"))
    best = scored.filter(F.col("score") >= cutoff).groupBy("name").agg(
        F.max_by(F.struct("alias", "canonical", "score"), F.struct("score", "alias")).alias("_m")
    )
    return best.select("name", "_m.alias", "_m.canonical", "_m.score")


def known_names(lookup: DataFrame) -> DataFrame:
    """Aliases and lower-cased canonical names."""
    return lookup.select(F.col("alias").alias("name")).union(lookup.select(F.lower("canonical"))).distinct()


def noise_reason(name: Column, known: Column, listed: Column, phrases: tuple[str, ...] = NOISE_PHRASES) -> Column:
    """Why a cleaned name is noise, null if it is not. A known entity never is."""
    in_phrase = F.lit(False)
    for phrase in phrases:
        in_phrase = in_phrase | name.contains(phrase)
    return (
        F.when(known, F.lit(None).cast("string"))
        .when(F.length(name) < 3, "short")
        .when(~name.rlike(r"\p{L}"), "no_letter")
        .when(listed, "listed")
        .when(in_phrase, "phrase")
    )


def resolve_names(
    names: DataFrame,
    lookup: DataFrame,
    noise_terms: DataFrame | None = None,
    phrases: tuple[str, ...] = NOISE_PHRASES,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``(brand_raw, brand_canonical, matched_by, noise)`` for the distinct values of column ``brand_raw``.

    ``lookup`` is ``(alias, canonical)`` with unique aliases, ``noise_terms`` has one column ``term``. ``matched_by`` is
    exact, fuzzy or raw (null for noise).
    """
    raw = names.select("brand_raw").filter(F.col("brand_raw").isNotNull()).distinct()
    raw = raw.withColumn("name", token(F.col("brand_raw")))
    out = raw.join(lookup.select(F.col("alias").alias("name"), F.col("canonical").alias("_exact")), "name", "left")
    out = out.join(known_names(lookup).withColumn("_known", F.lit(True)), "name", "left")
    if noise_terms is None:
        out = out.withColumn("_listed", F.lit(False))
    else:
        terms = noise_terms.select(F.col("term").alias("name")).distinct().withColumn("_listed", F.lit(True))
        out = out.join(terms, "name", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    out = out.withColumn("noise", noise_reason(F.col("name"), flag("_known"), flag("_listed"), phrases))
    open_names = out.filter(F.col("noise").isNull() & F.col("_exact").isNull()).select("name").distinct()
    fuzzy = fuzzy_match(open_names, lookup, cutoff).select("name", F.col("canonical").alias("_fuzzy"))
    out = out.join(fuzzy, "name", "left")
    return out.select(
        "brand_raw",
        F.when(F.col("noise").isNull(), F.coalesce("_exact", "_fuzzy", "brand_raw")).alias("brand_canonical"),
        F.when(F.col("noise").isNotNull(), F.lit(None).cast("string"))
        .when(F.col("_exact").isNotNull(), "exact")
        .when(F.col("_fuzzy").isNotNull(), "fuzzy")
        .otherwise("raw")
        .alias("matched_by"),
        "noise",
    )


def resolve_mentions(posts: DataFrame, resolved: DataFrame, id_col: str = "tweet_id") -> DataFrame:
    """Drop noise from ``brands_raw`` and add the map ``brands_canonical`` (name as written -> canonical name).

    Mentions of one post are regrouped by its id, so a group is never longer than the post's own list.
    """
    mentions = posts.select(id_col, F.posexplode("brands_raw").alias("_pos", "_m"))
    mentions = mentions.withColumn("brand_raw", F.col("_m.brand_raw"))
    kept = mentions.join(
        resolved.filter(F.col("noise").isNull()).select("brand_raw", "brand_canonical"), "brand_raw"
    )
    per_post = kept.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_m", "brand_canonical"))).alias("_ms")
    )
    pairs = F.transform("_ms", lambda x: F.struct(x["_m"]["brand_raw"].alias("k"), x["brand_canonical"].alias("v")))
    per_post = per_post.select(
        id_col,
        F.transform("_ms", lambda x: x["_m"]).alias("_brands"),
        F.map_from_entries(F.array_distinct(pairs)).alias("_map"),
    )
    out = posts.join(per_post, id_col, "left")
    brands_type = posts.schema["brands_raw"].dataType
    return out.withColumns(
        {
            "brands_raw": F.coalesce("_brands", F.array().cast(brands_type)),
            "brands_canonical": F.coalesce("_map", F.create_map().cast("map<string,string>")),
        }
    ).drop("_brands", "_map")


def unknown_names(resolved: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` names, in order, that are neither noise nor an alias (a fuzzy hit counts as unknown)."""
    open_names = resolved.filter(F.col("matched_by").isin("fuzzy", "raw"))
    return open_names.select("brand_raw").distinct().orderBy("brand_raw").limit(k)
