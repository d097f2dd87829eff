"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text's terms are its phrases: runs of words that end at an anchor, a word whose hash says so (one in ``ANCHORS``), so
that every word is in one phrase and an edit changes only the phrases it touches. A phrase weighs its number of words,
all its occurrences together. For each term k of weight w and each sample, hashes of the term give r and c, two
gamma(2, 1) values, and a uniform b; with t = floor(ln w / r + b), the term with the smallest
``ln c - r (t - b + 1)`` is drawn. The drawn pair (k, t) is equal in two texts with a probability that is their
generalised Jaccard similarity, the sum of the smaller weights over the sum of the larger. As that smallest value is a
function of (k, t), it stands for the pair, and a signature is the list of the smallest values, 16 bits of a hash of each.

The texts are shuffled once, by ranges of doc_id. A range holds the next document of all its rows but the last, which
gets the first row of the next range. All that follows (terms, weights, samples, signatures) is grouped inside ranges
and needs no further exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.ranking import positions
from postloom.session import materialize

SAMPLES = 64
ANCHORS = 4
#: Rows that a range should hold, and the most segments that doc_ids are divided into by quantiles.
RANGE = 2048
SEGMENTS = 1024
#: Null doc_ids come last, in so many ranges by the hash of their text.
NULL_RANGES = 1024

_MARK = "\x1e"


def _ranges(docs: DataFrame) -> DataFrame:
    """``docs`` with ``range``, a number that rises with (doc_id, nulls last; text hash).

    Segments lie between quantiles of doc_id, SEGMENTS of them at most, whatever the gaps between ids; where that
    would leave over RANGE rows in one, each is divided evenly.
    """
    rows = docs.agg(F.count("*").alias("n"), F.max("doc_id").alias("high")).first()
    count = max(1, min(SEGMENTS, -(-rows["n"] // RANGE)))
    parts = max(1, -(-rows["n"] // (SEGMENTS * RANGE)))
    shares = [i / count for i in range(1, count)]
    cuts = docs.agg(F.percentile_approx("doc_id", [0.0, *shares], 10_000)).first()[0] or [0]
    cuts = sorted(set(cuts))
    low = F.array(*[F.lit(c).cast("long") for c in cuts])
    width = F.array(*[F.lit(max(1, b - a)).cast("double") for a, b in zip(cuts, [*cuts[1:], (rows["high"] or 0) + 1])])
    # The first cut is the smallest id; a quantile estimate above it would leave ids before all cuts, in segment 1 too.
    segment = F.greatest(F.lit(1), F.size(F.filter(low, lambda c: c <= F.col("doc_id"))))
    inside = (F.col("doc_id") - F.element_at(low, segment)).cast("double") / F.element_at(width, segment) * parts
    cell = F.least(F.lit(parts - 1), F.greatest(F.lit(0), F.floor(inside))).cast("long")
    last = (len(cuts) + 1) * parts
    number = F.when(F.col("doc_id").isNull(), F.lit(last) + F.shiftright("hash", 53)).otherwise(segment.cast("long") * parts + cell)
    return docs.withColumn("range", number)


def _with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, hash)`` with the place in its range, the next document's text, and whether a row is the
    last of its range. After the last document comes the first."""
    placed = _ranges(docs)
    heads = placed.select("range", F.struct(F.col("doc_id"), F.col("hash")).alias("key")).groupBy("range").agg(F.min("key").alias("key"))
    heads = materialize(heads.select("range", "key.doc_id", "key.hash"), "heads")
    order = materialize(positions(heads.select("range"), [F.col("range")]), "range_order")
    count = order.count()
    following = order.select(F.col("range").alias("after"), F.pmod(F.col("position") - 1, F.lit(max(1, count))).alias("position"))
    after = order.join(following, "position").select("range", "after")
    same = (placed["range"] == heads["range"]) & placed["doc_id"].eqNullSafe(heads["doc_id"]) & (placed["hash"] == heads["hash"])
    texts = placed.join(heads, same).select(placed["range"].alias("after"), placed["text"].alias("head"))
    heads = materialize(after.join(texts.groupBy("after").agg(F.min("head").alias("head")), "after").drop("after"), "next_heads")
    inside = Window.partitionBy("range").orderBy("doc_id", "hash", "text")
    rows = placed.select(
        "*", F.lead("text").over(inside).alias("lead"), F.row_number().over(inside).alias("place")
    )
    rows = rows.join(heads, "range")
    return rows.select(
        "range", "place", "doc_id", "text", F.coalesce("lead", "head").alias("next"), F.col("lead").isNull().alias("is_last")
    )


def _phrases(text: Column) -> Column:
    words = F.split(text, r"[\x20\x09-\x0D]+")
    marked = F.transform(words, lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(ANCHORS)) == 0, F.concat(w, F.lit(_MARK))).otherwise(w))
    return F.split(F.array_join(marked, " "), _MARK + " ?")


def _uniform(bits: Column, width: int) -> Column:
    """A value inside (0, 1) from the lowest ``width`` bits."""
    return (bits.bitwiseAND(F.lit((1 << width) - 1)).cast("double") + 0.5) * F.lit(2.0**-width)


def sample(number: int) -> Column:
    """Sample of one term, from its hash ``term`` and the logarithm ``log_weight`` of its weight."""
    one, two = (F.xxhash64("term", F.lit(2 * number + i)) for i in (0, 1))
    r = -F.log(_uniform(F.shiftrightunsigned(one, 32), 32) * _uniform(one, 32))
    c = -F.log(_uniform(F.shiftrightunsigned(two, 40), 24) * _uniform(F.shiftrightunsigned(two, 16), 24))
    b = _uniform(two, 16)
    t = F.floor(F.col("log_weight") / r + b).cast("double")
    return F.log(c) - r * (t - b + 1.0)


def _likeness(a: Column, b: Column, samples: int) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same.cast("double") / samples


def _printed(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for every row of
    ``docs(doc_id, text)``.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document's, in
    ascending order of doc_id; rows of one doc_id follow the hash of their text, null doc_ids come last, and the last
    row is followed by the first. Likeness is the share of equal samples. Null text counts as empty; texts without a
    word have the empty phrase, of weight 1, as their only term, so they are alike. Equal texts have equal fingerprints.
    A single row is its own next document. No rows give no rows; further columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A hash without its sign, whose order and leading bits agree.
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "hash", F.shiftrightunsigned(F.xxhash64("text"), 1)
    )
    rows = _with_next(source)
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), size - half), F.substring("next", F.lit(1), half)))
    digest = F.sha2("edited", 256)
    no_text, no_value = F.lit(None).cast("string"), F.lit(None).cast("long")
    one = lambda kind, body, value: F.struct(F.lit(kind).alias("kind"), body.alias("body"), value.alias("value"))
    # Texts to sample (2: the next one, for the last row of a range), and numbers that only pass through: they travel as
    # rows so that the many rows of terms need not carry them.
    parts = [one(0, F.col("text"), no_value), one(1, F.col("edited"), no_value)]
    parts += [one(3, no_text, F.col("doc_id")), one(4, no_text, size.cast("long"))]
    # A digest is four numbers of 64 bits.
    parts += [one(5 + i, no_text, F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("long")) for i in range(4)]
    parts = F.array(*parts, F.when(F.col("is_last"), one(2, F.col("next"), no_value)))
    rows = rows.select("range", "place", F.explode(parts).alias("p")).filter("p is not null")
    rows = rows.select("range", "place", "p.kind", "p.value", F.explode_outer(_phrases(F.col("p.body"))).alias("phrase"))
    weight = F.length("phrase") - F.length(F.replace(F.col("phrase"), F.lit(" "), F.lit(""))) + 1
    terms = rows.select("range", "place", "kind", F.xxhash64("phrase").alias("term"), F.coalesce("value", weight.cast("long")).alias("w"))
    terms = terms.groupBy("range", "place", "kind", "term").agg(F.sum("w").alias("w"))
    terms = terms.withColumn("log_weight", F.when(F.col("kind") < 3, F.log(F.col("w").cast("double"))))
    drawn = terms.groupBy("range", "place", "kind").agg(
        *[F.min(sample(i)).alias(f"s{i}") for i in range(samples)], F.max("w").alias("w")
    )
    # The samples as they are printed; likeness is of these.
    signature = F.array(*[F.xxhash64(f"s{i}").bitwiseAND(F.lit(0xFFFF)).cast("int") for i in range(samples)])
    drawn = drawn.select("range", "place", "kind", "w", F.when(F.col("kind") < 3, signature).alias("signature"))
    of = lambda kind, c: F.first(F.when(F.col("kind") == kind, F.col(c)), ignorenulls=True)
    whole = drawn.groupBy("range", "place").agg(
        *[of(k, "signature").alias(n) for k, n in ((0, "own"), (1, "other"), (2, "after"))],
        of(3, "w").alias("doc_id"),
        of(4, "w").alias("n_chars"),
        *[of(5 + i, "w").alias(f"d{i}") for i in range(4)],
    )
    following = F.coalesce("after", F.lead("own").over(Window.partitionBy("range").orderBy("place")))
    whole = whole.withColumn("following", following)
    hexed = reduce(F.concat, [F.lpad(F.lower(F.hex(f"d{i}")), 16, "0") for i in range(4)])
    return whole.select(
        "doc_id",
        "n_chars",
        hexed.alias("edited_sha256"),
        _printed(F.col("own")).alias("fingerprint"),
        _printed(F.col("other")).alias("edited_fingerprint"),
        _likeness(F.col("own"), F.col("other"), samples).alias("near_edited"),
        _likeness(F.col("own"), F.col("following"), samples).alias("near_next"),
    )
