"""Mixing sources to target weights with a low-discrepancy schedule.

Golden-ratio points, mapped through the cumulative targets, name a source for every slot of the mixture, so that any
stretch of slots holds the sources in proportion. The slots of a source are ranked; the source's documents, shuffled
and laid end to end, are cut into blocks of as many words as a slot takes; slot number r of a source takes its block
number r. Past its last word a source starts over, up to ``REPEATS`` times in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import WORD, packed, unpacked, word_count
from postloom.llm.ranking import positions
from postloom.session import materialize

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 64
SEED = "mix-1"

# 2**31 points, and the odd number nearest to 2**31 over the golden ratio.
POINTS = 1 << 31
STEP = 1327217885


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(number, source, source_size, target)`` from ``sizes(source, size)``.

    Sources in code point order, null last, take the weights in turn. Targets share the total by weight; one that
    exceeds ``repeats`` times its source stops there and the rest is shared again, until none does. Each round is one
    sum over the sources; a source that is capped stays so, and sources of one weight are capped in order of size.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = positions(sums, [F.col("source").asc_nulls_last()])
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    placed = materialize(placed.withColumn("weight", choice.cast("long")), "weights")
    total = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most = F.col("source_size") * repeats
    free_weight, rest = None, total
    capped = F.lit(False)
    while True:
        row = placed.agg(
            F.sum(F.when(~capped, F.col("weight"))).alias("w"), F.sum(F.when(capped, most).otherwise(0)).alias("c")
        ).first()
        weight, left = row["w"] or 0, total - (row["c"] or 0)
        if (weight, left) == (free_weight, rest) or not weight:
            break
        free_weight, rest = weight, left
        capped = capped | (most.cast("decimal(38,0)") * weight < F.col("weight").cast("decimal(38,0)") * left)
    if not free_weight:
        target = most.cast("double")
    else:
        share = (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(free_weight))
        target = F.when(capped, most.cast("double")).otherwise(share)
    return materialize(placed.select(F.col("position").alias("number"), "source", "source_size", target.alias("target")), "targets")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(slot, number, rank)``: the source of every slot, and how many earlier slots that source has.

    Each source owns the points between its cumulative targets. Points meet sources in an equi-join on the point's
    4096th of the range, of which a source covers one or more.
    """
    whole = targets.select("number", F.floor("target").cast("long").alias("words"))
    ends = positions(whole, [F.col("number")], "words")
    total = whole.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    bound = lambda c: F.floor(c.cast("double") / F.lit(float(max(1, total))) * POINTS).cast("long")
    owned = ends.select("number", bound(F.col("before")).alias("low"), bound(F.col("before") + F.col("words")).alias("high"))
    cell = POINTS // 4096
    covered = F.sequence(F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}"))
    owned = owned.filter("low < high").select("number", "low", "high", F.explode(covered).alias("cell"))
    slots = F.expr(f"(id % {POINTS} + 1) * {STEP} % {POINTS}")
    points = targets.sparkSession.range(-(-total // block)).select(F.col("id").alias("slot"), slots.alias("point"))
    placed = points.withColumn("cell", F.expr(f"point div {cell}")).join(owned, "cell").filter("low <= point and point < high")
    ranked = positions(placed.select("slot", "number"), [F.col("number"), F.col("slot")])
    first = materialize(ranked.groupBy("number").agg(F.min("position").alias("first")), "first_slots")
    return ranked.join(first, "number").select("slot", "number", (F.col("position") - F.col("first")).alias("rank"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, text_key)`` for every row of ``docs(doc_id, text, source)``.

    ``size`` is the number of words, ``taken`` how many the mixture takes, repeats counted: whole passes over the
    document and, for one document per source, the first words of one more. The order of a source is a shuffle by a
    hash of doc_id and text, so a rerun takes the same. Null and empty texts have size 0 and nothing is taken of them.
    A null source is a source of its own, null doc_ids and repeated rows are rows like any other (``text_key``, a hash
    of the text, tells rows of one doc_id apart; of equal rows the totals agree, one may be cut short). A table without
    words gives targets of 0. Further columns are not read.
    """
    digest = F.md5(F.concat_ws("/", F.lit(SEED), F.col("doc_id").cast("string")))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key"),
    )
    sized = materialize(sized.withColumn("shuffle", digest), "sized")
    targets = source_targets(sized)
    slots = materialize(schedule(targets, block), "schedule")
    # A row per source; the planner broadcasts it only if its written size is small.
    named = targets.join(
        slots.groupBy("number").agg(F.count("*").alias("slots")), "number", "left"
    ).select("number", F.col("source").alias("_source"), "source_size", "target", F.coalesce("slots", F.lit(0)).alias("slots"))
    named = materialize(named, "sources")
    rows = sized.join(named, sized["source"].eqNullSafe(named["_source"])).drop("source", "_source")
    placed = positions(rows, [F.col(c) for c in ("number", "shuffle", "doc_id", "text_key")], "size")
    start = materialize(placed.groupBy("number").agg(F.min("before").alias("start")), "starts")
    placed = materialize(placed.join(start, "number").withColumn("at", F.col("before") - F.col("start")), "laid_out")
    # Every pass over a source lays its documents end to end again; each piece of one inside a block is a row.
    passes = placed.filter("size > 0").select(
        "position", "number", "size", "slots", F.explode(F.expr(f"transform(sequence(0, {REPEATS - 1}), e -> at + e * source_size)")).alias("at")
    )
    last = F.least(F.expr(f"(at + size - 1) div {block}"), F.col("slots") - 1)
    passes = passes.withColumn("first", F.expr(f"at div {block}")).withColumn("last", last).filter("first <= last")
    pieces = passes.select("position", "number", "at", "size", F.explode(F.sequence("first", "last")).alias("rank"))
    words = F.least(F.col("at") + F.col("size"), (F.col("rank") + 1) * block) - F.greatest(F.col("at"), F.col("rank") * block)
    used = pieces.join(slots.select("number", "rank"), ["number", "rank"]).groupBy("position").agg(F.sum(words).alias("taken"))
    return placed.join(used, "position", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "text_key"
    )


def apply_mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mixture as rows of ``docs(doc_id, text, source, ...)``: each row as often as it is taken whole, and cut to its
    first words where the mixture ends inside it; texts of which nothing is taken are left out. Rows equal in doc_id and
    text share what is taken of them. Columns other than ``text`` stay as they are."""
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("_id")
    taken = mix(docs, block).groupBy(key, F.col("text_key").alias("_key")).agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"))
    taken = materialize(taken.filter("_taken > 0"), "taken")
    same = Window.partitionBy("_id", "_key").orderBy("_id")
    rows = docs.select(packed(docs), F.col("text").alias("_body"), key, F.xxhash64("text").alias("_key")).join(taken, ["_id", "_key"])
    rows = rows.withColumn("_nth", F.row_number().over(same)).filter("_nth = 1")
    rest = (F.col("_taken") % F.col("_size")).cast("int")
    part = F.array_join(F.slice(F.regexp_extract_all("_body", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), rest), " ")
    whole = F.array_repeat(F.col("_body"), F.expr("int(_taken div _size)"))
    texts = F.when(rest > 0, F.concat(whole, F.array(part))).otherwise(whole)
    rows = rows.withColumn("_text", F.explode(texts))
    return rows.select(*unpacked(docs, text=F.col("_text")))
