"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked where few bits differ.

Two fingerprints that differ in at most four bits agree in at least four of their eight byte positions. The inverted
index therefore holds, for each distinct fingerprint, its 70 choices of four positional bytes; any two fingerprints
that share a list share at least those four bytes. Inside a list the shared positional bytes of each pair are tallied, those
that reach the minimum are verified by their differing bits, and a pair counts only in the list of its first four shared
positions. Plain one-byte lists would hold 1/256 of the corpus each and their pairs would grow with its
square; a list on four bytes holds 2**-32 of unrelated fingerprints.

No pair list leaves a task: each list contributes a spanning forest of its links. A list longer than ``list_limit``
is not compared pair by pair. Its fingerprints are joined through the values at most two bits away instead, which any
two fingerprints within four bits share: linear in the list, and exact as well.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map, packed, unpacked, utf8
from postloom.llm.graph import components
from postloom.session import materialize

SHINGLE = 4
MAX_BITS = 4
LIST_LIMIT = 4096
SEED = 42
BLOCK = 1 << 16

# The 70 choices of four byte positions, in order, as position tuples.
CHOICES = list(combinations(range(8), 8 - MAX_BITS))


# Seven low bits of every byte.
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: A-Z lower-cased, shingles with repeats; no word gives zero."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        n = min(BLOCK, total - at)
        parts = [words[at + i : at + i + n] for i in range(shingle)]
        grams = map(b" ".join, zip(*parts)) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, shingle):
    for batch in batches:
        values = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
        passed = {c: batch.column(c) for c in ("doc_id", "mark")}
        yield passed | {"fp": np.array(values, np.uint64).view(np.int64)}


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, mark, fp)``: fp is the fingerprint as a signed long, mark a hash of the text that tells rows of one
    doc_id apart. One pass over the texts, no shuffle. Null text gives 0."""
    text = F.col("text")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), utf8(text).alias("text"))
    return arrow_map(source, partial(_fingerprints, shingle=shingle), "doc_id long, mark long, fp long")


def _forest(values: np.ndarray, choice: int, shared: int):
    """Spanning forest (pairs of indices) of the links that this list is the first to hold."""
    root = np.arange(len(values))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first = np.zeros(8, bool)
    first[list(CHOICES[choice])] = True
    step = max(1, (1 << 20) // len(values))
    for lo in range(0, len(values), step):
        diff = values[lo : lo + step, None] ^ values[None, :]
        # Count filtering: a byte that is shared is zero in the difference; only pairs with enough of them go on.
        tally = np.bitwise_count(~(((diff & _LOW) + _LOW) | diff | _LOW))
        rows, cols = np.nonzero(tally >= shared)
        keep = cols > rows + lo
        rows, cols = rows[keep], cols[keep]
        keep = np.bitwise_count(diff[rows, cols]) <= MAX_BITS
        rows, cols = rows[keep], cols[keep]
        if not len(rows):
            continue
        same = diff[rows, cols].view(np.uint8).reshape(-1, 8) == 0
        lead = (same & (same.cumsum(axis=1) <= shared)) == first
        keep = lead.all(axis=1)
        for i, j in zip((rows[keep] + lo).tolist(), cols[keep].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield i, j


def _lists(batches, limit):
    """Rows arrive sorted by list. Yields links (a, b), and (a, null) for fingerprints in lists over the limit."""
    key, held, over = None, [], False

    def close():
        if over or len(held) < 2:
            return [], []
        values = np.array(held, np.int64).view(np.uint64)
        pairs = list(_forest(values, key[0], 8 - MAX_BITS))
        return [held[i] for i, _ in pairs], [held[j] for _, j in pairs]

    for batch in batches:
        choice, bits, fps = (batch.column(c).to_numpy() for c in ("choice", "bits", "fp"))
        n = len(fps)
        cut = np.flatnonzero((choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [n]))
        out_a, out_b = [], []
        # Lists of one row inside the batch need no visit.
        visit = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == n))
        for s, e in zip(starts[visit].tolist(), ends[visit].tolist()):
            here = (int(choice[s]), int(bits[s]))
            if here != key:
                a, b = close()
                out_a += a
                out_b += b
                key, held, over = here, [], False
            rows = fps[s:e].tolist()
            if over:
                out_a += rows
                out_b += [None] * len(rows)
            elif len(held) + len(rows) > limit:
                over = True
                out_a += held + rows
                out_b += [None] * (len(held) + len(rows))
                held = []
            else:
                held += rows
        if out_a:
            yield {"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())}
    a, b = close()
    if a:
        yield {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}


def _nearby_links(hot: DataFrame) -> DataFrame:
    """Links among ``hot(fp)``: each is tied to the smallest one that shares a value at most two bits away."""
    half = MAX_BITS // 2
    masks = [sum(1 << i for i in c) for k in range(half + 1) for c in combinations(range(64), k)]
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    spread = hot.select("fp", F.explode(table).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("via")
    )
    low = spread.groupBy("via").agg(F.min("fp").alias("m"), F.max("fp").alias("x")).filter("m < x").drop("x")
    low = materialize(low, "nearby")
    return spread.join(low, "via").filter("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b")).distinct()


def near_links(fps: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fps(fp)`` that connect exactly what four or fewer differing
    bits connect (a spanning set, not every pair). Runs the index as a job.

    A list receives each distinct fingerprint once, a seventieth of its index rows, and is read as a sorted stream.
    """
    keys = []
    for number, positions in enumerate(CHOICES):
        mask = _signed(sum(0xFF << (8 * p) for p in positions))
        keys.append(F.struct(F.lit(number).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    index = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.choice", "k.bits", "fp")
    lists = index.repartition("choice", "bits").sortWithinPartitions("choice", "bits")
    found = materialize(arrow_map(lists, partial(_lists, limit=list_limit), "a long, b long"), "links")
    links = found.filter("b is not null")
    hot = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    if not hot.isEmpty():
        links = links.unionByName(_nearby_links(hot))
    return links


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))


def _groups(fps: DataFrame, list_limit: int) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    roots = materialize(components(near_links(distinct.select("fp"), list_limit)), "roots")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialize(rooted.select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = materialize(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    return materialize(rooted.join(lowest, "root").select("fp", "root", "component_id"), "groups")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, list_limit: int = LIST_LIMIT) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text)``: component_id is the smallest doc_id in
    the group of documents whose fingerprints are linked, directly or through others.

    Texts with equal fingerprints collapse to one node before anything is compared. Null and empty texts have
    fingerprint zero and form one group, with whatever lies within four bits of zero. Repeated rows stay repeated. A
    null doc_id never becomes a component_id unless its whole group has none. No rows give no rows; further columns of
    ``docs`` are not read.
    """
    fps = materialize(simhash(docs, shingle), "simhash")
    groups = _groups(fps, list_limit)
    return fps.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row of each near-duplicate group of ``docs(doc_id, text, ...)``, all its columns as they are: the row whose
    doc_id is the component_id of the group; of several such rows the one with the smallest text hash, and of equal rows
    one. In a group without doc_ids the text hash decides alone."""
    fps = materialize(simhash(docs, shingle), "simhash")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("mark"))
    best = fps.join(_groups(fps, list_limit), "fp").groupBy("root").agg(F.min(rank).alias("k"))
    best = materialize(best.select(_id_key(F.col("k.doc_id")).alias("_id"), F.col("k.mark").alias("_mark")), "kept")
    keyed = docs.select(packed(docs), _id_key(F.col("doc_id")).alias("_id"), F.xxhash64("text").alias("_mark"))
    same = Window.partitionBy("_id", "_mark").orderBy("_id")
    found = keyed.join(best, ["_id", "_mark"], "left_semi").withColumn("_nth", F.row_number().over(same))
    return found.filter("_nth = 1").select(*unpacked(docs))
