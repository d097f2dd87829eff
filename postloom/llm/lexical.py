"""Ranked lexical search, reversed: the documents stream past an index of the items' terms.

Items come in blocks whose terms make a bounded inverted index. For each block, tasks reduce every document to the
counts of the terms that the block asks for, a compact table; document frequencies and lengths are sums over it. The
index, now with the weight of each term, is broadcast, and each document's counts run through its postings. A task keeps
a heap of the k best documents per item; the heaps of the tasks are merged in two levels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map, utf8
from postloom.session import materialize, scratch_path

K = 10
#: Items, and pairs of item and term, of one block: what is held on the driver and sent to tasks at a time.
BLOCK_ITEMS = 4096
BLOCK_PAIRS = 1 << 20
#: Scores, and additions to them, that a task holds at a time.
CELLS = 1 << 20
FAN_IN = 32

HITS = "item_id long, score long, doc_id long, part int"

# A term is a run of ASCII letters, digits and characters beyond ASCII; in UTF-8 the latter are bytes from 0x80 on.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text in order, A-Z lower-cased; null text has none."""
    return (text or b"").translate(_FOLD).split()


def _item_terms(batches):
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        yield {"item_id": batch.column("item_id"), "terms": pa.array(found, pa.list_(pa.binary()))}


def _blocks(items: DataFrame, most_items: int, most_pairs: int) -> Iterator[tuple[np.ndarray, list[list[bytes]]]]:
    """Ids and terms of the items that have a term, in blocks; one is held at a time. An item is never divided."""
    source = items.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), utf8(F.col("text")).alias("text"))
    each = arrow_map(source, _item_terms, "item_id long, terms array<binary>").select("item_id", F.explode("terms").alias("term"))
    whole = materialize(each.groupBy("item_id").agg(F.collect_set("term").alias("terms")), "items")
    ids, held, pairs = [], [], 0
    for row in whole.toLocalIterator():
        if ids and (len(ids) >= most_items or pairs + len(row.terms) > most_pairs):
            yield np.array(ids, np.int64), held
            ids, held, pairs = [], [], 0
        ids.append(row.item_id)
        held.append([bytes(t) for t in row.terms])
        pairs += len(row.terms)
    if ids:
        yield np.array(ids, np.int64), held


def _counted(batches, vocabulary):
    """A row per document: its number of terms, and the asked terms it holds with their counts."""
    number = {t: i for i, t in enumerate(vocabulary.value)}
    for batch in batches:
        sizes, ids, counts, ends = [], [], [], [0]
        for text in batch.column("text").to_pylist():
            words = terms(text)
            found = Counter(map(number.get, words))
            found.pop(None, None)
            sizes.append(len(words))
            ids += found.keys()
            counts += found.values()
            ends.append(len(ids))
        ends = pa.array(ends, pa.int32())
        yield {
            "doc_id": batch.column("doc_id"),
            "n": sizes,
            "terms": pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
            "counts": pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
        }


class _Heaps:
    """The k best documents of each item: (score, has an id, minus the id), the worst on top."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]
        self.floor = np.ones(items, np.int64)  # only scores above 0 count

    def offer(self, scores: np.ndarray, docs: list[int | None]) -> None:
        least = self.floor
        if len(docs) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        for row, item in zip(*(x.tolist() for x in np.nonzero(scores >= least))):
            doc, heap = docs[row], self.heaps[item]
            entry = (int(scores[row, item]), doc is not None, -(doc or 0))
            if len(heap) < self.k:
                heappush(heap, entry)
            else:
                heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = max(1, heap[0][0])


def _streamed(batches, index, k):
    """Every document through the postings; a row per entry of the heaps at the end of the task."""
    items, weights, starts, postings, n_docs, n_terms = index.value
    best = _Heaps(len(items), k)
    share = np.diff(starts)
    for batch in batches:
        docs = batch.column("doc_id").to_pylist()
        term, tf = (np.asarray(batch.column(c).flatten()) for c in ("terms", "counts"))
        ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        damp = np.array([8 * (100 - 90 + 90 * n * n_docs // n_terms) for n in batch.column("n").to_pylist()], np.int64)
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + np.repeat(damp, np.diff(ends))))
        load = np.concatenate(([0], np.cumsum(share[term])))[ends]  # additions up to each document
        at = 0
        while at < len(docs):
            upto = max(at + 1, min(at + max(1, CELLS // len(items)), int(np.searchsorted(load, load[at] + CELLS, side="right")) - 1))
            here = slice(ends[at], ends[upto])
            times = share[term[here]]
            row = np.repeat(np.repeat(np.arange(upto - at), np.diff(ends[at : upto + 1])), times)
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            item = postings[np.repeat(starts[term[here]], times) + within]
            scores = np.zeros((upto - at, len(items)), np.int64)
            np.add.at(scores, (row, item), np.repeat(gain[here], times))
            best.offer(scores, docs[at:upto])
            at = upto
    part = TaskContext.get().partitionId() % FAN_IN
    rows = [(int(items[i]), score, -minus if known else None, part) for i, heap in enumerate(best.heaps) for score, known, minus in heap]
    if rows:
        yield dict(zip(("item_id", "score", "doc_id", "part"), map(list, zip(*rows))))


def _merged(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_items: int = BLOCK_ITEMS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k rows of ``docs(doc_id, text)`` of highest score above 0 for every item of
    ``items(item_id, text)``, equal scores by ascending doc_id; all where there are fewer. Runs jobs per block of items.

    The score sums, over the item's distinct terms t, ``w * ((10**9 tf) div (1000 tf + 8 m))`` with
    ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 n N) div L``: N documents with a term, L terms in
    all, n terms of the document, df documents with t, tf occurrences in the document. A term in over half of the documents
    counts against them, as w is negative.

    Null and empty texts have no term: such a document does not count towards N and is never listed, such an item has no
    rows. Items without item_id are not asked; rows that share one are one item with the terms of all. Every row of
    ``docs`` is a document of its own, repeated rows too; of equal scores a null doc_id comes last. No rows give no rows;
    further columns are not read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    path = scratch_path(spark, "hits")
    spark.createDataFrame([], HITS).write.parquet(path)
    for ids, asked in _blocks(items, block_items, block_pairs):
        vocabulary = sorted({t for some in asked for t in some})
        sent = spark.sparkContext.broadcast(vocabulary)
        counts = arrow_map(source, partial(_counted, vocabulary=sent), "doc_id long, n long, terms array<int>, counts array<long>")
        counts = materialize(counts, "counts")
        sums = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not sums["docs"]:
            break
        df = np.zeros(len(vocabulary), np.int64)
        # At most the block's terms.
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        weights = [math.floor(1000 * math.log((2 * sums["docs"] + 2) / (2 * d + 1))) for d in df.tolist()]
        number = {t: i for i, t in enumerate(vocabulary)}
        pairs = np.array([(number[t], i) for i, some in enumerate(asked) for t in some], np.int64)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        starts = np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1))
        index = spark.sparkContext.broadcast((ids, np.array(weights, np.int64), starts, pairs[:, 1], sums["docs"], sums["terms"]))
        hit = counts.filter(F.size("terms") > 0)
        arrow_map(hit, partial(_streamed, index=index, k=k), HITS).write.mode("append").parquet(path)
        sent.destroy()
        index.destroy()
    few = _merged(spark.read.schema(HITS).parquet(path), ["item_id", "part"], k).drop("rank")
    return _merged(few, ["item_id"], k).select("item_id", "rank", "doc_id", "score")
