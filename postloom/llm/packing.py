"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

A piece goes into the open sequence for which the sum of the squared counts of open sequences per residual gap becomes
smallest; a new one is opened where none has room. Pieces are placed longest first, in groups of some ``GROUP`` pieces
drawn by a hash: a group is packed in one task, its size does not grow with the corpus, and what packing it alone can
cost is the last sequence of the group. Pieces that fill a sequence are not grouped at all.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm import tokens
from postloom.llm.common import arrow_map, utf8
from postloom.session import materialize

CAPACITY = 2048
END = 0
GROUP = 8192


def _cut(batches, capacity, end, vocabulary, keep_ids):
    encoder = tokens.encoding(vocabulary)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    for batch in batches:
        rows = []
        docs = batch.column("doc_id").to_pylist()
        for doc, text in zip(docs, batch.column("text")):
            body = (text.as_py() or b"").decode()
            ids = np.append(tokens.ids(encoder, body), end).astype("<u4")
            first = (len(ids) - 1) % capacity + 1
            at = [0, *range(first, len(ids), capacity), len(ids)]
            for number, (a, b) in enumerate(zip(at, at[1:])):
                raw = ids[a:b].tobytes()
                rows.append((doc, number, a, b - a, zlib.crc32(raw), raw)[: len(names)])
        if rows:
            yield dict(zip(names, map(list, zip(*rows))))


def cut(
    docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` and, on request, ``ids`` as little-endian unsigned 32-bit values.

    A document is its token ids and the id ``end``. One that is longer than ``capacity`` is cut from the back into
    pieces of that many ids, so that only its first piece may be shorter.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return arrow_map(source, partial(_cut, capacity=capacity, end=end, vocabulary=vocabulary, keep_ids=keep_ids), schema)


def place(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each piece, in the order given."""
    open_ = np.zeros(capacity + 1, np.int64)
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    made, numbers, offsets = 0, [], []
    for n in lengths:
        gaps = np.flatnonzero(open_[n:])
        if len(gaps):
            # Moving one sequence from gap g to gap g - n changes the sum of squares by this; a full one leaves it.
            change = -2 * open_[n:][gaps] + 1 + np.where(gaps > 0, 2 * open_[gaps] + 1, 0)
            gap = int(gaps[change.argmin()]) + n
            number = at[gap].pop()
            open_[gap] -= 1
        else:
            number, gap = made, capacity
            made += 1
        numbers.append(number)
        offsets.append(capacity - gap)
        if gap > n:
            open_[gap - n] += 1
            at[gap - n].append(number)
    return numbers, offsets


def _pack_group(table: pa.Table, capacity: int, uid: str, number: str) -> pa.Table:
    table = table.sort_by([("length", "descending"), (uid, "ascending")])
    numbers, offsets = place(table.column("length").to_pylist(), capacity)
    base = table.column(number)[0].as_py() << 32
    out = table.drop_columns([number, uid])
    out = out.append_column("sequence_id", pa.array(np.array(numbers, np.int64) + base))
    return out.append_column("offset", pa.array(np.array(offsets, np.int64)))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every piece has a ``length`` from 1 to ``capacity``. Columns with
    these two names are replaced, all others stay.

    Sequences are gapless from offset 0. Sequence ids are unique and otherwise without meaning.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # Working columns have names that no other has.
    prefix = "_" * (1 + max(len(c) - len(c.lstrip("_")) for c in kept))
    uid, number = f"{prefix}uid", f"{prefix}group"
    plain = pieces.select(*[F.col(f"`{c}`") for c in kept])
    numbered = materialize(plain.withColumn(uid, F.monotonically_increasing_id()), "pieces")
    short = numbered.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))
    grouped = short.withColumn(number, F.pmod(F.xxhash64(uid), F.lit(groups)))
    types = [(f.name, f.dataType.simpleString()) for f in numbered.schema if f.name != uid]
    schema = ", ".join(f"`{n}` {t}" for n, t in [*types, ("sequence_id", "long"), ("offset", "long")])
    packed = grouped.groupBy(number).applyInArrow(lambda t: _pack_group(t, capacity, uid, number), schema)
    full = numbered.filter(F.col("length") >= capacity).select(
        *[F.col(f"`{c}`") for c in kept], (-F.col(uid) - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every document of ``docs(doc_id, text)`` as pieces with their place in a packed sequence.

    Null and empty texts are the closing id alone. Null doc_ids and repeated rows are packed like any other row. No
    rows give no rows; further columns are not read.
    """
    return pack(cut(docs, capacity, keep_ids=keep_ids), capacity)
