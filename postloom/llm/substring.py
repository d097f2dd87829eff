"""Substring dedup: remove every word run of a fixed length that an earlier document already holds.

A window is ``window`` consecutive words. Each window has a minimiser, the smallest hash among its runs of ``piece``
words; consecutive windows that share it form a super-k-mer and travel as one packed string to the bucket of that
minimiser, where equal windows meet. A bucket sorts its windows and finds the smallest doc_id of each: equality is
decided on the words themselves, never on hashes.

What keeps the buckets small:

* A task packs some ``FLUSH`` super-k-mers at a time. Of the documents among them that hold the same one, only the
  smallest doc_id needs a bucket's answer; the others hold a copy of a smaller document's words whatever the bucket
  finds. A text or passage that fills a third of the corpus reaches its bucket once per flush.
* A minimiser with more than 1/``HOT_SHARE`` of all super-k-mers, and enough to make a bucket uneven, is hot (a common
  passage in ever new surroundings): windows under it travel alone, to the bucket of their own hash. At most
  ``HOT_SHARE`` minimisers can be hot, so the list of them is bounded. It decides only where windows meet, not what is
  found.
* The number of buckets follows the number of super-k-mers, so that one holds about ``BUCKET`` of them. What a flush
  has for a bucket goes there as one compressed block.
"""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map, utf8
from postloom.session import materialize

WINDOW = 13
PIECE = 3
HOT_SHARE = 50_000
#: Minimisers seen less often than this in one batch are not counted towards being hot.
BATCH_COUNT = 8
#: Longest super-k-mer, in windows.
LONGEST = 64
FLUSH = 1 << 18
BUCKET = 1 << 16
#: Slots of the filter that tells which doc_ids may occur in several rows.
SLOTS = 1 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(hashes: np.ndarray, length: int) -> np.ndarray:
    """One well-mixed hash for every run of ``length`` hashes."""
    n = len(hashes) - length + 1
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * _A + hashes[i : i + n]
        out ^= out >> np.uint64(29)
    out *= _B
    return out ^ (out >> np.uint64(32))


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` neighbours, by doubling."""
    n, have, out = len(values) - width + 1, 1, values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have : width - have + n]) if have < width else out


def _routes(words: list[bytes], window: int, piece: int, hot: np.ndarray) -> np.ndarray:
    """The bucket hash of every window: its minimiser, or the hash of the whole window where that is hot."""
    from xxhash import xxh64_intdigest

    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    low = _minima(_mixed(hashes, piece), window - piece + 1)
    if len(hot):
        found = hot[np.minimum(np.searchsorted(hot, low), len(hot) - 1)] == low
        if found.any():
            low = np.where(found, _mixed(hashes, window), low)
    return low


def _runs(routes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of windows with one bucket, long runs in parts of ``LONGEST``."""
    cut = np.flatnonzero(routes[1:] != routes[:-1]) + 1
    starts = np.concatenate(([0], cut))
    sizes = np.diff(np.concatenate((starts, [len(routes)])))
    if sizes.max() > LONGEST:
        parts = (sizes + LONGEST - 1) // LONGEST
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + within * LONGEST
        sizes = np.minimum(np.repeat(sizes, parts) - within * LONGEST, LONGEST)
    return starts, sizes


def _count_minimisers(batches, window, piece):
    """Per batch, minimisers of many super-k-mers, and the number of all super-k-mers under a null minimiser."""
    none = np.zeros(0, np.uint64)
    for batch in batches:
        heads, total = [], 0
        for text in batch.column("text").to_pylist():
            words = (text or b"").split()
            if len(words) >= window:
                routes = _routes(words, window, piece, none)
                heads.append(routes[_runs(routes)[0]])
                total += len(heads[-1])
        if heads:
            values, counts = np.unique(np.concatenate(heads), return_counts=True)
            often = counts >= BATCH_COUNT
            keys = pa.array(values[often].view(np.int64).tolist() + [None], pa.int64())
            yield {"key": keys, "n": np.append(counts[often], total)}


class _Packer:
    """Super-k-mers of a task on their way to the buckets, and windows already known to be copies."""

    def __init__(self, window, piece, hot, buckets):
        self.window, self.piece, self.hot, self.buckets = window, piece, hot, buckets
        self.codec = pa.Codec("zstd", compression_level=6)
        self.clear()

    def clear(self):
        self.first: dict[bytes, int] = {}
        self.packed, self.who, self.known = [], [], {}
        self.routes, self.starts, self.sizes, self.owners = [], [], [], []

    def add(self, doc, mark, text):
        """Documents come in order of doc_id, at least between two flushes."""
        words = text.split()
        if len(words) < self.window:
            return
        routes = _routes(words, self.window, self.piece, self.hot)
        starts, sizes = _runs(routes)
        joined = b" ".join(words)
        at = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
        left, right = at[starts].tolist(), (at[starts + sizes + self.window - 1] - 1).tolist()
        packed = [joined[a:b] for a, b in zip(left, right)]
        base, owner = len(self.packed), len(self.who)
        first = self.first.setdefault
        seen = [first(p, i) for i, p in enumerate(packed, base)]
        keep = np.ones(len(packed), bool)
        # An equal super-k-mer of a smaller doc_id settles this one; one of the same doc_id does not.
        for i, j in enumerate(seen):
            if j < base and self.who[self.owners[j]][0] < doc:
                keep[i] = False
        self.who.append((doc, mark))
        if not keep.all():
            self.known[owner] = _joined_runs(starts[~keep].tolist(), sizes[~keep].tolist())
            # Positions in ``packed`` move up, so names of this document's first super-k-mers are set anew.
            for i, place in zip(np.flatnonzero(keep).tolist(), range(base, len(keep) + base)):
                if seen[i] == base + i:
                    self.first[packed[i]] = place
            packed = [p for p, k in zip(packed, keep.tolist()) if k]
            starts, sizes, routes = starts[keep], sizes[keep], routes[starts[keep]]
        else:
            routes = routes[starts]
        self.packed += packed
        self.owners += [owner] * len(packed)
        self.routes.append(routes)
        self.starts.append(starts)
        self.sizes.append(sizes)

    def flush(self):
        """Rows (bucket, doc_id, mark, start, n, block): a block has what goes to a bucket, the others known copies."""
        rows = []
        for owner, runs in self.known.items():
            doc, mark = self.who[owner]
            rows += [(doc % self.buckets, doc, mark, *run, None) for run in runs]
        if self.packed:
            routes = np.concatenate(self.routes)
            starts, sizes = np.concatenate(self.starts), np.concatenate(self.sizes)
            ids = np.array(self.who, np.int64)[np.array(self.owners)]
            bucket = (routes >> np.uint64(24)) % np.uint64(self.buckets)
            part = (routes & np.uint64(0xFFFFFF)).astype(np.int64)
            order = np.lexsort((part, bucket))
            bucket = bucket[order]
            cut = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(order)]))
            for a, b in zip(cut.tolist(), cut[1:].tolist()):
                some = order[a:b]
                strings = [self.packed[i] for i in some.tolist()]
                columns = (np.diff(part[some], prepend=0), starts[some], sizes[some], list(map(len, strings)), ids[some, 0], ids[some, 1])
                raw = b"".join(np.asarray(c, t).tobytes() for c, t in zip(columns, ("<u4", "<u4", "<u1", "<u4", "<i8", "<i8")))
                raw = np.array([b - a], "<u4").tobytes() + raw + b"".join(strings)
                block = np.array([len(raw)], "<u4").tobytes() + self.codec.compress(raw, asbytes=True)
                rows.append((int(bucket[a]), None, None, None, None, block))
        self.clear()
        for i in range(0, len(rows), 1000):
            yield dict(zip(("bucket", "doc_id", "mark", "start", "n", "block"), map(list, zip(*rows[i : i + 1000]))))


def _joined_runs(starts: list[int], sizes: list[int]) -> list[list[int]]:
    """(start, windows) pairs in order, neighbours joined."""
    out: list[list[int]] = []
    for start, size in zip(starts, sizes):
        if out and out[-1][0] + out[-1][1] == start:
            out[-1][1] += size
        else:
            out.append([start, size])
    return out


def _pack(batches, window, piece, hot, buckets, shared):
    packer = _Packer(window, piece, hot, buckets)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts, marks, slots = batch.column("text"), batch.column("mark"), batch.column("slot")
        for doc, i in sorted((d, i) for i, d in enumerate(ids) if d is not None):
            text = texts[i].as_py()
            if text:
                several = shared[slots[i].as_py() >> 3] >> (slots[i].as_py() & 7) & 1
                packer.add(doc, marks[i].as_py() if several else 0, text)
                if len(packer.packed) >= FLUSH:
                    yield from packer.flush()
        yield from packer.flush()


def _copied(rows: list[tuple], window: int):
    """Of super-k-mers (packed, doc, mark, start, size) with one minimiser, the windows that a smaller doc_id holds too,
    as rows (doc, mark, start, windows)."""
    low: dict[bytes, int] = {}
    for packed, doc, *_ in rows:
        low[packed] = min(doc, low.get(packed, doc))
    part: dict[bytes, list[int]] = {}
    if len(low) > 1:
        entries = []
        for packed, doc in low.items():
            at = [0]
            for w in packed.split(b" "):
                at.append(at[-1] + len(w) + 1)
            entries += [(packed[at[j] : at[j + window] - 1], doc, j, packed) for j in range(len(at) - window)]
        entries.sort()
        for _, same in groupby(entries, itemgetter(0)):
            _, smallest, _, _ = next(same)
            for _, doc, j, packed in same:
                if doc > smallest:
                    part.setdefault(packed, []).append(j)
    for packed, doc, mark, start, size in rows:
        if doc > low[packed]:
            yield doc, mark, start, size
        elif packed in part:
            windows = sorted(part[packed])
            for run in _joined_runs([start + j for j in windows], [1] * len(windows)):
                yield doc, mark, *run


def _unpacked(blocks: list[bytes]):
    """Columns (part of the minimiser, start, size, doc, mark) of a bucket, its strings, and where each begins."""
    codec, columns, strings = pa.Codec("zstd"), [], []
    for block in blocks:
        raw = codec.decompress(block[4:], int(np.frombuffer(block, "<u4", 1)[0]), asbytes=True)
        n, at, got = int(np.frombuffer(raw, "<u4", 1)[0]), 4, []
        for kind in ("<u4", "<u4", "<u1", "<u4", "<i8", "<i8"):
            got.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
            at += got[-1].nbytes // 8 * np.dtype(kind).itemsize
        got[0] = np.cumsum(got[0])
        columns.append(got)
        strings.append(raw[at:])
    part, start, size, length, doc, mark = (np.concatenate(c) for c in zip(*columns))
    return part, start, size, doc, mark, b"".join(strings), np.concatenate(([0], np.cumsum(length)))


def _bucket(blocks: list[bytes], window: int):
    """A minimiser that only one document has has nothing to find."""
    part, start, size, doc, mark, strings, at = _unpacked(blocks)
    order = np.argsort(part, kind="stable")
    part, ids = part[order], doc[order]
    heads = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
    ends = np.concatenate((heads[1:], [len(order)]))
    several = np.maximum.reduceat(ids, heads) != np.minimum.reduceat(ids, heads)
    for a, b in zip(heads[several].tolist(), ends[several].tolist()):
        some = order[a:b]
        columns = (doc[some].tolist(), mark[some].tolist(), start[some].tolist(), size[some].tolist())
        yield from _copied([(strings[at[i] : at[i + 1]], *r) for i, *r in zip(some.tolist(), *columns)], window)


def _buckets(batches, window):
    """Rows arrive sorted by bucket; one bucket is held at a time."""
    bucket, blocks, out = None, [], []

    def close():
        return _bucket(blocks, window) if blocks else ()

    def rows():
        return dict(zip(("doc_id", "mark", "start", "n"), map(list, zip(*out))))

    for batch in batches:
        columns = [batch.column(c) for c in ("bucket", "block", "doc_id", "mark", "start", "n")]
        for i in range(batch.num_rows):
            number, block, *known = (c[i].as_py() for c in columns)
            if number != bucket:
                out += close()
                bucket, blocks = number, []
                if len(out) > 20_000:
                    yield rows()
                    out = []
            if block is None:
                out.append(known)
            else:
                blocks.append(block)
    out += close()
    if out:
        yield rows()


def _source(docs: DataFrame) -> DataFrame:
    """``mark`` tells rows with one doc_id apart by their text; ``slot`` is the doc_id's place in a filter."""
    doc, text = F.col("doc_id").cast("long"), F.col("text")
    slot = F.pmod(F.xxhash64(doc), F.lit(SLOTS)).cast("int")
    return docs.select(doc.alias("doc_id"), F.xxhash64(text).alias("mark"), slot.alias("slot"), utf8(text).alias("text"))


def minimiser_counts(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> tuple[np.ndarray, int]:
    """Sorted hot minimisers, and the number of all super-k-mers; a job over every text."""
    counted = arrow_map(
        _source(docs).select("text"), partial(_count_minimisers, window=window, piece=piece), "key long, n long"
    )
    sums = materialize(counted.groupBy("key").agg(F.sum("n").alias("n")), "minimisers")
    total = sums.filter("key is null").first()
    if total is None:
        return np.zeros(0, np.uint64), 0
    # Rows over the share are HOT_SHARE at most, whatever the corpus.
    rows = sums.filter(F.col("key").isNotNull() & (F.col("n") > max(BUCKET // 4, total["n"] // HOT_SHARE))).select("key").collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64)), total["n"]


def _shared_ids(docs: DataFrame) -> bytes:
    """Bit set over the slots of doc_ids that occur in several rows: of fixed size, with false positives only."""
    several = _source(docs).select("doc_id", "slot").groupBy("doc_id", "slot").count().filter("count > 1 and doc_id is not null")
    bits = np.zeros(SLOTS, np.uint8)
    bits[[r.slot for r in several.select("slot").distinct().collect()]] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def copied_spans(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """``(doc_id, mark, start, n)``: runs of n windows of a document, from the one at word ``start`` on, that start in a
    smaller doc_id too. ``mark`` is 0, or names the row of a doc_id that occurs in several by the hash of its text."""
    hot, total = minimiser_counts(docs, window, piece)
    work = partial(
        _pack, window=window, piece=piece, hot=hot, buckets=max(1, -(-total // BUCKET)), shared=_shared_ids(docs)
    )
    packed = arrow_map(_source(docs), work, "bucket long, doc_id long, mark long, start int, n int, block binary")
    buckets = packed.repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(buckets, partial(_buckets, window=window), "doc_id long, mark long, start int, n int")


def kept_words(text: bytes | None, spans: list[tuple[int, int]], window: int) -> tuple[int, list[bytes]]:
    """Number of words of a text, and those outside the spans."""
    words = (text or b"").split()
    if not spans:
        return len(words), words
    pairs = np.array(spans, np.int64)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 0] + pairs[:, 1] + window - 1, -1)
    keep = np.cumsum(change[:-1]) == 0
    return len(words), [w for w, k in zip(words, keep.tolist()) if k]


def _clean(batches, window):
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "kept")}
        spans, marks = batch.column("spans"), batch.column("mark").to_pylist()
        for i, text in enumerate(batch.column("text")):
            own = [(s["start"], s["n"]) for s in spans[i].as_py() or () if s["mark"] in (0, marks[i])]
            n, kept = kept_words(text.as_py(), own, window)
            joined = b" ".join(kept)
            out["n_words"].append(n)
            out["n_removed"].append(n - len(kept))
            out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
            out["kept"].append(joined.decode() if len(kept) < n else (text.as_py() or b"").decode())
        passed = {f: batch.column(f) for f in ("doc_id", "rest")}
        yield passed | out


def remove_copied(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Every row of ``docs(doc_id, text, ...)`` with ``n_words, n_removed, kept_sha256, kept``; further columns stay,
    except that columns with these names are replaced; ``text`` is not returned. ``kept`` is the text itself where no
    word goes, else the words that stay, joined by blanks; ``kept_sha256`` is always that of the joined words.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller doc_id. Windows
    are judged on the input. Null and empty texts have no words and leave the empty string; texts shorter than a window
    stay whole. Rows without doc_id neither lose words nor cost others theirs. Rows that share a doc_id are not earlier
    than one another, so a repeated row stays as it is. No rows give no rows.
    """
    spans = copied_spans(docs, window, piece).groupBy("doc_id").agg(F.collect_list(F.struct("mark", "start", "n")).alias("spans"))
    made = ("n_words", "n_removed", "kept_sha256", "kept")
    others = [c for c in docs.columns if c not in (*made, "doc_id", "text")]
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("mark"),
        F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(others)] or [F.lit(0).alias("none")]).alias("rest"),
        utf8(F.col("text")).alias("text"),
    )
    joined = plain.join(spans, "doc_id", "left").select("doc_id", "mark", "rest", "text", "spans")
    rest = joined.schema["rest"].dataType.simpleString()
    cleaned = arrow_map(
        joined,
        partial(_clean, window=window),
        f"doc_id long, rest {rest}, n_words long, n_removed long, kept_sha256 string, kept string",
    )
    return cleaned.select("doc_id", *[F.col(f"rest.f{i}").alias(c) for i, c in enumerate(others)], *made)
