"""Quoted CSV in parallel: a file is read as independent byte ranges, however long its quoted fields are.

The text source divides a file into splits of whole lines. Whether a line starts inside quotes depends on all lines before
it, but only through one bit, and what a line does to that bit is known without it: a regular expression tells how the
line ends if it starts a row, another how it ends if it starts inside quotes. A first job composes these per split and
counts the rows that begin there in either case; a fold over the splits, a row each, then says for every split where it
starts. A second scan needs nothing else: lines become rows inside their split, and only a row that crosses the end of a
split is put together in a shuffle.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A field from its start to the next comma: in quotes, with doubled quotes for quotes, or bare, where quotes mean nothing.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_FIELDS = rf"{_FIELD}(?:,{_FIELD})*+\z"
#: A line that ends outside quotes, if it starts a row, and if it starts inside quotes.
_CLOSED = rf"\A{_FIELDS}"
_CLOSING = rf'\A(?:[^"]++|"")*+"[^,]*+(?:,{_FIELD})*+\z'

_SPLIT = "split long, file string, name string, block long, header string, ends_0 int, ends_1 int, rows_0 long, rows_1 long"
_ROWS = "name string, layout int, pos long, block long, row string"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines, with their split, and what they do: bit 0 is how a line ends (1: inside quotes) if it starts outside, bit 1
    if it starts inside."""
    value = F.col("value")
    inside = lambda pattern: F.when(value.rlike(pattern), 0).otherwise(1)
    effect = F.when(~F.contains(value, F.lit('"')), 2).otherwise(inside(_CLOSED) + 2 * inside(_CLOSING))
    at = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"))
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split"),
        *at,
        effect.cast("int").alias("effect"),
        value.isin("", "\r").alias("blank"),
        "value",
    )


def _ends(effect: np.ndarray, start: int) -> np.ndarray:
    """State after each line: lines that fix it, and changes of it since the last such line."""
    fixed = (effect == 0) | (effect == 3)
    changes = np.cumsum(effect == 1)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(effect)), -1))
    known = np.where(last >= 0, effect[last] // 3, start)
    return known ^ ((changes - np.where(last >= 0, changes[last], 0)) & 1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Parts of batches that lie in one split, and whether the split begins with them; a task reads one after another."""
    now = None
    for batch in batches:
        split = batch.column("split").to_numpy()
        cuts = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), len(split)] if len(split) else []
        for a, b in zip(cuts, cuts[1:]):
            key = int(split[a])
            yield key, key != now, batch.slice(a, b - a)
            now = key


def _effects(part: pa.RecordBatch, header: bool) -> tuple[np.ndarray, np.ndarray]:
    """What lines do, and which of them are no row even outside quotes; a header is one line."""
    effect = part.column("effect").to_numpy().copy()
    blank = part.column("blank").to_numpy(zero_copy_only=False).copy()
    if header:
        effect[0], blank[0] = 0, True
    return effect, blank


def _summaries(batches):
    """A row per split: how it ends and how many rows begin in it, for both states it may start in."""
    held: dict | None = None
    for key, fresh, part in _runs(batches):
        if fresh:
            if held:
                yield _one(held)
            first = {c: part.column(c)[0].as_py() for c in ("file", "name", "block", "value")}
            held = {"split": key, **first, "state": [0, 1], "rows": [0, 0]}
        effect, blank = _effects(part, fresh and held["block"] == 0)
        for s in (0, 1):
            ends = _ends(effect, held["state"][s])
            before = np.concatenate(([held["state"][s]], ends[:-1]))
            held["rows"][s] += int(np.count_nonzero((before == 0) & ~blank))
            held["state"][s] = int(ends[-1])
    if held:
        yield _one(held)


def _one(held: dict) -> pa.RecordBatch:
    header = held["value"] if held["block"] == 0 else None
    values = (held["split"], held["file"], held["name"], held["block"], header, *held["state"], *held["rows"])
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[c.split()[0] for c in _SPLIT.split(", ")])


def _joined(batches, starts, crossing):
    """Rows that lie in one split; with ``crossing``, the parts of those that do not, one of a split at a time."""
    names, layouts, numbers, blocks, texts = [], [], [], [], []
    plan = None

    def put(number, lines):
        names.append(plan[1])
        layouts.append(plan[2])
        numbers.append(number)
        blocks.append(plan[3])
        texts.append("\n".join(lines))

    for key, fresh, part in _runs(batches):
        if fresh:
            if plan and opened is not None and crossing:
                put(number - 1, opened)
            plan = starts.value.get(key)
            if plan:
                state, number = plan[0], plan[4]
                # Lines of a row that is not complete; at the start of a split, of one that began in an earlier split.
                opened, early = ([], True) if state else (None, False)
        if not plan:
            continue
        effect, blank = _effects(part, fresh and plan[3] == 0)
        ends = _ends(effect, state)
        before = np.concatenate(([state], ends[:-1]))
        begins = (before == 0) & ~blank
        at = number + np.cumsum(begins) - 1  # the number of the row that a line belongs to
        value = part.column("value")
        if not crossing:
            whole = np.flatnonzero(begins & (ends == 0))
            if len(whole):
                count = len(whole)
                yield _rows([plan[1]] * count, [plan[2]] * count, at[whole], [plan[3]] * count, value.take(pa.array(whole)))
        # Lines of rows over several lines.
        for i in np.flatnonzero((before == 1) | (begins & (ends == 1))).tolist():
            if before[i] == 0:
                opened, early = [], False
            opened.append(value[i].as_py())
            if ends[i] == 0:
                if early == crossing:
                    put(int(at[i]), opened)
                opened = None
        state, number = int(ends[-1]), int(at[-1]) + 1
        if len(texts) > 4096:
            yield _rows(names, layouts, numbers, blocks, texts)
            names, layouts, numbers, blocks, texts = [], [], [], [], []
    if plan and opened is not None and crossing:
        put(number - 1, opened)
    if texts:
        yield _rows(names, layouts, numbers, blocks, texts)


def _rows(names, layouts, numbers, blocks, texts) -> pa.RecordBatch:
    columns = ((names, pa.string()), (layouts, pa.int32()), (numbers, pa.int64()), (blocks, pa.int64()), (texts, pa.string()))
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in columns], names=[c.split()[0] for c in _ROWS.split(", ")])


def _header(line: str | None) -> tuple[str, ...]:
    return tuple(next(csv.reader([(line or "").lstrip("﻿").rstrip("\r")]), []))


def read_rows(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame | None:
    """Rows of CSV files by header name, every column a string that is null where a file lacks it, with ``_file`` (the
    file's name) and ``_pos``, the 0-based number of the row in its file. None where no file has a header.

    Lines end with LF or CRLF, and the header is one line. Empty lines outside quotes are no rows, files whose first line
    is empty have none, and a quote that is never closed takes the rest of its file. Runs a job over the files, which
    returns a row per split to the driver, where the scan keeps the list of splits as well.
    """
    lines = _lines(spark, paths)
    splits = lines.mapInArrow(_summaries, _SPLIT).collect()
    if len({r["split"] for r in splits}) < len(splits):
        raise RuntimeError("two splits have one hash; read with another spark.sql.files.maxPartitionBytes")
    headers = {r["file"]: _header(r["header"]) for r in splits if r["block"] == 0}
    layouts = sorted({h for h in headers.values() if h})
    for names in layouts:
        if len(set(names)) < len(names):
            file = next(f for f, h in headers.items() if h == names)
            raise ValueError(f"repeated column name in the header of {file}")
    if not layouts:
        return None
    number = {names: i for i, names in enumerate(layouts)}
    starts, crossing = {}, []
    file, state, rows, last = None, 0, 0, None
    for r in sorted(splits, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, state, rows = r["file"], 0, 0
        elif state:
            crossing += [last, r["split"]]
        if headers[file]:
            starts[r["split"]] = (state, r["name"], number[headers[file]], r["block"], rows)
        last = r["split"]
        state, rows = (r["ends_1"], rows + r["rows_1"]) if state else (r["ends_0"], rows + r["rows_0"])
        if state and headers[file]:
            crossing.append(last)
    sent = spark.sparkContext.broadcast(starts)
    found = lines.mapInArrow(partial(_joined, starts=sent, crossing=False), _ROWS).drop("block")
    if crossing:
        # The splits at whose ends a row is open; no other line of the files is looked at again.
        near = spark.createDataFrame([(s,) for s in sorted(set(crossing))], "split long")
        some = lines.join(F.broadcast(near), "split", "left_semi")
        parts = some.mapInArrow(partial(_joined, starts=sent, crossing=True), _ROWS)
        pieces = F.array_sort(F.collect_list(F.struct("block", "row")))
        whole = parts.groupBy("name", "layout", "pos").agg(F.array_join(F.transform(pieces, lambda p: p["row"]), "\n").alias("row"))
        found = found.unionByName(whole)
    # One parse for all layouts: a row has as many columns as the widest, and a name is looked up by layout.
    wide = max(map(len, layouts))
    row = F.when(F.endswith("row", F.lit("\r")), F.expr("substring(row, 1, char_length(row) - 1)")).otherwise(F.col("row"))
    parsed = found.select("name", "layout", "pos", F.from_csv(row, ", ".join(f"c{i} string" for i in range(wide)), options).alias("v"))
    names = list(dict.fromkeys(n for layout in layouts for n in layout))

    def value(name):
        out = F.lit(None).cast("string")
        for i, layout in enumerate(layouts):
            if name in layout:
                out = F.when(F.col("layout") == i, F.col(f"v.c{layout.index(name)}")).otherwise(out)
        return out.alias(name)

    return parsed.select(*[value(n) for n in names], F.col("name").alias("_file"), F.col("pos").alias("_pos"))
