"""Files read as many splits against the csv module, which reads them from the start."""

import csv
import io
import random

import pytest

from postloom.sources.csv_tables import read_csv_files
from postloom.sources.split_csv import _ends


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def wanted(data):
    rows = [r for r in csv.reader(io.StringIO(data, newline="")) if r]
    return [dict(zip(rows[0], r)) for r in rows[1:]]


def text(rng):
    parts = ["a", "bc", "é", "😀", ",", '"', '""', '"x"', "\n", "\n\n", "\r\n", " ", "12", '",', ',"', "\\"]
    return "".join(rng.choices(parts, k=rng.randrange(7)))


@pytest.mark.parametrize("size", [7, 40, 200, 1 << 20])
def test_against_the_csv_module(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    files = {}
    for number, end in enumerate(["\n", "\r\n", "\n"]):
        out = io.StringIO(newline="")
        names = [["id", "text", "more"], ["more", "id"], ["id", "text", "more"]][number]
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(names)
        for i in range(60):
            # A lone CR is not kept apart from a line's end by every reader.
            writer.writerow([str(i) if n == "id" else text(rng).replace("\r\n", "\n") if end == "\n" else text(rng) for n in names])
            if rng.random() < 0.1:
                out.write(end)
            if rng.random() < 0.1:
                out.write(f'{i}x,bare " quote{end}')  # fewer columns, and a quote that means nothing
        if number == 2:
            out.write('last,"without a line\n\nend, "" and quoted"')
        files[f"{number}.csv"] = out.getvalue()
    for name, data in files.items():
        (tmp_path / name).write_text(data, newline="", encoding="utf-8")
    small_splits(size)
    rows = read_csv_files(spark, [str(tmp_path / n) for n in files])
    assert size > 200 or rows.rdd.getNumPartitions() > 3
    got = {}
    for r in rows.collect():
        got.setdefault(r["_file"], {})[r["_pos"]] = [r["id"], r["text"], r["more"]]
    for name, data in files.items():
        want = [[r.get(c) or None for c in ("id", "text", "more")] for r in wanted(data)]
        here = [[v or None for v in got[name][i]] for i in range(len(got[name]))]
        assert here == want


def test_headers_and_odd_files(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("﻿id,x\r\n1,one\r\n\r\n2,\r\n", newline="")
    (tmp_path / "b.csv").write_text("id,x\n3,\"open\nto the\nend\n4,never a row\n", newline="")
    (tmp_path / "c.csv").write_text("", newline="")
    (tmp_path / "d.csv").write_text("\n1,2\n", newline="")
    (tmp_path / "e.csv").write_text("id,x,y", newline="")
    for size in (6, 1 << 20):
        small_splits(size)
        rows = read_csv_files(spark, [str(tmp_path / f"{c}.csv") for c in "abcde"], rank=3).collect()
        got = sorted((r["_file"], r["_pos"], r["id"], r["x"], r["y"], r["_source_rank"]) for r in rows)
        assert [g[:3] for g in got] == [("a.csv", 0, "1"), ("a.csv", 1, "2"), ("b.csv", 0, "3")]
        assert [g[3] for g in got][:2] == ["one", None] and {g[4:] for g in got} == {(None, 3)}
        assert got[2][3].strip('"').rstrip("\n") == "open\nto the\nend\n4,never a row"
    with pytest.raises(FileNotFoundError):
        read_csv_files(spark, [str(tmp_path / "c.csv"), str(tmp_path / "d.csv")])
    (tmp_path / "f.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError, match="f.csv"):
        read_csv_files(spark, [str(tmp_path / "f.csv")])


def test_states_compose():
    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        effect = np.array(rng.choices([0, 1, 2, 3], weights=[1, 3, 3, 1], k=rng.randrange(1, 12)))
        for state in (0, 1):
            want, now = [], state
            for e in effect.tolist():
                now = e >> now & 1
                want.append(now)
            assert _ends(effect, state).tolist() == want
