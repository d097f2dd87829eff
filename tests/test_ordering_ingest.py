import csv
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postloom.operators import ingest, ordering
from postloom.plans.ingest_job import ingest_landing
from postloom.schemas import MERGED_COLUMNS
from postloom.sources.csv_tables import READ, read_landing, read_merged, write_csv


@pytest.mark.parametrize("n", [0, 1, 7, 99, 100, 250])
def test_skip_and_take(spark, n, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK", 16)
    ords = sorted(random.Random(n).sample(range(2000), 100))
    df = spark.createDataFrame([(o,) for o in ords], "o bigint")
    assert sorted(r.o for r in ordering.skip_rows(df, "o", n).collect()) == ords[n:]
    assert sorted(r.o for r in ordering.take_rows(df, "o", n).collect()) == (ords[:n] if n else ords)


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def landing(tmp_path):
    base, folder = tmp_path / "main.csv", tmp_path / "raw"
    folder.mkdir()
    write(base, ["tweet_id", "text", "likes", "comments"],
          [["1", 'multi\nline, "quoted"', "5", "0"], ["", "no id", "1", ""], ["2", "first", "1", "1"]])
    write(folder / "b.csv", ["likes", "tweet_id", "text", "extra"], [["9", "1", "better", "e"], ["2", "2", "tie", "e"], ["0", "3", " pad ", ""]])
    write(folder / "a.csv", ["text", "tweet_id", "likes"], [["", "", ""], ["other", " 1", "3"], ["back\\slash", "4", "1"]])
    return str(base), str(folder)


def test_read_landing_by_header_name_and_order(spark, tmp_path):
    base, folder = landing(tmp_path)
    rows = ingest.number_rows(ingest.project_merged(read_landing(spark, folder, base), "_source_rank", "_file", "_pos"))
    got = [(r.row_ord, r.tweet_id, r.text, r.likes) for r in rows.orderBy("row_ord").collect()]
    assert got == [
        (0, "1", 'multi\nline, "quoted"', "5"), (1, "", "no id", "1"), (2, "2", "first", "1"),
        (3, "", "", ""), (4, " 1", "other", "3"), (5, "4", "back\\slash", "1"),
        (6, "1", "better", "9"), (7, "2", "tie", "2"), (8, "3", " pad ", "0"),
    ]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ingest_job(spark, tmp_path, fmt):
    base, folder = landing(tmp_path)
    out = str(tmp_path / "merged")
    counts = ingest_landing(spark, folder, out, base, fmt)
    assert (counts.before, counts.duplicates, counts.after) == (9, 2, 7)
    rows = read_merged(spark, out).orderBy("row_ord").collect()
    # first-seen order; the better copy of 1 replaces it in place, the tie on 2 keeps the first
    assert [(r.tweet_id, r.text) for r in rows] == [
        ("1", "better"), ("unknown_1", "no id"), ("2", "first"), ("unknown_3", ""), (" 1", "other"),
        ("4", "back\\slash"), ("3", " pad "),
    ]
    assert rows[0].image_links == "[]" and set(MERGED_COLUMNS) <= set(rows[0].asDict())


def test_missing_inputs(spark, tmp_path):
    _, folder = landing(tmp_path)
    with pytest.warns(UserWarning):
        read_landing(spark, folder, str(tmp_path / "none.csv"))
    with pytest.raises(AnalysisException):
        read_merged(spark, str(tmp_path / "none")).count()


def test_dedup_matches_a_loop(spark):
    rnd = random.Random(1)
    rows = [(str(rnd.choice([0, 0, 0, rnd.randrange(50)])), rnd.randrange(5), i) for i in range(500)]
    best, first = {}, {}
    for key, score, i in rows:
        first.setdefault(key, i)
        if key not in best or score > best[key][0]:
            best[key] = (score, i)
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "id string, score int, o bigint").repartition(7)
    got = {r.id: (r.score, r.o, r.first_ord) for r in ingest.dedup_best(df, "id", F.col("score"), "o").collect()}
    assert got == {k: (*best[k], first[k]) for k in best}


def test_flatten_author(spark):
    df = spark.createDataFrame([("t", 1, ("u", None, 5)), ("s", 2, None)], "text string, id int, user struct<username:string,displayname:string,followers_count:int>")
    flat = ingest.flatten_author(df)
    assert flat.columns == ["id", "text", "user_username", "user_displayname", "user_followers", "user_verified"]
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [(1, "t", "u", "", 5, False), (2, "s", "", "", 0, False)]


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'q"uo,te'), (2, "line\nbreak\r\n"), (3, "back\\slash\\"), (4, "  ends  "), (5, ""), (6, None), (7, '"')]
    path = str(tmp_path / "x")
    write_csv(spark.createDataFrame(rows, "i int, s string"), path)
    back = spark.read.schema("i int, s string").options(**READ).csv(path).orderBy("i").collect()
    assert [r.s or "" for r in back] == [s or "" for _, s in rows]
    import glob

    for file in glob.glob(path + "/*.csv"):
        with open(file, newline="", encoding="utf-8") as f:
            for row in list(csv.reader(f))[1:]:
                assert (rows[int(row[0]) - 1][1] or "") == row[1]


def test_winners_are_those_of_dedup_best_and_rows_are_not_sorted(spark, plan):
    data = [(f"i{n % 5}", n % 3, (f"f{n % 2}", n), (f"f{n % 4}", n % 7), n % 2 == 0, f"text {n}") for n in range(40)]
    # a replayed row meets its own copy
    data += [("i0", 9, ("f9", 1), ("f9", 1), False, "same"), ("i0", 9, ("f9", 1), ("f9", 1), True, "same")]
    place = "struct<source_file:string,file_row:bigint>"
    df = spark.createDataFrame(data, f"tweet_id string, n int, won {place}, seen {place}, fresh boolean, v string")
    best = ingest.winners(df, "tweet_id", F.col("n"), ("won", "fresh"), "seen")
    old = ingest.dedup_best(df, "tweet_id", F.col("n"), "won", "seen")
    some = ["tweet_id", "n", "won", "first_ord", "v"]
    assert sorted(best.select(some).collect()) == sorted(old.select(some).collect())
    assert "ShuffledHashJoin" in plan(best) and "Sort" not in plan(best)
