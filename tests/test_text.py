from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postloom.functions import text as tx
from postloom.functions.numbers import safe_int


def one(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("s"))).collect()]


CLEANED = {
    "https://t.co/abc": "", "@name": "", "hi @caf\u00e9 x": "hi x", "a\u00a0\u00a0b\u3000\u3000c": "a b c", "\t x \n": "x", "\u00a0": "", "": "",
    "no://link": "no://link", "http://": "http://", "see https://a.b/c?d=\u00e9#f now": "see now", "mail a@b.c": "mail a.c",
    "x\u2028y\x1cz\x85w": "x y z w", "HTTPS://UP.case": "HTTPS://UP.case", "a \u00a0b": "a b", "one two": "one two", "@a@b c@": "c@",
    "http://x@y z": "z", "end http://a.b": "end", "(https://a.b) x": "( x", "@a_1-b": "-b", "@ a": "@ a",
}


def test_clean_text_by_hand(spark):
    assert one(spark, [None, *CLEANED], tx.clean_text) == ["", *CLEANED.values()]


BLANKS = " \t\n\u00a0\u3000\u2028\x1c\x85"


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["word", "\u00e9t\u00e9", "https://a.b/?x", "@name", "1", *BLANKS]), max_size=12), min_size=20, max_size=60))
def test_clean_text_keeps_words_and_nothing_else(spark, parts):
    """Parts are set apart by blanks, so what must be left can be read off them."""
    values = [" ".join(p) for p in parts]
    kept = [" ".join(w for w in p if w in ("word", "\u00e9t\u00e9", "1")) for p in parts]
    assert one(spark, values, tx.clean_text) == kept
    assert one(spark, kept, tx.clean_text) == kept


def link_characters(raw):
    """Walk the string: inside a link from its scheme to the next blank."""
    count, inside = 0, False
    for i, c in enumerate(raw):
        opens = raw.startswith("http://", i) or raw.startswith("https://", i)
        if not inside and opens and len(raw) > i + raw[i:].index("//") + 2 and raw[i + raw[i:].index("//") + 2] not in BLANKS:
            inside = True
        inside = inside and c not in BLANKS
        count += inside
    return count


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["x", "http://", "https://a", " ", "\t", "s://", "//"]), max_size=9), min_size=20, max_size=60))
def test_url_chars(spark, parts):
    values = ["".join(p) for p in parts]
    assert one(spark, values, tx.url_chars) == [link_characters(v) for v in values]


def test_spam_by_hand(spark):
    expected = {
        "123456789": True, "1234567890": False,  # nine and ten characters
        "0123456789 http://abc": False, "0123456789 http://abcd": False,  # 10 of 21, 11 of 22: exactly half is none
        "0123456789 http://abcde": True,  # 12 of 23
        "only five http://a": True,  # nine characters are left
        "@someone 123456789": True, "  1234567890  ": False, "": True,
    }
    assert one(spark, list(expected), lambda c: tx.is_spam(tx.clean_text(c), c)) == list(expected.values())


def test_safe_int_by_hand(spark):
    expected = {
        "": 0, "12": 12, " 12.9 ": 12, "-3.9": -3, "1e3": 1000, "abc": 0, "nan": 0, "inf": 0, "1d": 0, "1_000": 1000, "0x1p3": 0, "+7": 7,
        ".5": 0, "5.": 5, "1e": 0, "--1": 0, "9007199254740993": 9007199254740992, "1e30": 0, "\u00a012\u3000": 12, "1__0": 0, "_1": 0,
        "12 3": 0, "1e-2": 0, "1.5f": 0, "Infinity": 0, "-0": 0, "1e2.5": 0,
    }
    assert one(spark, [None, *expected], safe_int) == [0, *expected.values()]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(0, 999), st.integers(0, 6)), min_size=20, max_size=40))
def test_safe_int_reads_what_was_written(spark, numbers):
    whole = [str(n) for n, _, _ in numbers]
    assert one(spark, whole, safe_int) == [n for n, _, _ in numbers]
    assert one(spark, [f"{n}.{d:03d}" for n, d, _ in numbers], safe_int) == [n for n, _, _ in numbers]
    assert one(spark, [f"{n}e{e}" for n, _, e in numbers], safe_int) == [n * 10**e for n, _, e in numbers]
    assert set(one(spark, [f"{n}x{d}" for n, d, _ in numbers], safe_int)) == {0}


def test_anchor_hashtags_slang(spark):
    anchors = {'<a href="x">App for Phone</a>': "App for Phone", "plain": "plain", "<b></b><i>x</i>": "</b>", ">a\nb<c>d<": "d", "": ""}
    assert one(spark, list(anchors), tx.anchor_text) == list(anchors.values())
    assert one(spark, ["#Één two #b_2#c # d"], tx.hashtags) == [["Één", "b_2", "c"]]
    assert one(spark, ["Gw suka  bgt"], lambda c: tx.replace_slang(c, {"gw": "saya", "bgt": "banget"})) == ["saya suka  banget"]


def test_strip_is_unicode(spark):
    values = ["  x　", "\x1c y \x85", " a b "]
    assert one(spark, values, tx.strip) == [v.strip() for v in values]


def test_sql_tokens_equal_column_tokens(spark):
    values = [" Hair Oil ", "A\tB ", "x  y"]
    by_column = one(spark, values, tx.snake_token)
    by_sql = one(spark, values, lambda c: F.expr(tx.snake_token_sql("s")))
    assert by_column == by_sql == [v.strip().lower().replace(" ", "_") for v in values]
