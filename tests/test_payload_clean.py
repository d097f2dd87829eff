import ast
import json
import random
import warnings

from pyspark.sql import functions as F

from postloom.functions.payload import (
    _bracketed,
    _only_value,
    author_fields,
    image_links_json,
    plain_literal_to_json,
    post_fields,
    with_payload,
)
from postloom.operators import clean
from postloom.operators.ingest import backfill_authors
from postloom.schemas import MERGED_COLUMNS

POST = {
    "views": {"count": "12"},
    "source": '<a href="x">App</a>',
    "legacy": {"lang": "id", "screen_name": "top"},
    "core": {"user_results": {"result": {"legacy": {"location": "Bandung", "followers_count": 0, "name": "Old"},
                                         "core": {"screen_name": "handle", "name": ""}}}},
}


def fields(spark, raws, fn=post_fields):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    out = with_payload(df, "raw", "v").orderBy("i").select(fn(F.col("v")).alias("p"))
    return [r.p.asDict() if hasattr(r.p, "asDict") else r.p for r in out.collect()]


def test_json_literal_and_wrapped_agree(spark):
    wrapped = {"__typename": "TweetWithVisibilityResults", "tweet": POST}
    a, b, c, d = fields(spark, [json.dumps(POST), repr(POST), json.dumps(wrapped), repr({**wrapped, "ok": True, "no": None})])
    assert a == b == c == d
    assert a == {"view_count": 12, "source": "App", "lang": "id", "user_location": "Bandung", "followers_count": 0, "ok": True}


def test_odd_payloads(spark):
    no_author = json.dumps({"source": "web"})
    rows = fields(spark, ["", None, "[1, 2]", "not a payload {", '{"legacy": null}', no_author,
                          '{"core": {"user_results": {"result": {"legacy": {}}}}}',
                          '{"core": {"user_results": {"result": {"legacy": {"x": 1}}}}}',
                          '{"core": {"user_results": {"result": {"legacy": {"location": null}}}}}',
                          '{"legacy": {"lang": 5}}', "{'views': {'count': float('x')}}", '{"a": 1, "a": 2, "views": {"count": 3.7}}'])
    assert [r["followers_count"] for r in rows] == [None] * 7 + [0, 0] + [None] * 3
    assert [r["ok"] for r in rows] == [True] * 8 + [False, False, True, True]
    assert rows[5]["source"] == "web" and rows[11]["view_count"] == 3


def test_escaped_slash_follows_the_literal_reading(spark):
    text = '{"source": "<a>x\\/y</a>"}'
    import ast

    assert fields(spark, [text])[0]["source"] == ast.literal_eval(text)["source"][3:-4]


def test_author_and_images(spark):
    [a] = fields(spark, [json.dumps(POST)], author_fields)
    assert a == {"screen_name": "handle", "name": "Old"}
    links = {"image_links": ["http://a/b", 'q"uote']}
    assert fields(spark, [repr(links), '{"image_links": []}', ""], image_links_json) == [json.dumps(links["image_links"]), None, None]


def merged(spark, rows):
    data = [tuple(r.get(c, "") for c in MERGED_COLUMNS) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in MERGED_COLUMNS) + ", row_ord bigint")


def test_backfill_chain(spark):
    rows = [
        {"user_username": "u"}, {"user_screen_name": "s"}, {"raw": json.dumps(POST)},
        {"user_username": "u", "raw": json.dumps(POST)}, {"user_displayname": "d"}, {"image_links": "[]", "media": "{'image_links': ['i']}"},
        {"image_links": "set", "media": "{'image_links': ['i']}"}, {},
    ]
    got = [tuple(r) for r in backfill_authors(merged(spark, rows)).orderBy("row_ord").select(
        "user_screen_name", "user_username", "user_name", "user_displayname", "image_links").collect()]
    assert got == [
        ("u", "u", "", "", "[]"), ("s", "s", "", "", "[]"), ("handle", "handle", "Old", "Old", "[]"),
        ("handle", "u", "Old", "Old", "[]"), ("", "", "d", "d", "[]"), ("", "", "", "", '["i"]'), ("", "", "", "", "set"),
        ("", "", "", "", "[]"),
    ]


def test_clean_posts(spark):
    rows = [
        {"tweet_id": " 1 ", "text": "hello https://x.y wide world", "likes": "3", "retweets": "x", "comments": "2.9",
         "user_screen_name": "", "user_username": " u ", "user_followers": "7", "timestamp": " t "},
        {"tweet_id": "2", "text": "", "embedded_text": "fallback text here"},
        {"tweet_id": "3", "text": "  ", "embedded_text": "not used"},
        {"tweet_id": "", "text": "no id at all here"},
        {"tweet_id": "5", "text": "@only http://x.y"},
        {"tweet_id": "6", "text": "short"},
        {"tweet_id": "7", "text": "payload wins over csv", "user_followers": "7", "raw": json.dumps(POST)},
        {"tweet_id": "8", "text": "location is null here", "raw": '{"core": {"user_results": {"result": {"legacy": {"location": null}}}}}'},
    ]
    out = clean.clean_posts(merged(spark, rows), "row_ord").orderBy("row_ord").collect()
    assert [r.accepted for r in out] == [True, True, False, False, False, True, True, False]
    first = out[0]
    assert (first.tweet_id, first.full_text, first.screen_name, first.created_at) == ("1", "hello wide world", "u", "t")
    assert (first.like_count, first.retweet_count, first.reply_count, first.followers_count) == (3, 0, 2, 7)
    assert out[1].full_text == "fallback text here"
    assert [r.is_spam for r in out if r.accepted] == [False, False, True, False]
    assert out[6].followers_count == 0 and out[6].user_location == "Bandung"
    assert clean.without_spam(clean.accepted_posts(clean.clean_posts(merged(spark, rows)))).count() == 3


def test_costly_columns_are_computed_once(spark, plan):
    """Filters must not copy the parse or the regular expressions below them."""
    kept = clean.without_spam(clean.accepted_posts(clean.clean_posts(merged(spark, [{"tweet_id": "1", "text": "x"}]))))
    text = plan(kept)
    assert text.count("ArrowEvalPython") == 1
    assert sum("parseJson" in line for line in text.splitlines()) == 3  # the JSON, and the literal rewritten natively or converted


def test_repeated_text_and_posters(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "y"), (5, "c", None)], "i int, who string, t string")
    flagged = {r.i: r.is_repeated for r in clean.flag_repeated_text(df, "t", 2).collect()}
    assert flagged == {1: True, 2: True, 3: True, 4: False, 5: False}
    posters = {r.i: r.rep for r in clean.flag_repeat_posters(df, "who", "t", 1, "rep").collect()}
    assert posters == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_keyword_spec(spark):
    spec = clean.KeywordSpec("Rambut Rontok", ("dove", "clear"), ("shop",), "id", "2024-01-01", "2024-01-02")
    assert spec.query() == "Rambut Rontok (dove OR clear) -shop lang:id"
    df = spark.createDataFrame(
        [(1, "RONTOK rambut dove", "id", "2024-01-01"), (2, "rambut rontok", "id", "2024-01-01"),
         (3, "rambut rontok dove shopping", "id", "2024-01-01"), (4, "rambut rontok clear", "en", "2024-01-01"),
         (5, "rambut rontok clear", "id", "2024-01-02")], "i int, t string, l string, d string",
    ).withColumn("d", F.col("d").cast("timestamp_ntz"))
    assert [r.i for r in clean.keyword_filter(df, spec, "t", "l", "d").collect()] == [1]


def random_literal(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 3:
        return "".join(rng.choice(['a', 'é', ' ', ':', '{', ']', ',', 'None', '1', '"', '#', "'", "\\", "\n", "\t", "漢"]) for _ in range(rng.randrange(6)))
    if kind == 3:
        return rng.choice([None, True, False])
    if kind == 4:
        return rng.choice([0, 7, -3, 10**12, 123456789012345678901, 1.5, 1e300, -0.0])
    if kind == 5:
        return rng.choice([(), (1,), [], {}])
    if kind < 8:
        return {rng.choice(["k", "views", "a b", 'q"']): random_literal(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [random_literal(rng, depth + 1) for _ in range(rng.randrange(4))]


def test_plain_literals_read_like_python(spark):
    """Whatever the native step reads as JSON must be what Python reads; damaged literals included."""
    rng = random.Random(5)
    texts = [repr(random_literal(rng)) for _ in range(1500)]
    for t in list(texts[:700]):
        i = rng.randrange(len(t) + 1)
        texts.append(t[:i] + rng.choice(["'", '"', ",", " ", "b", "'x' ", "null", "None", "0", "_", ".", "1e5", "#", "\n", "(", "\x0c"]) + t[i:])
    texts += ["{'a': null}", "'a' 'b'", "b'x'", "'''x'''", "{'a': 01}", "{'a': 1_0}", "\n{'a': 1}", " {'a': 1}", "{'a': None,}", "{'a': NaN}", "['a'\n]",
              "{'a': True, 'a': 2}", "NoneTrue", "['None', None]", "{'x': 'say \"hi\"'}", "{None: 'a'}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    native = F.to_json(_only_value(F.col("v")))
    parsed = df.withColumn("v", _bracketed(plain_literal_to_json(F.col("t"))))
    got = {r.i: r.j for r in parsed.select("i", native.alias("j")).collect()}
    read = 0
    for i, text in enumerate(texts):
        if got[i] is None:
            continue
        read += 1
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            assert json.loads(got[i]) == ast.literal_eval(text), text
    assert read > 300
    # An ordinary payload does not reach Python.
    assert fields(spark, [repr(POST)], fn=lambda v: v.isNotNull().alias("x")) == [True]
    payload = spark.createDataFrame([(repr(POST),)], "t string").withColumn("v", _bracketed(plain_literal_to_json(F.col("t"))))
    assert payload.filter(native.isNotNull()).count() == 1


def test_json_with_something_after_it_is_no_json(spark):
    texts = ['{"a": 1} junk', '{"a": 1}, {"b": 2}', '{"a": 1}]', "1", '[1]][[2]', ' {"a": 1}\n', '1, "end"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", _bracketed(F.col("t")))
    got = [r[0] for r in df.orderBy("i").select(F.to_json(_only_value(F.col("v")))).collect()]
    assert got == [None, None, None, "1", None, '{"a":1}', None]
