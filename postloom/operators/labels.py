"""Normalising label responses into the closed vocabularies, and the gate that splits valid from dead rows.

Responses are strings of JSON. They are read as VARIANT because the gate must tell absent, null and wrongly typed
fields apart, which a declared schema would silently coerce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.evaluation import once
from postloom.functions.text import snake_token_sql, token_sql
from postloom.schemas import DEAD_LETTER
from postloom.session import materialize
from postloom.vocabulary import Tokens, Vocabulary, VocabularyTable, sql_string

LISTS = ("causes", "barriers", "aspects", "brands_raw")
LABEL_COLUMNS = ("intent", "sentiment", "causes", "products", "barriers", "aspects", "brands_raw")


def _get(v: str, name: str, kind: str = "string") -> str:
    return f"try_variant_get({v}, '$.{name}', '{kind}')"


def _kind(v: str) -> str:
    return f"schema_of_variant({v})"


def _is_string(item: str, name: str) -> str:
    return f"coalesce({_kind(_get(item, name, 'variant'))} = 'STRING', false)"


def _is_filled(item: str, name: str) -> str:
    return f"({_is_string(item, name)} AND coalesce({_get(item, name)}, '') <> '')"


def parse_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``_v`` (the response object, null if it is none) and the object items of each list field as ``_<list>``."""
    is_object = F.ltrim(F.col(response), F.lit(" \t\r\n")).startswith("{")
    df = once(df, _v=F.when(is_object, F.try_parse_json(F.col(response))))
    df = once(df, **{f"_{f}": F.expr(_get("_v", f, "array<variant>")) for f in (*LISTS, "products")})
    objects = {f"_{f}_objects": F.expr(f"filter(_{f}, e -> {_kind('e')} LIKE 'OBJECT%')") for f in LISTS}
    return once(df, **objects)


def drop_parsed(df: DataFrame) -> DataFrame:
    return df.drop("_v", "_products", *[f"_{f}" for f in LISTS], *[f"_{f}_objects" for f in LISTS])


def normalized_labels(vocab: Vocabulary | VocabularyTable | Tokens) -> dict[str, Column]:
    """Label columns over a parsed response. Unknown values take the field's default; duplicates are kept.

    Written as SQL text: dozens of small Column calls per lambda would make building the plan slower than small jobs.
    """

    def word(name: str, value: str, shape=snake_token_sql) -> str:
        return vocab.canonical_sql(name, shape(value))

    def items(name: str, *fields: str) -> Column:
        return F.expr(f"coalesce(transform(_{name}_objects, e -> named_struct({', '.join(fields)})), array())")

    product_type = (
        f"if(coalesce({_kind(_get('e', 'product_type', 'variant'))}, 'VOID') <> 'VOID', "
        f"{word('product', _get('e', 'product_type'))}, null)"
    )
    return {
        "intent": F.expr(word("intent", _get("_v", "intent"), token_sql)),
        "sentiment": F.expr(word("sentiment", _get("_v", "sentiment"), token_sql)),
        "causes": items(
            "causes",
            f"'cause_category', {word('cause', _get('e', 'cause_category'))}",
            f"'matched_sentence', coalesce({_get('e', 'matched_sentence')}, '')",
        ),
        "products": F.expr(
            f"coalesce(transform(_products, e -> {word('product', _get('e', '').replace('$.', '$'))}), array())"
        ),
        "barriers": items("barriers", f"'barrier_code', {word('barrier', _get('e', 'barrier_code'))}"),
        # An aspect's own sentiment is not normalised: the gate wants it exact.
        "aspects": items(
            "aspects",
            f"'aspect', {word('aspect', _get('e', 'aspect'))}",
            f"'sentiment', {_get('e', 'sentiment')}",
            f"'span_text', {_get('e', 'span_text')}",
        ),
        "brands_raw": items(
            "brands_raw", f"'brand_raw', {_get('e', 'brand_raw')}", f"'product_type', {product_type}"
        ),
    }


def gate_errors(vocab: Vocabulary | VocabularyTable) -> Column:
    """Codes of every rule a parsed response breaks; an empty array means valid. One bad item rejects the row."""

    def any_item(name: str, bad: str) -> str:
        return f"coalesce(exists(_{name}_objects, e -> {bad}), false)"

    allowed = vocab.allows_sql("sentiment", _get("e", "sentiment"))
    text = _get("e", "matched_sentence", "variant")
    checks = {"response:not_an_object": "_v IS NULL"}
    checks |= {f"{f}:not_a_list": f"{_get('_v', f, 'variant')} IS NOT NULL AND _{f} IS NULL" for f in LISTS}
    checks |= {
        "causes.matched_sentence:not_a_string": any_item(
            "causes", f"{text} IS NOT NULL AND NOT {_is_string('e', 'matched_sentence')}"
        ),
        "aspects.sentiment:not_allowed": any_item(
            "aspects",
            f"NOT ({_is_string('e', 'sentiment')} AND coalesce({allowed}, false))",
        ),
        "aspects.span_text:missing": any_item("aspects", f"NOT {_is_filled('e', 'span_text')}"),
        "brands_raw.brand_raw:missing": any_item("brands_raw", f"NOT {_is_filled('e', 'brand_raw')}"),
    }
    codes = ", ".join(f"if({cond}, {sql_string(code)}, null)" for code, cond in checks.items())
    return F.expr(f"array_compact(array({codes}))")


def with_entries(df: DataFrame, vocab: VocabularyTable, response: str = "response") -> DataFrame:
    """Add ``_canon``, the part of the vocabulary that a row's own tokens need, null or empty where none of them is known.

    The tokens of all fields meet the table in one join, and come back to their row by its number, which is written down
    first. A token that many rows share is a skewed key of a plain join, which adaptive execution splits. The planner
    guesses the size of what was grouped from its sources, far too low, and keeps a broadcast it once chose. So the table's
    entries are written down, plainly, as their size on disk then tells that in memory, and what comes back, a row per
    response, is merged.
    """
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "responses")
    found = drop_parsed(parse_response(rows.select("_row", F.col(response).alias("_said")), "_said").withColumns(normalized_labels(Tokens())))
    keys = [
        "array(concat('intent:', intent), concat('sentiment:', sentiment))",
        "transform(causes, e -> concat('cause:', e.cause_category))", "transform(products, e -> concat('product:', e))",
        "transform(barriers, e -> concat('barrier:', e.barrier_code))", "transform(aspects, e -> concat('aspect:', e.aspect))",
        "transform(aspects, e -> concat('=sentiment:', e.sentiment))",
        "transform(brands_raw, e -> concat('product:', e.product_type))",
    ]
    tokens = found.select("_row", F.explode(F.expr(f"array_compact(array_distinct(concat({', '.join(keys)})))")).alias("key"))
    entries = materialize(vocab.entries(), "entries", **{"compression": "none", "parquet.enable.dictionary": "false"})
    # An outer join, which can only broadcast the entries; unknown tokens are left out of the list.
    entry = F.when(F.col("value").isNotNull(), F.struct("key", "value"))
    known = tokens.join(entries, "key", "left").groupBy("_row").agg(F.map_from_entries(F.collect_list(entry)).alias("_canon"))
    return rows.join(known.hint("merge"), "_row", "left").drop("_row")


def normalize_labels(df: DataFrame, vocab: Vocabulary | VocabularyTable, response: str = "response") -> DataFrame:
    """Add the label columns and ``errors`` for the JSON in ``response``."""
    if isinstance(vocab, VocabularyTable):
        df = with_entries(df, vocab, response)
    parsed = once(parse_response(df, response), errors=gate_errors(vocab))
    return drop_parsed(parsed.withColumns(normalized_labels(vocab))).drop("_canon")


def require_model(df: DataFrame) -> DataFrame:
    """A stored answer must name its model; readers give an absent name a default, so null was stored as null."""
    missing = F.when(F.col("model").isNull(), F.array(F.lit("model:null"))).otherwise(F.array().cast("array<string>"))
    return df.withColumn("errors", F.concat("errors", missing))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") == 0).drop("errors")


def dead_letters(df: DataFrame, text_col: str = "full_text") -> DataFrame:
    """Rejected rows in the shape of the dead-letter log; the log shows the start of the text only."""
    cols = {
        "tweet_id": F.col("tweet_id"),
        "tweet_text": F.substring(text_col, 1, 200),
        "error": F.array_join("errors", "; "),
        "raw_response": F.col("response"),
        "failed_at": F.current_timestamp(),
    }
    order = [f.strip().split(" ")[0] for f in DEAD_LETTER.split(",")]
    return df.filter(F.size("errors") > 0).select(*[cols[c].alias(c) for c in order])


def response_json() -> Column:
    """The normalised labels as the JSON text the cache stores."""
    return F.to_json(F.struct(*LABEL_COLUMNS))
