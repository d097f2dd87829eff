"""Fields of the nested ``raw`` and ``media`` payloads, read from VARIANT.

A payload is JSON or a Python literal. JSON is parsed natively, and so are literals whose quotes can be read in one way
only; the rest crosses to Python, and only as strings.
"""

from __future__ import annotations

import ast
import json
import math
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.evaluation import once
from postloom.functions.numbers import safe_int
from postloom.functions.text import anchor_text, first_nonempty

# Payloads of this type hold the post one level down.
WRAPPER_TYPE = "TweetWithVisibilityResults"


def _plain(value):
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [_plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def _literal_json(text: str | None) -> str | None:
    if not text:
        return None
    try:
        value = ast.literal_eval(text)
    except Exception:  # the parser raises many kinds; all of them mean "not a literal"
        return None
    try:
        return json.dumps(_plain(value)).encode("utf-8").decode("utf-8")
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def python_literal_to_json(texts: pd.Series) -> pd.Series:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SyntaxWarning)  # backslashes in foreign text are not our syntax
        return texts.map(_literal_json)


# What may stand outside the strings of a literal that is rewritten: brackets, separators, blanks, plain whole numbers and
# the three names that JSON spells otherwise. Anything else (floats, prefixes, comments, other names) is left to Python.
PLAIN_OUTSIDE = r"None|True|False|(?<![0-9])[0-9]{1,15}(?![0-9])|[\s\[\]{}:,'-]"


def plain_literal_to_json(text: Column) -> Column:
    """JSON text of a Python literal whose strings are all in single quotes and free of backslashes, else null.

    Split at the single quotes, the pieces alternate between outside and inside of strings; a double quote outside would
    open a string of the other kind, so none may be there. A result that is no JSON after all (tuples, joined strings,
    trailing commas) is for Python to judge.
    """
    pieces = F.split(text, "'", -1)
    outside = F.array_join(F.filter(pieces, lambda _, i: i % 2 == 0), "'")
    plain = (
        ~text.contains("\\") & text.contains("'") & text.rlike(r"\A[\[{'0-9NTF-]") & (F.size(pieces) % 2 == 1)
        & (F.regexp_replace(outside, PLAIN_OUTSIDE, "") == "")
    )

    def spell(piece: Column, i: Column) -> Column:
        names = piece
        for python, other in (("None", "null"), ("True", "true"), ("False", "false")):
            names = F.replace(names, F.lit(python), F.lit(other))
        return F.when(i % 2 == 0, names).otherwise(F.replace(piece, F.lit('"'), F.lit('\\"')))

    return F.when(plain, F.array_join(F.transform(pieces, spell), '"'))


def _bracketed(text: Column) -> Column:
    """A JSON text parsed as the first of two array items. The parser stops after one value and ignores what follows,
    so a text is JSON only if the second item is where it should be."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(', "end"]')))


def _only_value(array: Column) -> Column:
    """The value that ``_bracketed`` parsed, null where the text was not exactly one."""
    end = _text(array, "$[1]") == "end"
    return F.when(end & F.try_variant_get(array, "$[2]", "variant").isNull(), F.try_variant_get(array, "$[0]", "variant"))


def with_payload(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add VARIANT column ``target`` parsed from string column ``source``; a wrapped post is unwrapped.

    A Python UDF runs for every row whatever ``when`` surrounds it, so rows that need no fallback hand it a null. The
    literal reading wins where the two readings of an escaped slash differ.
    """
    text = F.col(source)
    parsed, plain, literal = f"_{target}_json", f"_{target}_plain", f"_{target}_literal"
    wrapped = f"_{target}_whole"
    out = once(df, **{wrapped: _bracketed(text)})
    out = once(out, **{plain: _only_value(F.col(wrapped))}).drop(wrapped)
    out = once(out, **{wrapped: _bracketed(plain_literal_to_json(F.when(F.col(plain).isNull(), text)))})
    out = once(out, **{parsed: F.coalesce(F.col(plain), _only_value(F.col(wrapped)))}).drop(plain, wrapped)
    needs_python = (text != "") & (F.col(parsed).isNull() | text.contains("\\/"))
    out = out.withColumn(literal, python_literal_to_json(F.when(needs_python, text)))
    out = once(out, **{target: F.coalesce(F.try_parse_json(F.col(literal)), F.col(parsed))}).drop(parsed, literal)
    wrapped = F.coalesce(_text(F.col(target), "$.__typename") == WRAPPER_TYPE, F.lit(False))
    inner = F.try_variant_get(F.col(target), "$.tweet", "variant")
    return once(out, **{target: F.when(wrapped, inner).otherwise(F.col(target))})


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _json_kind(v: Column, path: str) -> Column:
    """Schema text of the value at ``path``; null when it is absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def post_fields(v: Column) -> Column:
    """Struct of counters and descriptive fields of a payload.

    ``followers_count`` is null when the payload has no author record, so the caller can fall back to the CSV.
    ``ok`` is false when a text field holds something that is no text, which rejects the row.
    """
    author = "$.core.user_results.result.legacy"
    has_author = F.coalesce(_json_kind(v, author).rlike("^OBJECT<[^>]"), F.lit(False))
    lang = _text(v, "$.legacy.lang")
    no_lang = lang.isNull() | lang.isin("", "0", "false")
    return F.struct(
        safe_int(_text(v, "$.views.count")).alias("view_count"),
        anchor_text(F.coalesce(_text(v, "$.source"), F.lit(""))).alias("source"),
        F.when(no_lang, F.lit("")).otherwise(lang).alias("lang"),
        F.coalesce(F.when(has_author, _text(v, author + ".location")), F.lit("")).alias("user_location"),
        F.when(has_author, safe_int(_text(v, author + ".followers_count"))).alias("followers_count"),
        (
            (~has_author | F.coalesce(_json_kind(v, author + ".location") == "STRING", F.lit(True)))
            & (no_lang | F.coalesce(_json_kind(v, "$.legacy.lang") == "STRING", F.lit(True)))
        ).alias("ok"),
    )


def author_fields(v: Column) -> Column:
    """Struct ``(screen_name, name)`` from the author's core, then its legacy record, then the post's legacy record."""
    result = "$.core.user_results.result"

    def pick(name: str) -> Column:
        return first_nonempty(
            _text(v, f"{result}.core.{name}"), _text(v, f"{result}.legacy.{name}"), _text(v, f"$.legacy.{name}")
        )

    return F.struct(pick("screen_name").alias("screen_name"), pick("name").alias("name"))


def image_links_json(v: Column) -> Column:
    """JSON text of the media payload's image list, ``', '`` between items; null when there is none."""
    links = F.try_variant_get(v, "$.image_links", "array<string>")
    quoted = F.transform(links, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.when(F.size(links) > 0, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))
