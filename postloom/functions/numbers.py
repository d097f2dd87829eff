"""Lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.functions.text import WS

DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = rf"^[{WS}]*[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?[{WS}]*\z"


def safe_int(c: Column) -> Column:
    """Whole part of a decimal string, toward zero; anything else, or beyond 64 bits, is 0.

    The pattern keeps out what the cast accepts but should not (``1d``, hexadecimal, ``Infinity``). Values pass through
    double precision on purpose: ``int(float(s))`` is the rule the stored counters follow.
    """
    plain = F.regexp_replace(c, rf"[_{WS}]", "")
    return F.coalesce(
        F.when(c.rlike(NUMBER), plain.try_cast("double").try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )
