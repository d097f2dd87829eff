"""Text cleaning as column expressions.

Java's ``\\s`` and ``\\w`` are ASCII, so the Unicode classes are spelt out. Each pattern is guarded by a plain substring
test: most rows have no link and no mention, and a byte search is far cheaper than a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

URL = rf"https?://[^{WS}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#([{WORD}]+)"


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends (``trim`` alone knows only U+0020)."""
    return F.regexp_replace(c, rf"^[{WS}]+|[{WS}]+\z", "")


def token_sql(c: str) -> str:
    """SQL of ``token`` for use inside lambda expressions."""
    return f"lower(regexp_replace({c}, r'^[{WS}]+|[{WS}]+\\z', ''))"


def snake_token_sql(c: str) -> str:
    """SQL of ``snake_token``."""
    return f"replace({token_sql(c)}, ' ', '_')"


def is_blank(c: Column) -> Column:
    return F.coalesce(~c.rlike(rf"[^{WS}]"), F.lit(True))


def strip_urls(c: Column) -> Column:
    return F.when(c.contains("://"), F.regexp_replace(c, URL, "")).otherwise(c)


def strip_mentions(c: Column) -> Column:
    return F.when(c.contains("@"), F.regexp_replace(c, MENTION, "")).otherwise(c)


def squeeze_whitespace(c: Column) -> Column:
    """Runs of white space become one space, ends are trimmed; single plain spaces are left alone."""
    return F.trim(F.regexp_replace(c, rf"[{WS}]{{2,}}|[{WS}&&[^ ]]", " "))


def clean_text(c: Column) -> Column:
    """Links, then mentions, then white space; null gives an empty string."""
    raw = F.coalesce(c, F.lit(""))
    unlinked = strip_urls(raw)
    # Tested on the raw text: a test on the result of the previous step would compute that step twice.
    return squeeze_whitespace(F.when(raw.contains("@"), F.regexp_replace(unlinked, MENTION, "")).otherwise(unlinked))


def url_chars(c: Column) -> Column:
    """Number of characters that belong to links."""
    return F.when(c.contains("://"), F.length(c) - F.length(F.regexp_replace(c, URL, ""))).otherwise(F.lit(0))


def is_spam(clean: Column, raw: Column, min_chars: int = 10) -> Column:
    """Too short once cleaned, or more than half of the raw text is links."""
    return (F.length(clean) < min_chars) | (2 * url_chars(raw) > F.length(raw))


def anchor_text(c: Column) -> Column:
    """Inner text of the first tag pair, else the string itself; ``.`` stops at a newline only, hence ``(?d)``."""
    pattern = r"(?d)>(.+?)<"
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c)


def token(c: Column) -> Column:
    """Label token: stripped, lower case."""
    return F.lower(strip(c))


def snake_token(c: Column) -> Column:
    """Label token with spaces as underscores."""
    return F.replace(token(c), F.lit(" "), F.lit("_"))


def hashtags(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(HASHTAG), F.lit(1))


def replace_slang(c: Column, slang: dict[str, str]) -> Column:
    """Replace space-separated words found in a small slang map (its keys are lower case)."""
    pairs = [F.lit(x) for kv in slang.items() for x in kv]
    if not pairs:
        return c
    table = F.create_map(*pairs)
    words = F.transform(F.split(c, " ", -1), lambda w: F.coalesce(F.try_element_at(table, F.lower(w)), w))
    return F.array_join(words, " ")


def first_nonempty(*cols: Column) -> Column:
    """First value that is neither null nor empty, else an empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))
