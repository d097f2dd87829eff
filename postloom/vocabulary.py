"""Closed label vocabularies, their synonym maps and defaults.

A ``Vocabulary`` is plain configuration. Pass your own to label another domain; ``default_vocabulary()`` holds the
values existing label caches were produced with.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("intent", "sentiment", "cause", "product", "barrier", "aspect")

# A vocabulary becomes a literal in the plan; a table that exceeds this is joined instead, as a VocabularyTable.
MAX_ROWS = 5_000


def sql_string(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Vocabulary:
    """``values[field]`` lists the canonical values, ``synonyms[field]`` maps accepted spellings to one of them."""

    values: dict[str, tuple[str, ...]]
    synonyms: dict[str, dict[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    def mapping(self, name: str) -> dict[str, str]:
        known = {v: v for v in self.values[name]}
        return {**known, **self.synonyms.get(name, {})}

    def default(self, name: str) -> str:
        return self.defaults.get(name, "other")

    def canonical_sql(self, name: str, token: str) -> str:
        """SQL for the canonical value of an already cleaned token; the field's default when it is unknown or null."""
        pairs = ", ".join(f"{sql_string(k)}, {sql_string(v)}" for k, v in self.mapping(name).items())
        return f"coalesce(try_element_at(map({pairs}), {token}), {sql_string(self.default(name))})"

    def allows_sql(self, name: str, value: str) -> str:
        """SQL for whether a value is one of the canonical ones as it stands."""
        return f"{value} IN ({', '.join(sql_string(v) for v in self.values[name])})"

    def canonical(self, name: str, token: str) -> Column:
        return F.expr(self.canonical_sql(name, token))

    @classmethod
    def from_table(cls, df: DataFrame, defaults: dict[str, str] | None = None) -> "Vocabulary":
        """Build from a config table ``(field, raw_value, canonical_value)``; a canonical value maps to itself."""
        rows = df.select("field", "raw_value", "canonical_value").limit(MAX_ROWS + 1).collect()
        if len(rows) > MAX_ROWS:
            raise ValueError(f"more than {MAX_ROWS} rows are no literal; use VocabularyTable")
        values: dict[str, list[str]] = {f: [] for f in FIELDS}
        synonyms: dict[str, dict[str, str]] = {f: {} for f in FIELDS}
        for name, raw, canonical in rows:
            if canonical not in values[name]:
                values[name].append(canonical)
            if raw != canonical:
                synonyms[name][raw] = canonical
        return cls({k: tuple(v) for k, v in values.items()}, synonyms, defaults or {"sentiment": "neutral"})


@dataclass(frozen=True)
class VocabularyTable:
    """A vocabulary of any size: a config table ``(field, raw_value, canonical_value)`` that is joined, never collected.

    Accepted wherever a ``Vocabulary`` is. A canonical value maps to itself unless a row says otherwise; of several values
    for one spelling the greatest holds; rows with a null take no part.
    """

    rows: DataFrame
    defaults: dict[str, str] = field(default_factory=lambda: {"sentiment": "neutral"})

    # The SQL below reads a map column of the row, from ``field:token`` to the canonical value.
    def canonical_sql(self, name: str, token: str) -> str:
        key = f"concat({sql_string(name + ':')}, {token})"
        return f"coalesce(try_element_at(_canon, {key}), {sql_string(self.defaults.get(name, 'other'))})"

    def allows_sql(self, name: str, value: str) -> str:
        return f"try_element_at(_canon, concat({sql_string('=' + name + ':')}, {value})) IS NOT NULL"

    def entries(self) -> DataFrame:
        """``(key, value)`` for every ``field:spelling``, and for every canonical value as ``=field:value``."""
        rows = self.rows.select("field", "raw_value", "canonical_value").dropna()
        said = rows.filter("raw_value <> canonical_value").selectExpr(
            "concat(field, ':', raw_value) AS key", "canonical_value AS value", "1 AS rank")
        own = rows.selectExpr("concat(field, ':', canonical_value) AS key", "canonical_value AS value", "0 AS rank")
        exact = rows.selectExpr("concat('=', field, ':', canonical_value) AS key", "canonical_value AS value", "0 AS rank")
        best = said.unionByName(own).unionByName(exact).groupBy("key").agg(F.max(F.struct("rank", "value")).alias("_best"))
        return best.select("key", "_best.value")


class Tokens:
    """Stands for a vocabulary where the cleaned tokens themselves are wanted."""

    @staticmethod
    def canonical_sql(name: str, token: str) -> str:
        return token


def default_vocabulary() -> Vocabulary:
    # Cached answers and existing tables use exactly these labels, so they must stay as they are.
    values = {
        "intent": (
            "discovery", "complaining", "seeking_recommendation", "sharing_success", "sharing_failure",
            "asking_question", "venting", "other",
        ),
        "sentiment": ("positive", "negative", "neutral"),
        "cause": (
            "stress", "water_quality", "product_ingredient", "hormonal", "nutrition_deficiency", "genetics",
            "scalp_condition", "overprocessing", "medication", "seasonal", "age", "lifestyle", "other",
        ),
        "product": (
            "shampoo", "conditioner", "treatment_mask", "hair_oil", "hair_serum", "hair_tonic", "supplement",
            "medication", "natural_remedy", "professional_treatment", "other",
        ),
        "barrier": ("price", "side_effects", "ineffective", "lack_of_knowledge", "no_trust", "other"),
        "aspect": (
            "sensory", "usability", "hair_quality", "scalp_health", "effectiveness", "price_value", "availability",
            "other",
        ),
    }
    # Accepted spellings. Those that mean "other" are left out where the default already says so.
    synonyms = {
        "intent": {"recommendation": "seeking_recommendation"},
        "product": {
            "hair_lotion": "hair_tonic",
            "dry_shampoo": "shampoo",
            "hair_mask": "treatment_mask",
            "hair_vitamin": "supplement",
        },
        "cause": {"weather": "seasonal"},
    }
    return Vocabulary(values, synonyms, {"sentiment": "neutral"})
