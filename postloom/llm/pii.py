"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

DataFrame functions only, one pass, no shuffle. A text is cut at the matches of a pattern, so that the gaps and the matches
give every match its place; the ends of the gaps are the words around it.

The patterns take time in proportion to the text whatever it holds: a run of characters is only tried from its first one
(or from where the last match ended) and never given back, which finds the same leftmost matches as the plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans that score less are not returned.
THRESHOLD = 0.5
#: What a checksum and a word nearby add to the score of a proposal.
CHECKED, NEARBY = 0.4, 0.3
#: Characters before and after a match in which words count, no further than the next match of its kind.
BEFORE, AFTER = 48, 24
#: Matches whose places are summed at a time.
CHUNK = 128

# The length of an account number by country (ISO 13616).
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 "
    "SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    size = F.length(digits)

    def add(total, i):
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        d = F.when((size - i) % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return total + d

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def mod97(body: Column) -> Column:
    """Whether an account number of capitals and digits, its first four moved to the end and letters read as 10 to 35,
    leaves 1 by 97."""
    plain = F.replace(body, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def step(rest, i):
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _iban_pattern() -> str:
    by_length: dict[int, list[str]] = {}
    for entry in IBAN_LENGTHS:
        by_length.setdefault(int(entry[2:]), []).append(entry[:2])
    kinds = [rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(by_length.items())]
    return rf"(?=[A-Z]{{2}}[0-9])(?<![A-Za-z0-9])(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_SIX = r"[\x20-]?[0-9]" * 6
_ALWAYS = lambda body: F.lit(True)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes at ``score``; ``valid`` must hold; a ``checksum``, where there is one, must hold too and adds to
    the score, as does one of ``words`` nearby. Texts without ``needs`` are not searched."""

    name: str
    pattern: str
    score: float
    valid: Callable[[Column], Column] = _ALWAYS
    checksum: Callable[[Column], Column] | None = None
    words: str = ""
    needs: str = ""


#: Kinds whose proposals need no word nearby.
BASE = (
    Kind(
        "email",
        r"[A-Za-z0-9._%+-](?:(?<![A-Za-z0-9._%+-]{2})|(?<=\G.))[A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.6,
        words="e-?mails?|mails?|contact|kontakt|correo|courriel|adresse?",
        needs="@",
    ),
    Kind(
        "ip",
        r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        0.5,
        valid=lambda body: body.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"),
        words="ip|host|server|address|adresse|client|login",
        needs=".",
    ),
    Kind(
        "card",
        r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
        0.3,
        checksum=lambda body: luhn(_digits(body)),
        words="card|credit|debit|visa|mastercard|amex|karte|kreditkarte|tarjeta|carte",
    ),
    Kind(
        "phone",
        r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9])",
        0.6,
        words="phone|tel|telephone|telefon|t[eé]l[eé]phone|tel[eé]fono|call|mobile|cell|fax|whatsapp|handy",
        needs="+",
    ),
)
#: Kinds that a checksum or a word nearby has to confirm; they never overlap a base span of digits.
MORE = (
    Kind("iban", _iban_pattern(), 0.3, checksum=mod97, words="iban|account|konto|cuenta|compte|bank"),
    Kind(  # a whole card number among other numbers, with which it makes too long a run of digits for a card
        "card_group",
        rf"[2-6](?:(?<=[0-9]{_SIX}\x20[2-6])[0-9]{{12,18}}+(?![0-9-])|(?<![0-9-][2-6])[0-9]{{12,18}}+(?![0-9-])(?=\x20[0-9]{_SIX}))",
        0.2,
        checksum=lambda body: luhn(body),
        words="card|credit|debit|visa|mastercard|amex|karte|kreditkarte|tarjeta|carte",
    ),
    Kind(
        "national_id",
        r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        valid=lambda body: ~body.rlike(r"\A(?:000|666|9)|-00-|0000\z"),
        words="ssn|social security|sozialversicherung|seguridad social|s[eé]curit[eé] sociale",
        needs="-",
    ),
    Kind(
        "local_phone",
        r"(?=[(0-9])(?<![0-9+(.-])(?<!\+[0-9]{1,3}\x20)(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,8}+"
        r"(?:[\x20.-][0-9]{2,8}+){0,2}(?!\x20?[0-9]|[.-][0-9])",
        0.3,
        valid=lambda body: F.length(_digits(body)).between(7, 12) & ~body.rlike(r"\A[0-9]+(?:\.[0-9]+){3}\z"),
        words="phone|tel|telephone|telefon|t[eé]l[eé]phone|tel[eé]fono|call|mobile|cell|fax|whatsapp|handy",
    ),
)


def _before(sizes: Column) -> Column:
    """Sum of the items before each item. Summed in chunks, as appending copies what is there."""
    zero = F.lit(0).cast("long")
    running = lambda items, first: F.aggregate(
        items, F.array(first), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
    )
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")), lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK))
    )
    starts = running(F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x)), zero)
    # The last running sum of a chunk is the first of the next.
    whole = F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, s: F.slice(running(c, s), 1, F.size(c)))
    return F.flatten(whole)


def _spans(kind: Kind, number: int) -> Column:
    """The confirmed spans of one kind from its columns ``found``, ``gaps`` and ``before``."""
    found, gaps, before = (F.col(f"{c}{number}") for c in ("found", "gaps", "before"))

    def span(body, i):
        start = F.get(before, i) + F.length(F.get(gaps, i))
        score = F.lit(kind.score)
        if kind.checksum:
            score = score + F.lit(CHECKED)
        if kind.words:
            around = F.concat(F.right(F.get(gaps, i), F.lit(BEFORE)), F.lit(" | "), F.left(F.get(gaps, i + 1), F.lit(AFTER)))
            score = score + F.when(F.lower(around).rlike(rf"(?<!\p{{L}})(?:{kind.words})(?!\p{{L}})"), NEARBY).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(body)).alias("end"),
            body.alias("text"),
            F.round(score, 2).alias("score"),
        )

    good = lambda body: kind.valid(body) & kind.checksum(body) if kind.checksum else kind.valid(body)
    return F.filter(F.transform(found, span), lambda s: (s["score"] >= THRESHOLD) & good(s["text"]))


def find(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + MORE) -> DataFrame:
    """Every row of ``docs(text, ...)``, all its columns as they are, with ``spans``: an array of ``(kind, start, end, text,
    score)`` by kind in the order given, then by start. Places are code points from 0, the end exclusive. A column named
    ``spans`` is replaced.

    Each kind is searched on its own, leftmost matches without overlap; a match that is not confirmed is dropped and not
    tried again in parts. Null and empty texts have no spans. Repeated rows stay repeated, doc_ids play no part, and no
    rows give no rows.
    """
    names = [c for c in docs.columns if c != "spans"]
    kept = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(kept.alias("row"), text.alias("body"))
    none = F.array().cast("array<string>")
    body = F.col("body")
    found = []
    for i, kind in enumerate(kinds):
        hits = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
        found.append((F.when(F.contains(body, F.lit(kind.needs)), hits).otherwise(none) if kind.needs else hits).alias(f"found{i}"))
    rows = rows.select("row", "body", *found)
    gaps = [F.when(F.size(f"found{i}") > 0, F.split(body, kind.pattern, -1)).alias(f"gaps{i}") for i, kind in enumerate(kinds)]
    rows = rows.select("row", *[f"found{i}" for i in range(len(kinds))], *gaps)
    sizes = lambda i: F.zip_with(
        F.slice(f"gaps{i}", 1, F.size(f"found{i}")), f"found{i}", lambda g, b: (F.length(g) + F.length(b)).cast("long")
    )
    places = [F.when(F.size(f"found{i}") > 0, _before(sizes(i))).alias(f"before{i}") for i in range(len(kinds))]
    rows = rows.select("*", *places)
    spans = reduce(F.concat, [_spans(kind, i) for i, kind in enumerate(kinds)])
    return rows.select("row", spans.alias("spans")).select(*[F.col(f"row.f{i}").alias(c) for i, c in enumerate(names)], "spans")
