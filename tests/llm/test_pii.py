import hashlib
import os
import random
import re

import pytest

import __spark_entry__ as driver
from postloom.llm import pii

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row int, body string, spans string, found0 int"

# The patterns of the contract, as they are written there.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()]
    doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base(text):
    """Spans by the plain patterns."""
    text = text or ""
    count = lambda m: sum(c.isdigit() for c in m.group())
    out = [("email", m) for m in EMAIL.finditer(text if "@" in text else "")]
    out += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 13 <= count(m) <= 19 and luhn(m.group())]
    out += [("phone", m) for m in PHONE.finditer(text) if 9 <= count(m) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in out]


def ibans(text):
    """Account numbers, by trying every place."""
    out, at = [], 0
    length = {e[:2]: int(e[2:]) for e in pii.IBAN_LENGTHS}
    while at < len(text):
        want, i, got = length.get(text[at : at + 2], 0), at, ""
        if want and not (at and text[at - 1].isascii() and text[at - 1].isalnum()):
            while i < len(text) and len(got) < want:
                step = 2 if text[i] == " " and 4 <= len(got) else 1
                c = text[i + step - 1 : i + step]
                if not re.fullmatch("[A-Z0-9]" if len(got) >= 4 else "[0-9]" if len(got) >= 2 else "[A-Z]", c):
                    break
                got, i = got + c, i + step
            if len(got) == want and not re.match("[A-Za-z0-9]", text[i : i + 1]):
                if int("".join(str(int(c, 36)) for c in got[4:] + got[:4])) % 97 == 1:
                    out.append(("iban", at, i))
                at = i
                continue
        at += 1
    return out


def found(spark, texts):
    rows = pii.find(spark.createDataFrame([(i, t, 1, "b", "s", 2) for i, t in enumerate(texts)], DOCS).repartition(3))
    assert rows.columns == ["doc_id", "text", "row", "body", "found0", "spans"]
    out = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(texts):
        assert (out[i].text, out[i].row, out[i].body, out[i].found0) == (t, 1, "b", 2)
        assert all(s.text == (t or "")[s.start : s.end] and s.score >= pii.THRESHOLD for s in out[i].spans)
    return [[(s.kind, s.start, s.end) for s in out[i].spans] for i in range(len(texts))]


BASE = [k.name for k in pii.BASE]


def test_against_the_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["1", "23", "456", "7890", " ", "  ", "-", ".", "..", "+", "+1", "(", ")", "a", "Bc", "@", "x@y", ".com", "%", "_", "é", "😀", "\n",
             "4539 1488 0343 6467", "4539148803436467", "255.", "256.", "1.2.3.4", "+49 30 ", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(1500)]
    digits = ["".join(rng.choices("0123456789 -", weights=[3] * 10 + [4, 4], k=rng.randrange(10, 60))) for _ in range(800)]
    signs = ["+1" + "".join(rng.choices("0123456789().- +", k=rng.randrange(3, 40))) for _ in range(500)]
    mails = ["".join(rng.choices("ab.@_-", k=rng.randrange(3, 30))) for _ in range(800)]
    quads = ["".join(rng.choices(["1", "25", "255", "300", ".", ".", ".", "0255"], k=rng.randrange(5, 25))) for _ in range(800)]
    texts += [*digits, *signs, *mails, *quads, None, ""]
    got = found(spark, texts)
    assert [[s for s in g if s[0] in BASE] for g in got] == [base(t) for t in texts]
    assert [[s for s in g if s[0] == "iban"] for g in got] == [ibans(t or "") for t in texts]


def test_confirmed_and_unconfirmed(spark):
    cases = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC": [("iban", "DE89 3704 0044 0532 0130 00")],
        "DE88 3704 0044 0532 0130 00": [],  # a wrong check number
        "her ssn 078-05-1120": [("national_id", "078-05-1120")],
        "part 078-05-1120": [],
        "ssn 000-05-1120": [],
        "Telefon: 030 1234567": [("local_phone", "030 1234567")],
        "in all 030 1234567": [],
        "tel 10.20.30.40": [("ip", "10.20.30.40")],
        "7536784127813050 4539148803436467 x": [("card_group", "4539148803436467")],
        "4539148803436467 7536784127813050": [("card_group", "4539148803436467")],
        "4539148803436468": [],
        "mail a@b.c_d@e.f": [("email", "a@b.c"), ("email", "_d@e.f")],
        "nothing at all, 12 of 345": [],
    }
    got = found(spark, list(cases))
    assert [[(k, t[a:b]) for k, a, b in g] for t, g in zip(cases, got)] == list(cases.values())


def test_words_nearby_raise_the_score(spark):
    rows = spark.createDataFrame([(1, "write a mail to joe@x.org"), (2, "see joe@x.org"), (3, "a thailmail joe@x.org")], "doc_id long, text string")
    assert {r.doc_id: r.spans[0].score for r in pii.find(rows).collect()} == {1: 0.9, 2: 0.6, 3: 0.6}


def test_long_texts_take_time_in_proportion(spark):
    texts = ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "+1" + "(" * 400_000, "1." * 200_000, "a@" * 200_000, "a.b@c" * 100_000]
    texts += ["joe@x.org 1.2.3.4 " * 5_000, "DE89 " * 50_000]
    got = found(spark, texts)
    assert [[s for s in g if s[0] in BASE] for g in got] == [base(t) if i not in (0, 1) else [] for i, t in enumerate(texts)]


def test_empty_table_and_plan(spark, plan, tmp_path):
    assert pii.find(spark.createDataFrame([], DOCS)).count() == 0
    spark.range(50).selectExpr("id AS doc_id", "'a' AS text").write.parquet(str(tmp_path / "d"))
    text = plan(pii.find(spark.read.parquet(str(tmp_path / "d"))))
    assert not re.search("Python|Arrow|Pandas|ExistingRDD|MapPartitions|Exchange", text)
    assert text.count("regexp_extract_all(") == len(pii.BASE + pii.MORE) == text.count("split(")  # each text is read once per kind


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_registered_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = driver.queries()["op12_pii"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spans = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in BASE]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined or r.spans.startswith(joined + "," if joined else "")
