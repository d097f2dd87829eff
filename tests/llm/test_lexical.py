import math
import random
import re
from collections import Counter

import pytest

from postloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id int, score string"
ITEMS = "item_id long, text string, doc_id int"


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, k):
    counted = [(d, Counter(words(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    out = []
    for item, some in asked.items():
        found = []
        for d, c, n in counted:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in some if c[t]
            )
            if score > 0:
                found.append((-score, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "naïve", "ABC", "abc", "x_y", "Ünï9"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(30)))) for i in range(200)]
    docs += [(i, "hot common text w1 w2 w3") for i in range(1000, 1100)]  # ties
    docs += [(2000, None), (2001, ""), (2002, " \t.,;"), (None, "w5 w6 w7"), (None, None), docs[3], docs[3], (-4, docs[3][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=12)) + ", and w1!") for i in range(15)]
    items += [(50, None), (51, ""), (52, "nowhere"), (None, "w1"), (3, "w9 extra"), (60, "w5 w6 w7"), (61, "hot"), (62, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("k,block_items,block_pairs,cells", [(10, 4096, 1 << 20, 1 << 20), (3, 4, 40, 64), (400, 1, 1, 500)])
def test_against_brute_force(spark, monkeypatch, k, block_items, block_pairs, cells):
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs, items = corpus(random.Random(k))
    d = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = lexical.search(d, q, k, block_items, block_pairs).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow(docs, items, k)


def test_long_text_and_empty_tables(spark):
    long = "a" * 300_000 + " rare " + "b c " * 100_000
    docs = [(1, long), (2, "rare"), (3, "other"), (4, "thing"), (5, "b")]
    d = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], DOCS)
    q = spark.createDataFrame([(7, "RARE b", 1)], ITEMS)
    assert sorted((tuple(r) for r in lexical.search(d, q).collect()), key=str) == slow(docs, [(7, "RARE b")], 10)
    assert lexical.search(d.limit(0), q).count() == 0
    assert lexical.search(d, q.limit(0)).count() == 0
