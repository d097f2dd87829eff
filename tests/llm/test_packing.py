import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postloom.llm import packing, rollups, tokens
from postloom.llm.tokens import encoding

SCHEMA = "doc_id long, text string, length int, sequence_id string"


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(reference):
    rng = random.Random(1)
    texts = ["", " ", "don't  stop\n\n now", "<|endoftext|> é ñ 漢字 \U0001f600\x00\x1c　", "x" * 5000, "a b " * 3000]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), 10, 32])) for _ in range(300)) for _ in range(50)]
    for text in texts:
        assert encoding().encode_to_numpy(text, disallowed_special=()).tolist() == reference(text)


def slow_place(lengths, capacity):
    gaps, count = [], 0
    for n in lengths:
        best = None
        for i, g in enumerate(gaps):
            if g >= n:
                after = gaps[:i] + [g - n] + gaps[i + 1 :]
                cost = sum(after.count(h) ** 2 for h in set(after) if h)
                if best is None or (cost, g) < best[:2]:
                    best = (cost, g, i)
        if best:
            gaps[best[2]] -= n
        else:
            gaps.append(capacity - n)
            count += 1
    return count, sorted(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_placing_minimises_the_sum_of_squares(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randrange(1, 30) for _ in range(60)), reverse=True)
    numbers, offsets = packing.place(lengths, 30)
    fill = {}
    for n, number, offset in zip(lengths, numbers, offsets):
        assert offset == fill.get(number, 0)
        fill[number] = offset + n
    assert max(fill.values()) <= 30
    assert (len(fill), sorted(30 - f for f in fill.values())) == slow_place(lengths, 30)


def test_documents(spark, reference):
    rng = random.Random(2)
    words = [f"wo{i}rd" for i in range(200)]
    rows = [(d, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60, 400, 1500])))) for d in range(80)]
    rows += [(5, rows[5][1]), (None, "no id"), (900, None), (901, ""), (902, "y" * 50_000), (903, "é " * 2047), (904, "a" + " a" * 2046)]
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], SCHEMA)
    got = packing.pack_documents(docs, keep_ids=True).collect()
    want = []
    for d, t in rows:
        ids = reference(t or "") + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0] + list(range(first, len(ids), 2048)) + [len(ids)]
        want += [(str(d), i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 1


def test_several_groups(spark):
    rng = random.Random(3)
    pieces = spark.createDataFrame([(i, rng.randrange(1, 101), "x") for i in range(500)], "n long, length long, `a b` string")
    got = packing.pack(pieces, capacity=100, group=60)
    assert got.columns == ["n", "length", "a b", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted(r.n for r in rows) == list(range(500))
    assert len({(r.sequence_id, r.offset) for r in rows}) == 500
    used = len({r.sequence_id for r in rows})
    assert used <= sum(r.length for r in rows) / 100 * 1.12


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def unaltered():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


LITERALS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x\n<|endoftext|>", "  <|endoftext|>  ", "<|endoftext|", "<|ENDOFTEXT|>",
            "don't<|endoftext|>don't", "é<|endoftext|>漢字 \U0001f600", "", "plain"]


def test_added_token_is_that_of_the_unaltered_tokenizer(unaltered):
    rng = random.Random(4)
    texts = LITERALS + ["".join(rng.choice(["<|endoftext|>", " ", "\n", "word", "<|", "|>", "é", "end"]) for _ in range(60)) for _ in range(100)]
    for text in texts:
        assert tokens.ids(encoding(), text).tolist() == unaltered(text)
    assert rollups.count_bpe([t.encode() for t in texts]) == [len(unaltered(t)) for t in texts]


def test_documents_with_the_added_token(spark, unaltered):
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(LITERALS)], SCHEMA)
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(docs).collect()}
    want = {i: unaltered(t) + [0] for i, t in enumerate(LITERALS)}
    assert got == {i: (len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, v in want.items()}
