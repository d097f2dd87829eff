import os
import random

import pytest

from postloom.llm import rollups

SCHEMA = "op string, seq int, doc_id long, source string, lang string, text string, docs int"


def slow(batches):
    state = {}
    for changes in batches:
        for op, _, doc, source, lang, text in sorted(changes, key=lambda c: (c[1], c[0])):
            if doc is None:
                continue
            if op == "delete":
                state.pop(doc, None)
            elif op in ("insert", "revise"):
                state[doc] = (source, lang, text)
    totals = {}
    for source, lang, text in state.values():
        body = (text or "").encode()
        for name, count in rollups.TOKENIZERS.items():
            n, t = totals.get((source, lang, name), (0, 0))
            totals[source, lang, name] = (n + 1, t + count([body])[0])
    return totals


def frame(spark, changes):
    return spark.createDataFrame([(*c, 1) for c in changes], SCHEMA)


def test_totals_follow_random_batches(spark, tmp_path):
    rng = random.Random(4)
    rollup, batches = rollups.TokenRollup(spark, str(tmp_path / "r")), []
    assert rollup.totals().count() == 0
    for b in range(4):
        changes = []
        for seq in range(25):
            op = rng.choice(["insert", "insert", "revise", "delete", "other"])
            text = rng.choice([None, "", "one", "two words", "l'été 漢字 <|endoftext|> " * rng.randrange(300)])
            changes.append((op, seq, rng.choice([None, *range(12)]), rng.choice([None, "a", "b"]), rng.choice([None, "en"]), text))
        batches.append(changes)
        assert rollup.apply(f"b{b}", frame(spark, changes))
        assert not rollup.apply(f"b{b}", frame(spark, [("insert", 0, 99, "x", "y", "never")]))
        got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}
        assert got == slow(batches)
    assert rollup.apply("none", frame(spark, [])) and len(rollup.batches()) == 5


def test_a_batch_that_died_leaves_no_trace(spark, tmp_path, monkeypatch):
    rollup = rollups.TokenRollup(spark, str(tmp_path / "r"))
    changes = frame(spark, [("insert", 0, 1, "a", "en", "x y"), ("insert", 0, 1, "a", "en", "x y")])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollups.TokenRollup, "_commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            rollup.apply("b", changes)
    assert rollup.totals().count() == 0 and rollup.batches() == {}
    assert rollup.apply("b", changes)
    # A second writer that got as far as its commit loses.
    assert not rollup._commit("b", "data/other")
    assert {(r.tokenizer, r.docs, r.tokens) for r in rollup.totals().collect()} == {("words-1", 1, 2), ("byte-bpe-50k-1", 1, 2)}
    assert os.listdir(tmp_path / "r" / "commits") and all(f.startswith((".", "b")) for f in os.listdir(tmp_path / "r" / "commits"))


def test_writers_that_start_from_one_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    one, two = rollups.TokenRollup(spark, root), rollups.TokenRollup(spark, root)
    assert one.apply("first", frame(spark, [("insert", 0, 1, "a", "en", "x"), ("insert", 0, 2, "a", "en", "y")]))
    commit, came = rollups.TokenRollup._commit, []

    def late(self, batch_id, *rest):
        if batch_id == "slow" and not came:
            came.append(two.apply("quick", frame(spark, [("revise", 0, 1, "a", "en", "p q"), ("delete", 0, 2, None, None, None)])))
        return commit(self, batch_id, *rest)

    monkeypatch.setattr(rollups.TokenRollup, "_commit", late)
    assert one.apply("slow", frame(spark, [("revise", 0, 1, "b", "en", "p q r"), ("revise", 0, 2, "b", "en", "s t")]))
    got = {(r.source, r.docs, r.tokens) for r in one.totals().filter("tokenizer = 'words-1'").collect()}
    assert came == [True] and got == {("b", 2, 5)} and set(one.batches()) == {"first", "quick", "slow"}


def test_folders_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rollups, "FAN", 2)
    rollup, batches = rollups.TokenRollup(spark, str(tmp_path / "r"), {"words-1": rollups.count_words}), []
    for b in range(5):
        batches.append([("revise", 0, b % 3, "a", "en", "w " * b), ("delete" if b == 3 else "insert", 1, 7, "a", "en", "z")])
        assert rollup.apply(f"b{b}", frame(spark, batches[-1]))
    assert [load["tier"] for load in rollup._current()[1]["loads"]] == [2, 0] and len(rollup.batches()) == 5
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}
    assert got == {k: v for k, v in slow(batches).items() if k[2] == "words-1"}
