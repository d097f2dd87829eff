"""Token count rollups, maintained by signed deltas.

A batch of changes (inserts, deletes, revisions) is turned into signed rows: minus what a document counted before, plus
what it counts now, per source, language and tokenizer version. Totals are sums of these rows and never need the
documents again. A batch writes its rows under a folder of its own and becomes visible when a marker file with its id
is created, which fails where one exists: a batch that is applied again changes nothing, of two writers one wins, and a
batch that died half-way left no trace that a reader would see.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.llm import tokens
from postloom.llm.common import arrow_map, utf8
from postloom.sources.files import create_file, list_files, read_text

LOG = "doc_id long, source string, lang string, tokenizer string, docs int, tokens long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
KEYS = ("source", "lang", "tokenizer")
FAN = 8


def count_words(texts: Sequence[bytes]) -> list[int]:
    return [len(t.split()) for t in texts]


def count_bpe(texts: Sequence[bytes], vocabulary: str | None = None) -> list[int]:
    encoder = tokens.encoding(vocabulary)
    return [len(tokens.ids(encoder, t.decode())) for t in texts]


#: Tokenizer versions by name. A changed tokenizer is a new name, never another meaning of an old one.
TOKENIZERS: dict[str, Callable[[Sequence[bytes]], list[int]]] = {"words-1": count_words, "byte-bpe-50k-1": count_bpe}


def _counted(batches, tokenizers):
    passed = ("doc_id", "source", "lang")
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        for name, count in tokenizers.items():
            columns = {c: batch.column(c) for c in passed}
            yield columns | {"tokenizer": [name] * len(texts), "docs": [1] * len(texts), "tokens": count(texts)}


def counted(docs: DataFrame, tokenizers=TOKENIZERS) -> DataFrame:
    """A log row of +1 document and its tokens for every row of ``docs(doc_id, source, lang, text)`` and tokenizer."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", utf8(F.col("text")).alias("text"))
    return arrow_map(source, partial(_counted, tokenizers=tokenizers), LOG)


class TokenRollup:
    """Totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, tokenizers=TOKENIZERS):
        self.spark, self.root, self.tokenizers = spark, root.rstrip("/"), tokenizers

    def _current(self) -> tuple[int, dict]:
        """Version, and the state: folder of every batch by its id, and the folders to read with their tiers."""
        found = list_files(self.spark, f"{self.root}/commits/batch-*.json")
        if not found:
            return 0, {"batches": {}, "loads": []}
        state = json.loads(read_text(self.spark, found[-1]))
        return state["version"], state

    def _publish(self, version: int, batches: dict[str, str], loads: list[dict]) -> bool:
        # Twenty digits: names sort like numbers.
        text = json.dumps({"version": version, "batches": batches, "loads": loads})
        return create_file(self.spark, f"{self.root}/commits/batch-{version:020d}.json", text)

    def batches(self) -> dict[str, str]:
        """Folder of every committed batch by its id."""
        return self._current()[1]["batches"]

    def _commit(self, batch_id: str, folder: str, version: int | None = None) -> bool:
        """False where the batch is committed, or the state is not of ``version`` any more."""
        now, state = self._current()
        if batch_id in state["batches"] or version not in (None, now):
            return False
        return self._publish(now + 1, state["batches"] | {batch_id: folder}, [*state["loads"], {"folder": folder, "tier": 0}])

    def _read(self, kind: str, schema: str, loads: list[dict]) -> DataFrame:
        paths = [f"{self.root}/{load['folder']}/{kind}" for load in loads]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, folder: str, log: DataFrame) -> None:
        log.write.parquet(f"{self.root}/{folder}/log")
        sums = self.spark.read.schema(LOG).parquet(f"{self.root}/{folder}/log").groupBy(*KEYS)
        sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(f"{self.root}/{folder}/totals")

    def _merge_tiers(self) -> None:
        """Merge the last folders of one tier, as long as there are enough; a writer that comes between is left to it."""
        while True:
            version, state = self._current()
            tail = state["loads"][-FAN:]
            if len(tail) < FAN or len({load["tier"] for load in tail}) > 1:
                return
            net = self._read("log", LOG, tail).groupBy("doc_id", *KEYS)
            net = net.agg(F.sum("docs").cast("int").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")
            folder = f"data/merged-{uuid.uuid4().hex}"
            self._write(folder, net)
            loads = [*state["loads"][:-FAN], {"folder": folder, "tier": tail[0]["tier"] + 1}]
            if not self._publish(version + 1, state["batches"], loads):
                return

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply ``changes(op, seq, doc_id, source, lang, text)`` as batch ``batch_id`` (letters, digits, ``-``, ``_``);
        False where that batch is committed already.

        ``op`` is insert, revise or delete; insert and revise both set what the document is now, so an insert of a known
        document revises it and a revision of an unknown one inserts it. A delete of an unknown document, a row without
        doc_id and any other op change nothing. Of several changes of one document the one with the highest ``seq`` holds
        (then the op that sorts last, then the greatest source, lang and text). Null source and lang are keys of their
        own; null text has no token.
        """
        named = changes.select("op", "seq", F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text").filter(
            "doc_id is not null and op in ('insert', 'revise', 'delete')"
        )
        final = Window.partitionBy("doc_id").orderBy(*[F.col(c).desc() for c in ("seq", "op", "source", "lang", "text")])
        latest = named.withColumn("_nth", F.row_number().over(final)).filter("_nth = 1").drop("_nth", "seq")
        new = counted(latest.filter("op <> 'delete'"), self.tokenizers)
        while True:
            version, state = self._current()
            if batch_id in state["batches"]:
                return False
            folder = f"data/{batch_id}-{uuid.uuid4().hex}"
            self._write(folder, new.unionByName(self._gone(named, state["loads"])))
            if self._commit(batch_id, folder, version):
                self._merge_tiers()
                return True
            time.sleep(1)  # the other writer may not have finished its state file

    def _gone(self, named: DataFrame, loads: list[dict]) -> DataFrame:
        """What the documents of a batch count so far, with the sign turned."""
        old = self._read("log", LOG, loads)
        net = old.join(named.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id", *KEYS)
        net = net.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0")
        return net.select("doc_id", *KEYS, (-F.col("docs")).cast("int").alias("docs"), (-F.col("tokens")).alias("tokens"))

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)`` over all committed batches: a few rows from each folder, summed. Keys
        without a document left do not occur."""
        sums = self._read("totals", TOTALS, self._current()[1]["loads"]).groupBy(*KEYS)
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0")
