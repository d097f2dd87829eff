"""Tables on disk that change together: Parquet folders under one manifest.

A load writes its rows under a folder of its own and then one small manifest file that lists all loads, oldest first.
Readers follow the newest manifest, so all tables switch at once and a failed load leaves nothing visible. An id belongs
to the last load that has it: reading keeps the rows of that load only. Old rows are not touched by a load. When
``FAN`` loads of one tier have gathered at the end of the list they are merged into one of the next tier, so that a row
is rewritten about log(loads) times in all, and a read meets a few folders. A load may also remove ids, and keep a number
with itself: how far its writer has got in what it reads.

Manifest files are created, never replaced: of two writers that start from one version, the second fails and may load
again. Their folders never collide.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from postloom.schemas import STAR
from postloom.session import TEXTS, empty, materialize
from postloom.sources.files import create_file, list_files, read_text, remove_folder

FAN = 8


class Conflict(RuntimeError):
    """Another writer has published this version; load again."""


class TableStore:
    """Tables keyed by ``tweet_id``; ``schemas`` maps names to DDL, and ``parent`` names the table that has every id once.
    ``texts`` tells that the parent holds whole texts."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str], parent: str, texts: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas, self.parent, self.texts = schemas, parent, texts

    def _manifest(self, version: int) -> str:
        # Twenty digits: names sort like numbers.
        return f"{self.root}/_manifest/{version:020d}.json"

    def state(self, version: int | None = None) -> dict:
        """``version``, ``loads`` (``{folder, tier}``, oldest first, ``removed`` where a load removes ids) and ``mark``, the
        number kept with the last load that brought one; by default of the newest version. 0, [] and None before the first."""
        if version is None:
            found = list_files(self.spark, f"{self.root}/_manifest/*.json")
            path = found[-1] if found else None
        else:
            path = self._manifest(version) if version else None
        held = json.loads(read_text(self.spark, path)) if path else {"version": 0, "loads": []}
        return {"mark": None, **held}

    def current(self) -> tuple[int, list[dict]]:
        """(version, loads) of ``state``."""
        held = self.state()
        return held["version"], held["loads"]

    def _publish(self, version: int, loads: list[dict], mark: int | None) -> int:
        text = json.dumps({"version": version, "loads": loads, "mark": mark})
        if not create_file(self.spark, self._manifest(version), text):
            raise Conflict(f"version {version} of {self.root} exists")
        return version

    def _rows(self, table: str, loads: list[dict]) -> DataFrame:
        """All rows of some loads, with ``_load``, the place of their load in the list."""
        parts = [
            self.spark.read.schema(self.schemas[table]).parquet(f"{self.root}/{load['folder']}/{table}").withColumn("_load", F.lit(n))
            for n, load in enumerate(loads)
        ]
        return reduce(DataFrame.unionByName, parts)

    def _removed(self, loads: list[dict]) -> DataFrame | None:
        """``(tweet_id, _load)`` of the ids that loads remove."""
        parts = [
            self.spark.read.schema("tweet_id string").parquet(f"{self.root}/{load['folder']}/removed").withColumn("_load", F.lit(n))
            for n, load in enumerate(loads) if load.get("removed")
        ]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _last(self, loads: list[dict], ids: DataFrame | None = None) -> DataFrame:
        """``(tweet_id, _load)``: the last load that has or removes an id. Few columns of the parent decide."""
        rows, gone = self._rows(self.parent, loads).select("tweet_id", "_load"), self._removed(loads)
        rows = rows if gone is None else rows.unionByName(gone)
        rows = rows if ids is None else rows.join(ids.distinct(), "tweet_id")
        return rows.groupBy("tweet_id").agg(F.max("_load").alias("_load"))

    @staticmethod
    def _of_last(rows: DataFrame, last: DataFrame) -> DataFrame:
        """The rows of each id's last load. Not a semi-join: the optimizer would push it into the union of the loads and
        group the parent once for each of them."""
        last = last.withColumnRenamed("_load", "_last")
        return rows.join(last, "tweet_id").filter(F.col("_load") == F.col("_last")).drop("_last")

    def _replaced(self, loads: list[dict]) -> DataFrame | None:
        """``(tweet_id, _last)`` of the ids that more than one load has or removes, written down: it is what all rows of a
        table must meet, and where such ids are few it is broadcast and no row of a table is shuffled. Written plainly, as
        its size then tells that in memory. None where a single load tells all."""
        if len(loads) < 2:
            return None
        rows, gone = self._rows(self.parent, loads).select("tweet_id", "_load"), self._removed(loads)
        rows = rows if gone is None else rows.unionByName(gone)
        seen = rows.groupBy("tweet_id").agg(F.max("_load").alias("_last"), F.min("_load").alias("_first"))
        seen = seen.filter("_first < _last").drop("_first")
        return materialize(seen, "replaced", **{"compression": "none", "parquet.enable.dictionary": "false"})

    def _whole(self, table: str, loads: list[dict], replaced: DataFrame | None) -> DataFrame:
        """All rows of a table: of ids that several loads have those of the last one."""
        if not loads:
            return empty(self.spark, self.schemas[table])
        rows = self._rows(table, loads)
        columns = [c for c in rows.columns if c != "_load"]
        if replaced is not None:
            last = F.coalesce("_last", F.when(F.col("tweet_id").isNotNull(), F.col("_load")))
            rows = rows.join(replaced, "tweet_id", "left").filter(F.col("_load") == last)
        return rows.select(*columns)

    def _merged(self, table: str, loads: list[dict], ids: DataFrame | None = None) -> DataFrame:
        if ids is None:
            return self._whole(table, loads, self._replaced(loads))
        if not loads:
            return empty(self.spark, self.schemas[table])
        rows = self._rows(table, loads)
        columns = [c for c in rows.columns if c != "_load"]
        if len(loads) > 1:
            # An id's rows are those of its last load, in every table.
            # Written down plainly, as what is replaced: few ids are broadcast, and the other rows are not shuffled.
            last = materialize(self._last(loads, ids), "last", **{"compression": "none", "parquet.enable.dictionary": "false"})
            rows = self._of_last(rows, last)
        else:
            rows = rows.join(ids.distinct(), "tweet_id")
        return rows.select(*columns)

    def read(self, table: str, ids: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """One table as of now or as of a version; with ``ids`` (a column ``tweet_id``) the rows of these only, and others
        leave before anything is grouped."""
        ids = None if ids is None else ids.select("tweet_id")
        return self._merged(table, self.state(version)["loads"], ids)

    def changes(self, since: int, upto: int) -> DataFrame:
        """The parent's rows that version ``upto`` shows and version ``since`` does not show or shows with another value,
        with that one as the struct ``_before``, null for a new id. Ids that were removed are not listed.

        Reads what the loads in between wrote, and of older loads the rows of their ids. Opens a manifest per load in
        between. Version 0 is the empty store.
        """
        fresh, known = [], {load["folder"] for load in self.state(since)["loads"]}
        for version in range(since + 1, upto + 1) if since else ():
            # A load stands last; a merge of loads, which has a higher tier, brings nothing new.
            last = self.state(version)["loads"][-1:]
            fresh += [load for load in last if load["tier"] == 0 and load["folder"] not in known]
            known |= {load["folder"] for load in last}
        rows = self._merged(self.parent, fresh if since else self.state(upto)["loads"])
        columns = rows.columns
        before = self._merged(self.parent, self.state(since)["loads"], rows.select("tweet_id"))
        before = before.select("tweet_id", F.struct(*columns).alias("_before"))
        return rows.join(before, "tweet_id", "left").filter(~F.struct(*columns).eqNullSafe(F.col("_before")))

    def tables(self) -> dict[str, DataFrame]:
        loads = self.current()[1]
        replaced = self._replaced(loads)
        return {t: self._whole(t, loads, replaced) for t in self.schemas}

    def register_views(self) -> None:
        """Temporary views named like the tables, for plain SQL."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def new_load(self) -> str:
        """Name of a folder for a load whose parent is written before the load, to ``parent_path`` of it."""
        return f"load-{uuid.uuid4().hex}"

    def parent_path(self, folder: str) -> str:
        return f"{self.root}/{folder}/{self.parent}"

    def _options(self, table: str) -> dict[str, str]:
        return TEXTS if self.texts and table == self.parent else {}

    def _write(self, tables: dict[str, DataFrame], tier: int, removed: DataFrame | None = None, folder: str | None = None) -> dict:
        """Write a load; with ``folder``, in which the parent is already, the other tables."""
        parts = tables if removed is None else {**tables, "removed": removed.select("tweet_id")}
        if folder:
            parts = {t: df for t, df in parts.items() if t != self.parent}
        folder = folder or self.new_load()

        def write(table: str) -> None:
            parts[table].write.options(**self._options(table)).parquet(f"{self.root}/{folder}/{table}")

        # The jobs are independent; the cluster fills one's tail with the next one's tasks.
        with ThreadPoolExecutor(max_workers=max(1, len(parts))) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(write), parts))
        return {"folder": folder, "tier": tier, **({} if removed is None else {"removed": True})}

    def load(
        self, batch: dict[str, DataFrame], removed: DataFrame | None = None, mark: int | None = None, base: int | None = None,
        folder: str | None = None,
    ) -> int:
        """Upsert a batch of all tables with unique parent ids; returns the version that shows it.

        Loading the same batch again changes nothing that a reader sees. ``removed`` are ids, none of them in the batch,
        that disappear with it. ``mark`` is kept with the version. Where ``base`` is given and is not the current version,
        the batch was made from a state that is gone, and nothing is loaded: a Conflict. ``folder`` is that of ``new_load``
        where the batch's parent has been written there; else a batch is computed once, as it is written.
        """
        version, loads = self.current()
        held = self.state(version)
        if base is not None and base != version:
            raise Conflict(f"{self.root} is at version {version}, not {base}")
        mark = held["mark"] if mark is None else mark
        if removed is not None and removed.isEmpty():
            removed = None
        columns = {t: [c for c in self.spark.createDataFrame([], ddl).columns] for t, ddl in self.schemas.items()}
        made = self._write({t: batch[t].select(*columns[t]) for t in self.schemas}, 0, removed, folder)
        if removed is not None or not self._rows(self.parent, [made]).isEmpty():
            loads = [*loads, made]
        else:
            remove_folder(self.spark, f"{self.root}/{made['folder']}")
            if mark == held["mark"]:
                return version
        version = self._publish(version + 1, loads, mark)
        while len(loads) >= FAN and len({load["tier"] for load in loads[-FAN:]}) == 1:
            tail, older = loads[-FAN:], loads[:-FAN]
            # Rebalance packs the small files of many loads and splits large ones.
            replaced = self._replaced(tail)
            merged = {t: self._whole(t, tail, replaced).hint("rebalance") for t in self.schemas}
            gone = self._removed(tail) if older else None
            if gone is not None:
                # A removal still holds against older loads unless a later load of the tail has the id again.
                gone = self._of_last(gone, self._last(tail))
            loads = [*older, self._write(merged, tail[0]["tier"] + 1, gone)]
            version = self._publish(version + 1, loads, mark)
        return version


class StarStore(TableStore):
    """The six tables of the star schema."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, STAR, "tweets", texts=True)
