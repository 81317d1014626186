"""Written tables that cut lineage between the stages of a plan."""

from __future__ import annotations

import copy
import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linkrank.plans import files

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's checkpoint folder, or else a folder in
    the warehouse, which is shared as well."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    return folder.rstrip("/") if folder else f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/linkrank"


def shuffle_tasks(spark: SparkSession) -> int:
    """Partitions the session gives a shuffle before any are coalesced."""
    initial = spark.conf.get(INITIAL_PARTITIONS, None)
    return int(initial or spark.conf.get(SHUFFLE_PARTITIONS))


def private_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with this one's settings, to change on its own."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


@contextmanager
def shuffled_into(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Run the actions inside with this many shuffle partitions, in a session of one's own.

    Aggregates then shuffle into as many partitions as the bucketed tables have, which
    is what spares their joins another shuffle.
    """
    names = (SHUFFLE_PARTITIONS, INITIAL_PARTITIONS)
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(tasks))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Manifest:
    """Commit records of a run's finished stages, one small text folder each.

    A stage counts as finished once its record is there, and its record is written after its
    data; so a run that stops anywhere finds only whole stages when it starts again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.records: dict[str, dict] = {}
        if files.exists(spark, folder):
            for row in spark.read.text(f"{folder}/*").collect():
                record = json.loads(row.value)
                self.records[record["stage"]] = record

    def commit(self, stage: str, **record: Any) -> dict:
        record = {"stage": stage, **record}
        line = self.spark.createDataFrame([(json.dumps(record),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self.folder}/{stage}")
        self.records[stage] = record
        return record


class Workspace:
    """Tables of one run, under a folder name of their own in the shared folder.

    A written table survives the loss of executors, is read with column pruning and,
    where it is bucketed, joins on its key without another shuffle.

    A workspace with a ``run`` name keeps a manifest: stages that are recorded there are read
    and not written again, so a run that was stopped goes on behind its last whole stage. Its
    ``parameters`` are recorded too; a run of other parameters is refused.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        run: str | None = None,
        parameters: dict | None = None,
    ):
        self.spark = spark
        self.name = f"linkrank_{run or uuid.uuid4().hex}"
        self.folder = f"{folder or shared_folder(spark)}/{self.name}"
        self.manifest = Manifest(spark, f"{self.folder}/done") if run else None
        self._tables: list[str] = []
        self._saved: Counter[str] = Counter()
        self._private: Workspace | None = None
        if self.manifest:
            made = self.manifest.records.get("run") or self.manifest.commit("run", made=parameters)
            if made["made"] != parameters:
                raise ValueError(f"run {run} was begun with {made['made']}, not with {parameters}")

    def private(self) -> Workspace:
        """The same workspace in a session of its own, where plans change settings."""
        if self._private is None:
            own = copy.copy(self)
            own.spark = private_session(self.spark)
            self._private = own._private = own
        return self._private

    def _unused(self, name: str) -> str:
        """A name for the next table: the workspace may serve several plans."""
        self._saved[name] += 1
        return f"{name}_v{self._saved[name]}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _done(self, stage: str) -> dict | None:
        return self.manifest and self.manifest.records.get(stage)

    def _write(self, df: DataFrame, stage: str, write: Callable[[DataFrame], None], **record: Any):
        """Write, and record what was written where there is a manifest."""
        write(df)
        if self.manifest:
            path = self.path(stage)
            rows = self.spark.read.schema(df.schema).parquet(path).count()  # from the footers
            self.manifest.commit(stage, path=path, rows=rows, schema=df.schema.json(), **record)

    def save(self, df: DataFrame | Callable[[], DataFrame], name: str) -> DataFrame:
        """Write a table, or what a function plans, and read it back. A recorded one is only
        read; a function is not called for it."""
        stage = self._unused(name)
        path, done = self.path(stage), self._done(stage)
        if done:
            return self.spark.read.schema(StructType.fromJson(json.loads(done["schema"]))).parquet(path)
        df = df() if callable(df) else df
        # What a stopped run left of this stage has no record: it is written anew.
        mode = "overwrite" if self.manifest else "errorifexists"
        self._write(df, stage, lambda out: out.write.mode(mode).parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def save_bucketed(
        self,
        df: DataFrame | Callable[[], DataFrame],
        name: str,
        keys: list[str],
        buckets: int,
        dealt: bool = False,
    ) -> DataFrame:
        """Hash-partition by ``keys`` and keep that layout: one sorted file per bucket. Rows
        that are ``dealt`` by these keys already are written as they lie."""
        stage = self._unused(name)
        table, path, done = f"{self.name}_{stage}", self.path(stage), self._done(stage)
        self._tables.append(table)
        if done:
            self._register(table, path, done)
            return self.spark.table(table)
        df = df() if callable(df) else df
        if self.manifest:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        mode = "overwrite" if self.manifest else "errorifexists"

        def write(out: DataFrame) -> None:
            (
                (out if dealt else out.repartition(buckets, *keys))
                .write.format("parquet")
                .mode(mode)
                .option("path", path)
                .bucketBy(buckets, *keys)
                .sortBy(*keys)
                .saveAsTable(table)
            )

        self._write(df, stage, write, keys=keys, buckets=buckets)
        return self.spark.table(table)

    def _register(self, table: str, path: str, done: dict) -> None:
        """Tell the catalog of an application about a bucketed table that another one wrote."""
        fields = StructType.fromJson(json.loads(done["schema"])).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        keys = ", ".join(f"`{k}`" for k in done["keys"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {done['buckets']} BUCKETS LOCATION '{path}'"
        )

    def value(self, name: str, compute: Callable[[], Any]) -> Any:
        """What a function returns, a value that JSON holds; a recorded one is not computed."""
        stage = self._unused(name)
        done = self._done(stage)
        if done:
            return done["value"]
        value = compute()
        if self.manifest:
            self.manifest.commit(stage, value=value)
        return value

    def publish(self, name: str, write: Callable[[str], None]) -> None:
        """Have a result written, once. ``write`` gets the mode: what this run began and did
        not finish is written over, anything else that is there is an error."""
        if self._done(name):
            return
        begun = self._done(f"{name}.begun")
        if self.manifest:
            self.manifest.commit(f"{name}.begun")
        write("overwrite" if begun else "errorifexists")
        if self.manifest:
            self.manifest.commit(name)

    def forget_tables(self) -> None:
        """Drop the catalog entries; the files stay for whoever owns the folder."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")

    def clear(self) -> None:
        """Remove all tables of the run, and its manifest."""
        self.forget_tables()
        files.remove(self.spark, self.folder)
