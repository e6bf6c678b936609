"""Writing and reading gold marts, and the quarter-close datasets.

Staging stays lazy; marts are materialised with a full rebuild.  A rebuild
never touches what readers see until all of it is written:

* ``MartStore`` keeps marts in a folder, each build in a version folder of its
  own (``versions/<run>/<layer>/<mart>``).  One small record under ``commits``
  names the folder of every mart; it appears by a rename, after all marts are
  complete.  Readers resolve the newest record, so they see one version of all
  marts, and a build that dies anywhere leaves the version before it as it was.
* ``CatalogMarts`` keeps them in a catalog, one schema per layer.  A build
  writes tables of its own name, and the marts are views that are pointed at
  them when all are complete.

Old versions stay until ``expire`` (the last build but one is kept, so a reader
that has resolved a version may finish).  Facts that are read one quarter at a
time are written ``partitionBy("fiscal_quarter")``, so such reads prune to one
folder.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")
#: Versions that ``expire`` keeps, and the hours after which an uncommitted one counts as dead.
KEEP_VERSIONS, ORPHAN_HOURS = 2, 48
_RUN_TIME = "%Y%m%dT%H%M%S"


def check_layer(layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    return layer


def mart_path(root: str, name: str, layer: str = "gold") -> str:
    return f"{root.rstrip('/')}/{check_layer(layer)}/{name}"


def write_mart(df: DataFrame, path_or_table: str,
               partition_by: Sequence[str] | None = None,
               as_table: bool = False,
               bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Full rebuild: overwrite the whole mart (parquet path or catalog table).

    ``bucket_by`` (buckets, columns), for tables: bucketed by the first column,
    sorted by all of them.  Rows that come partitioned by that column into as
    many partitions give one file a bucket.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, columns = bucket_by
        writer = writer.bucketBy(buckets, columns[0]).sortBy(*columns)
    if as_table:
        writer.saveAsTable(path_or_table)
    else:
        writer.save(path_or_table)


def read_mart(spark: SparkSession, path_or_table: str, as_table: bool = False) -> DataFrame:
    return spark.table(path_or_table) if as_table else spark.read.parquet(path_or_table)


def _new_run() -> str:
    return f"{dt.datetime.now(dt.timezone.utc).strftime(_RUN_TIME)}_{uuid.uuid4().hex[:12]}"


def _is_dead(run: str) -> bool:
    """Whether an uncommitted run began long ago; names that are no run's stay."""
    try:
        began = dt.datetime.strptime(run.split("_")[0].upper(), _RUN_TIME).replace(tzinfo=dt.timezone.utc)
    except ValueError:
        return False
    return dt.datetime.now(dt.timezone.utc) - began > dt.timedelta(hours=ORPHAN_HOURS)


class MartStore:
    """Versioned marts below a folder; one writer at a time, any number of readers."""

    as_table = False

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = _file_system(spark, self.root)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _records(self) -> list[str]:
        return [n for n in self._names("commits") if n.endswith(".json")]

    def _load(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/commits/{name}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def record(self) -> dict | None:
        """The newest committed version: ``version``, ``run`` and the folder of each ``layer/mart``."""
        names = self._records()
        return self._load(names[-1]) if names else None

    def begin(self, marts: Iterable[tuple[str, str]] = ()) -> str:
        """A name for a new version; nothing of it is visible until ``commit``."""
        return _new_run()

    def staged(self, run: str, name: str, layer: str = "gold") -> str:
        return f"{self.root}/versions/{run}/{check_layer(layer)}/{name}"

    def commit(self, run: str, marts: Iterable[tuple[str, str]]) -> dict:
        """Make the (layer, mart) pairs of ``run`` the current ones; other marts stay those of the last version."""
        before = self.record() or {"version": 0, "marts": {}}
        record = {"version": before["version"] + 1, "run": run, "marts": before["marts"] | {
            f"{layer}/{name}": f"versions/{run}/{check_layer(layer)}/{name}" for layer, name in marts}}
        draft = self._path(f"{self.root}/commits/{run}.draft")
        place = self._path(f"{self.root}/commits/{record['version']:012d}_{run}.json")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(record, indent=1).encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, place):
            raise OSError(f"cannot commit {place}")
        return record

    def discard(self, run: str) -> None:
        """Remove what a failed build has written."""
        self._fs.delete(self._path(f"{self.root}/versions/{run}"), True)

    def read(self, name: str, layer: str = "gold", record: dict | None = None) -> DataFrame:
        """A mart of the newest version, or of ``record``."""
        record = record or self.record()
        if record is None or f"{check_layer(layer)}/{name}" not in record["marts"]:
            raise FileNotFoundError(f"no committed {layer}/{name} below {self.root}")
        return self.spark.read.parquet(f"{self.root}/{record['marts'][f'{layer}/{name}']}")

    def publish(self, frames: Mapping[str, DataFrame], layer: str = "gold") -> dict:
        """Write some marts as a new version; the others stay."""
        run = self.begin()
        try:
            for name, df in frames.items():
                write_mart(df, self.staged(run, name, layer))
            return self.commit(run, [(layer, name) for name in frames])
        except BaseException:
            self.discard(run)
            raise

    def expire(self, keep: int = KEEP_VERSIONS) -> None:
        """Remove the versions that none of the newest ``keep`` records names, and dead builds."""
        records = self._records()
        kept = [self._load(n) for n in records[-keep:]]
        used = {path.split("/")[1] for r in kept for path in r["marts"].values()}
        committed = {n.removesuffix(".json").split("_", 1)[1] for n in records}
        for name in records[:-keep]:
            self._fs.delete(self._path(f"{self.root}/commits/{name}"), False)
        for run in self._names("versions"):
            if run not in used and (run in committed or _is_dead(run)):
                self.discard(run)


class CatalogMarts:
    """Marts of a catalog: schema ``<prefix>_<layer>`` (``<layer>`` without a prefix), a view for each mart."""

    as_table = True

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark, self.prefix = spark, prefix

    def schema(self, layer: str) -> str:
        return f"{self.prefix}_{check_layer(layer)}" if self.prefix else check_layer(layer)

    def _tables(self, layer: str) -> dict[str, str]:
        """Name -> kind of the tables and views of a layer's schema."""
        return {t.name: t.tableType for t in self.spark.catalog.listTables(self.schema(layer)) if not t.isTemporary}

    def begin(self, marts: Iterable[tuple[str, str]] = ()) -> str:
        """A name for a new version; fails if a mart's name is taken by a table that no build has made."""
        for layer in {layer for layer, _ in marts}:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.schema(layer)}`")
            taken = self._tables(layer)
            for of, name in marts:
                if of == layer and taken.get(name, "VIEW") != "VIEW":
                    raise ValueError(f"{self.schema(layer)}.{name} is a table, not a view of a build")
        return _new_run().lower()

    def staged(self, run: str, name: str, layer: str = "gold") -> str:
        return f"`{self.schema(layer)}`.`{name}__{run}`"

    def commit(self, run: str, marts: Iterable[tuple[str, str]]) -> None:
        """Point the marts' views at the tables of ``run``; only metadata moves."""
        for layer, name in marts:
            self.spark.sql(f"CREATE OR REPLACE VIEW `{self.schema(layer)}`.`{name}` AS "
                           f"SELECT * FROM {self.staged(run, name, layer)}")

    def discard(self, run: str) -> None:
        for layer in LAYERS:
            if self.spark.catalog.databaseExists(self.schema(layer)):
                for name in self._tables(layer):
                    if name.endswith(f"__{run}"):
                        self.spark.sql(f"DROP TABLE IF EXISTS `{self.schema(layer)}`.`{name}`")

    def read(self, name: str, layer: str = "gold", record: dict | None = None) -> DataFrame:
        return self.spark.table(f"`{self.schema(layer)}`.`{name}`")

    def expire(self, keep: int = KEEP_VERSIONS) -> None:
        """Drop all but the newest ``keep`` tables of each mart; those of a build begin with its time."""
        for layer in LAYERS:
            if not self.spark.catalog.databaseExists(self.schema(layer)):
                continue
            runs: dict[str, list[str]] = {}
            for table in sorted(self._tables(layer)):
                name, _, run = table.partition("__")
                if run:
                    runs.setdefault(name, []).append(table)
            for tables in runs.values():
                for table in tables[:-keep]:
                    self.spark.sql(f"DROP TABLE IF EXISTS `{self.schema(layer)}`.`{table}`")


def write_close_report(datasets: Mapping[str, DataFrame], path: str, fmt: str = "parquet",
                       quarters: Sequence[str] | None = None) -> dict[str, str]:
    """Write each close-report dataset under ``path/<name>``, partitioned by
    fiscal_quarter, so one quarter's tab is one folder.  Returns the paths.

    ``quarters`` names the quarters that the datasets cover: only their folders
    are replaced, all others keep their files as they are, and a quarter
    without rows in a dataset ends up without a folder there.  Rows of other
    quarters are not written.  Without ``quarters`` everything is replaced.
    """
    out = {}
    for name, df in datasets.items():
        target = f"{path.rstrip('/')}/{name}"
        before = {}
        if quarters is not None:
            df = df.where(F.col("fiscal_quarter").isin(*quarters))
            before = {q: _files(df.sparkSession, f"{target}/fiscal_quarter={q}") for q in quarters}
        # quarter-level datasets (bounded by #quarters x #cohorts rows):
        # one task per quarter, so one file per quarter folder
        writer = (df.repartition("fiscal_quarter").write.mode("overwrite")
                  .partitionBy("fiscal_quarter").format(fmt))
        if fmt == "csv":
            writer = writer.option("header", "true")
        if quarters is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.save(target)
        # A quarter with rows has new files by now; one that still has its old ones has lost its rows.
        for quarter, old in before.items():
            folder = f"{target}/fiscal_quarter={quarter}"
            if old and _files(df.sparkSession, folder) == old:
                _file_system(df.sparkSession, folder).delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder), True)
        out[name] = target
    return out


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> set[str]:
    """The names of a folder's files, none if it does not exist."""
    path, fs = spark._jvm.org.apache.hadoop.fs.Path(folder), _file_system(spark, folder)
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()
