"""Versioned stage tables between jobs, result tables and text reports."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "model")
_MANIFESTS = "_manifests"


class StageConflict(RuntimeError):
    """Another run switched a table that this one was about to switch."""


class StageStore:
    """The stage tables below one root.

    A table's rows lie in a folder of their own for every version. Which versions count is written in numbered
    manifests; the highest number holds. A writer fills new folders and then renames one new manifest into
    place, so all its tables switch in one step, and a run that breaks off changes nothing that can be read.
    Versions stay until ``clean``, so a reader of an older one is not disturbed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/{_MANIFESTS}")
        files = self._files()
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, number: int) -> dict[str, dict]:
        stream = self._files().open(self._path(f"{self.root}/{_MANIFESTS}/{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict[str, dict]]:
        """Number and tables of the manifest that holds; 0 and none before the first."""
        numbers = self._numbers()
        return (numbers[-1], self._read(numbers[-1])) if numbers else (0, {})

    def path(self, name: str) -> str:
        """The folder of the version that holds."""
        entry = self.newest()[1].get(name)
        if entry is None:
            raise FileNotFoundError(f"no stage table {name} below {self.root}")
        return f"{self.root}/{entry['folder']}"

    def read(self, name: str, week: str | None = "week_start") -> DataFrame:
        entry = self.newest()[1].get(name)
        if entry is None:
            raise FileNotFoundError(f"no stage table {name} below {self.root}")
        return _read_files(self.spark, f"{self.root}/{entry['folder']}", week, entry["format"])

    def read_parts(self, name: str, schema: StructType, parts: Sequence[str] | None = None, entries: Mapping[str, dict] | None = None) -> DataFrame:
        """The stored parts of a table, or those asked for, as one; parts that do not exist hold no rows."""
        entries = self.newest()[1] if entries is None else entries
        known = {n.split("/", 1)[1]: e for n, e in entries.items() if n.startswith(f"{name}/")}
        folders = [f"{self.root}/{known[p]['folder']}" for p in (sorted(known) if parts is None else parts) if p in known]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def begin(self) -> StageWrite:
        return StageWrite(self)

    def publish(self, before: Mapping[str, dict], changed: Mapping[str, dict]) -> int:
        """Let the changed tables hold, in one step; the number of the new manifest.

        Changes of other tables by other runs are kept. A table that another run switched since ``before``
        was read is a conflict, and so nothing of this run holds.
        """
        files = self._files()
        files.mkdirs(self._path(f"{self.root}/{_MANIFESTS}"))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self._conf)
        while True:
            number, now = self.newest()
            lost = [n for n in changed if now.get(n) != before.get(n)]
            if lost:
                raise StageConflict(f"{', '.join(sorted(lost))} changed below {self.root} in the meantime")
            draft = self._path(f"{self.root}/{_MANIFESTS}/draft-{uuid4().hex}")
            stream = files.create(draft, False)
            stream.write(json.dumps({**now, **changed}, indent=1, sort_keys=True).encode())
            stream.close()
            none = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            try:
                context.rename(files.makeQualified(draft), files.makeQualified(self._path(f"{self.root}/{_MANIFESTS}/{number + 1:010d}.json")), none)
                return number + 1
            except Exception as error:  # another run took the number
                files.delete(draft, False)
                if "FileAlreadyExists" not in str(error):
                    raise

    def clean(self, keep: int = 2, idle_hours: float = 24.0) -> list[str]:
        """Remove manifests but the last ``keep``, and the folders that none of those name; what was removed.

        Folders younger than ``idle_hours`` may belong to a run that has not switched yet and stay.
        """
        files, numbers = self._files(), self._numbers()
        version = lambda folder: "/".join(folder.split("/")[:2])
        named = {version(entry["folder"]) for n in numbers[-max(keep, 1):] for entry in self._read(n).values()}
        tables = {entry["folder"].split("/")[0] for n in numbers for entry in self._read(n).values()}
        limit, gone = (time.time() - idle_hours * 3600) * 1000, []
        for table in sorted(tables):
            folder = self._path(f"{self.root}/{table}")
            for found in files.listStatus(folder) if files.exists(folder) else []:
                short = f"{table}/{found.getPath().getName()}"
                if short not in named and found.getPath().getName().startswith("v-") and found.getModificationTime() <= limit:
                    files.delete(found.getPath(), True)
                    gone.append(short)
        for n in numbers[:-max(keep, 1)]:
            files.delete(self._path(f"{self.root}/{_MANIFESTS}/{n:010d}.json"), False)
        return gone


class StageWrite:
    """New versions of some tables, which hold together after ``commit``; leaving the block in good order commits."""

    def __init__(self, store: StageStore):
        self.store = store
        self.before = store.newest()[1]
        self.changed: dict[str, dict] = {}

    def folder(self, name: str, fmt: str) -> str:
        """A new folder for the caller to fill."""
        if fmt not in FORMATS:
            raise ValueError(f"stage tables are {', '.join(FORMATS)}")
        self.changed[name] = {"folder": f"{name}/v-{uuid4().hex}", "format": fmt}
        return f"{self.store.root}/{self.changed[name]['folder']}"

    def write(self, name: str, df: DataFrame, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
        """Write one table, split over as many files as it has partitions, and read the new version."""
        path = self.folder(name, fmt)
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
        return _read_files(self.store.spark, path, "week_start", fmt)

    def write_parts(self, name: str, df: DataFrame, column: str, parts: Sequence[str]) -> None:
        """Write new versions of some parts of a table in one job; the others hold on.

        ``column`` names the part of each row and is not stored with it; all its values are in ``parts``.
        """
        folder = f"{name}/v-{uuid4().hex}"
        df.repartition(column).write.partitionBy(column).parquet(f"{self.store.root}/{folder}")
        self.changed |= {f"{name}/{p}": {"folder": f"{folder}/{column}={p}", "format": "parquet"} for p in parts}

    def note(self, name: str, **facts) -> None:
        """Facts that hold with the tables, such as how far a stream has come."""
        self.changed[name] = {"folder": "", "format": "note", **facts}

    def commit(self) -> dict[str, str]:
        """Let all written versions hold; their folders."""
        if self.changed:
            self.store.publish(self.before, self.changed)
        return {name: f"{self.store.root}/{entry['folder']}" for name, entry in self.changed.items()}

    def __enter__(self) -> StageWrite:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()


def _read_files(spark: SparkSession, path: str, week: str | None, fmt: str) -> DataFrame:
    df = spark.read.csv(path, header=True, inferSchema=True) if fmt == "csv" else spark.read.parquet(path)
    return df.withColumn(week, F.to_date(week)) if week and week in df.columns else df


def _parts(path: str) -> tuple[str, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """A new version of the table at ``path``; the folder it lies in."""
    root, name = _parts(path)
    with StageStore(df.sparkSession, root).begin() as stage:
        stage.write(name, df, fmt, partition_by)
    return f"{root}/{stage.changed[name]['folder']}"


def write_stages(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table below ``root``, then let all hold in one step; returns the folder of each."""
    if not tables:
        return {}
    stage = StageStore(next(iter(tables.values())).sparkSession, root).begin()
    for name, df in tables.items():
        stage.write(name, df, fmt)
    return stage.commit()


def read_stage(spark: SparkSession, path: str, week: str | None = "week_start", fmt: str = "parquet") -> DataFrame:
    """Reload a stage table, or plain files of ``fmt``; the week column is a date again even if it was stored as text.

    Parquet keeps types and marks; of CSV the types are inferred from all rows.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("stage tables are parquet or csv")
    root, name = _parts(path)
    entry = StageStore(spark, root).newest()[1].get(name, {})
    return _read_files(spark, current_folder(spark, path), week, entry.get("format", fmt))


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version that holds if a stage table is at ``path``, else the path itself."""
    root, name = _parts(path)
    entry = StageStore(spark, root).newest()[1].get(name) if root else None
    return f"{root}/{entry['folder']}" if entry else path


def write_text_report(lines: DataFrame, path: str, column: str = "line") -> str:
    """One text line per row, for readers outside; the files lie at ``path`` itself and have no versions."""
    lines.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def metrics_report(metrics: DataFrame) -> DataFrame:
    """The model comparison as text lines, best RMSE first."""
    return (metrics.orderBy("RMSE", "model")
            .select(F.format_string("%-28s MAE=%.3f RMSE=%.3f R2=%.4f MAPE=%.2f",
                                    "model", "MAE", "RMSE", "R2", "MAPE").alias("line")))
