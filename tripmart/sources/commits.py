"""Versioned publication under one commit log (SNK1, SNK3).

A store is a folder. Layers are written to ``<layer>/<partition>=<value>/v=<id>``:
every write adds folders of its own, so no reader ever sees a half-written one.
What is published is one text file per version in ``log``: the inputs it was
made from and, for each layer, its schema and its parts (one per partition
value and write) with files, row counts and bounds. Putting that file in place
is a single create that fails if the version exists already: it switches all
layers at once, a reader or a restarted driver finds the latest by listing the
folder, and of two writers that start from one version, one wins.

Counts and bounds come from Parquet footers (pushed-down aggregates), rules
from metrics observed while the rows are written: publishing reads no copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Name of the innermost folder level, which tells the writes of one partition apart.
VERSION = "v"
#: Values (rows by columns) of a layer that one task is given, whatever the size of the layer, and the bytes of a
#: row group, the least part of a file that a reader's task takes.
TASK_VALUES, ROW_GROUP_BYTES = 1 << 24, 16 << 20
#: Bytes of generated code from which a stage runs operator by operator: the JVM compiles no longer methods.
METHOD_BYTES = 8000


class CommitConflict(RuntimeError):
    """Another writer committed the next version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- files -------------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def _write_text(self, path, text: str) -> None:
        out = self._fs().create(path, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read_text(self, path) -> str:
        stream = self._fs().open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _create_once(self, name: str, text: str) -> bool:
        """Put a whole file in place if no file of that name exists; whether it was this call.

        The file is written aside first. A local folder gets a hard link, any
        other file system a rename that refuses to overwrite; both are atomic.
        """
        jvm = self.spark._jvm
        aside, target = self._path("log", f".{uuid.uuid4().hex}"), self._path("log", name)
        self._write_text(aside, text)
        try:
            if self._fs().getScheme() == "file":
                files, paths = jvm.java.nio.file.Files, jvm.java.nio.file.Paths
                here = [paths.get(p.toUri().getPath(), self._no_strings()) for p in (target, aside)]
                files.createLink(*here)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    self._path().toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
                )
                context.rename(aside, target, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Exception:
            if self._fs().exists(target):
                return False
            raise
        finally:
            self._fs().delete(aside, False)

    def _no_strings(self):
        return self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 0)

    # -- log ---------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("log") if n.endswith(".json") and n[0] != "."]

    def at(self, version: int) -> dict:
        return json.loads(self._read_text(self._path("log", f"{version:012d}.json")))

    def head(self) -> dict:
        """The published version; version 0 if there is none yet."""
        found = self.versions()
        return self.at(found[-1]) if found else {"version": 0, "inputs": None, "layers": {}, "stale": {}}

    def commit(self, content: dict, parent: int) -> dict:
        """Publish ``content`` as the successor of ``parent``, or raise if there is one already."""
        found = self.versions()
        whole = content | {"version": parent + 1}
        if (found and found[-1] != parent) or not self._create_once(f"{parent + 1:012d}.json", json.dumps(whole)):
            raise CommitConflict(f"{self.path}: version {parent} has a successor by another writer")
        return whole

    def vacuum(self, keep: int = 2) -> None:
        """Delete the folders that only versions before the last ``keep`` name, and those versions."""
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        if not old:
            return
        live = {p for v in kept for p in _folders(self.at(v))}
        for version in old:
            for folder in set(_folders(self.at(version))) - live:
                self._fs().delete(self._path(folder), True)
            self._fs().delete(self._path("log", f"{version:012d}.json"), False)

    # -- layers ------------------------------------------------------------------
    def write(
        self, name: str, df: DataFrame, by: Sequence[str] = (), observed: dict[str, Column] | None = None,
        bounds: Sequence[str] = (), rows_in: int = 0, bytes_in: int = 0,
    ) -> tuple[dict, dict]:
        """Write a layer's rows as new parts; returns them, not yet published, and the observed metrics.

        ``bounds`` are number or date columns without nulls whose least and largest value each part keeps.
        ``rows_in`` and ``bytes_in`` are what the layer is made from: the tasks grow in number with it, not in size.
        """
        write_id = uuid.uuid4().hex
        seen = Observation()
        rows = df.withColumn(VERSION, F.lit(write_id))
        measures = {"rows": F.count(F.lit(1))} | (observed or {})
        rows = rows.observe(seen, *[m.alias(k) for k, m in measures.items()])
        try:
            # Dynamic overwrite stages each job in a folder of its own, so two writers cannot meet.
            with sized_tasks(self.spark, rows_in, bytes_in, len(df.columns)):
                (
                    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*by, VERSION).parquet(f"{self.path}/{name}")
                )
            layer = {"schema": df.schema.json(), "by": list(by), "parts": self._parts(name, by, write_id)}
            self._add_counts(layer, name, bounds)
        except Exception:
            self.drop({"parts": self._parts(name, by, write_id)})
            raise
        return layer, seen.get

    def _parts(self, name: str, by: Sequence[str], write_id: str) -> list[dict]:
        pattern = "/".join([name, *["*"] * len(by), f"{VERSION}={write_id}", "*.parquet"])
        parts: dict[str, dict] = {}
        base = self._fs().makeQualified(self._path(name)).toUri().getPath()
        for status in self._fs().globStatus(self._path(pattern)) or []:
            file = status.getPath()
            folder = file.getParent().toUri().getPath()[len(base) + 1 :]
            values = dict(level.split("=", 1) for level in folder.split("/")[:-1])
            part = parts.setdefault(folder, {"folder": f"{name}/{folder}", "values": values, "id": write_id, "files": []})
            part["files"].append([file.getName(), status.getLen()])
        return list(parts.values())

    def _add_counts(self, layer: dict, name: str, bounds: Sequence[str]) -> None:
        """Rows and bounds of every part, from the footers of its files."""
        if not layer["parts"]:
            return
        measures = [F.count(F.lit(1)).alias("rows")]
        measures += [m(c).alias(f"{w}_{c}") for c in bounds for w, m in (("low", F.min), ("high", F.max))]
        with _setting(self.spark, "spark.sql.parquet.aggregatePushdown", "true"):
            found = self._footers(layer, name).groupBy(*layer["by"], VERSION).agg(*measures).collect()
        text = lambda v: str(v).lower() if isinstance(v, bool) else str(v)
        by_folder = {tuple(text(r[k]) for k in (*layer["by"], VERSION)): r.asDict() for r in found}
        for part in layer["parts"]:
            r = by_folder[(*part["values"].values(), part["id"])]
            part["rows"] = r["rows"]
            part["low"], part["high"] = ({c: str(r[f"{w}_{c}"]) for c in bounds} for w in ("low", "high"))

    def _footers(self, layer: dict, name: str) -> DataFrame:
        """The layer's parts through the reader that answers counts and bounds from footers."""
        with _setting(self.spark, "spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text"):
            return self._scan(layer, name)

    def _scan(self, layer: dict, name: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(layer["schema"]))
        if not layer["parts"]:
            return self.spark.createDataFrame([], schema.add(VERSION, "string"))
        folders = [f"{self.path}/{p['folder']}" for p in layer["parts"]]
        reader = self.spark.read.schema(schema.add(VERSION, "string")).option("basePath", f"{self.path}/{name}")
        return reader.parquet(*folders)

    def read(self, layer: dict, name: str) -> DataFrame:
        """Rows of a layer; filters on its partition columns skip whole parts."""
        names = StructType.fromJson(json.loads(layer["schema"])).names
        return self._scan(layer, name).select(*names)

    def counts(self, layer: dict, name: str) -> DataFrame:
        """Rows per partition value, answered from footers: ``(partition columns, rows)``."""
        by = layer["by"]
        counted = self._footers(layer, name).groupBy(*by, VERSION).agg(F.count(F.lit(1)).alias("rows"))
        return counted.groupBy(*by).agg(F.sum("rows").alias("rows"))

    def drop(self, layer: dict) -> None:
        """Delete parts that were written and will not be published."""
        for part in layer["parts"]:
            self._fs().delete(self._path(part["folder"]), True)


def _folders(content: dict) -> list[str]:
    return [p["folder"] for kind in ("layers", "stale") for layer in content[kind].values() for p in layer["parts"]]


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def sized_tasks(spark: SparkSession, rows: int, size: int, columns: int):
    """Shuffles and scans cut by rows for the length of a block, so a task's memory does not grow with the input.

    ``rows`` of ``columns`` are made from ``size`` bytes of files. Shuffles get no fewer partitions than the session
    says, and scans no larger ones; AQE still merges small ones.
    """
    most = max(1, TASK_VALUES // max(1, columns))
    shuffled = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // most))
    # Spark's own parser of sizes: the session's value may have any unit.
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    scanned = min(held, max(1 << 20, size * most // rows)) if rows and size else held
    with (
        _setting(spark, "spark.sql.shuffle.partitions", str(shuffled)),
        _setting(spark, "spark.sql.files.maxPartitionBytes", str(scanned)),
        _setting(spark, "spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES)),
    ):
        yield


def rows_of(layer: dict) -> int:
    return sum(p["rows"] for p in layer["parts"])


def bytes_of(layer: dict) -> int:
    return sum(size for p in layer["parts"] for _, size in p["files"])
