"""Published months: written aside, checked there, made visible by one manifest.

A run writes the months of its tables below ``<root>/<table>/run=<id>/`` and
nobody reads them yet.  Publishing writes the next manifest, a small file that
names for each table and month the run whose files count; readers follow the
newest one.  So a month of several tables changes at once or not at all, a run
that fails its checks leaves every published byte as it was, and a reader that
has begun with one manifest goes on with its files.

Manifests are numbered; a new one is written under another name and renamed,
which fails if a concurrent run has taken the number.  (The rename is atomic on
HDFS-like stores; a store without atomic rename needs one publisher at a time.)
A manifest has an entry per table and month, whatever the data's size.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from ..schemas import AUDIT, STORED
from .parquet import _fs_path

MANIFESTS = "_manifests"
_NAME = re.compile(r"v(\d{9})\.json$")


class PublishConflict(RuntimeError):
    """Another run has published since this one read the manifest."""


@dataclass(frozen=True)
class Manifest:
    """What is published: the run of each table's months; version 0 is nothing."""

    version: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)

    def runs(self) -> set[str]:
        return {run for months in self.tables.values() for run in months.values()}


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_path(root: str, table: str, run: str) -> str:
    return f"{root.rstrip('/')}/{table}/run={run}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    p, fs = _fs_path(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(m[1]) for m in map(_NAME.match, names) if m)


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/v{version:09d}.json"


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest, or an older one that is still there."""
    if version is None:
        version = max(_versions(spark, root), default=0)
    if version == 0:
        return Manifest()
    p, fs = _fs_path(spark, _manifest_path(root, version))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(version, json.loads(text))


def publish(spark: SparkSession, root: str, changes: dict[str, dict[str, str | None]],
            base: Manifest | None = None) -> Manifest:
    """Make the runs of ``changes`` (table -> month -> run; None takes a month away) the published ones.

    ``base`` is the manifest that the run has started from (default: the newest);
    if another one has been published since, ``PublishConflict`` is raised and
    nothing changes.
    """
    base = read_manifest(spark, root) if base is None else base
    tables = {name: dict(months) for name, months in base.tables.items()}
    for name, months in changes.items():
        now = tables.setdefault(name, {})
        for month, run in months.items():
            if run is None:
                now.pop(month, None)
            else:
                now[month] = run
    made = Manifest(base.version + 1, tables)
    _write_new(spark, _manifest_path(root, made.version), json.dumps(tables, sort_keys=True))
    return made


def _write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; readers see it whole or not at all."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    target, fs = _fs_path(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), no_overwrite)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise PublishConflict(f"{path} has been published by another run") from e
        raise


def read_published(spark: SparkSession, root: str, table: str, periods: list[str] | None = None, *,
                   manifest: Manifest | None = None, period_column: str = "i94dt") -> DataFrame:
    """A published table, or some of its months; only their folders are listed.

    ``manifest`` pins a version, so that several tables are read as of one
    publication.  A table without published months is empty.
    """
    manifest = read_manifest(spark, root) if manifest is None else manifest
    schema = (STORED | AUDIT)[table]
    months = manifest.tables.get(table, {})
    wanted = sorted(set(months) if periods is None else set(periods) & set(months))
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{run_path(root, table, months[month])}/{period_column}={month}" for month in wanted]
    stored = StructType([*schema.fields]).add("run", StringType())
    return (spark.read.schema(stored).option("basePath", f"{root.rstrip('/')}/{table}").parquet(*paths)
            .select(*schema.names))


def discard_run(spark: SparkSession, root: str, tables: list[str], run: str) -> None:
    """Remove what a run has written that is not published."""
    if run in read_manifest(spark, root).runs():
        raise ValueError(f"run {run} is published")
    for table in tables:
        p, fs = _fs_path(spark, run_path(root, table, run))
        fs.delete(p, True)


def retire(spark: SparkSession, root: str, keep: int = 2, period_column: str = "i94dt") -> list[str]:
    """Remove manifests but the newest ``keep``, and then the months of runs that none of them names any more.

    Runs that are being written are named by no manifest either: call it when none is.
    """
    if keep < 1:
        raise ValueError("at least one manifest stays")
    versions = _versions(spark, root)
    manifests = {version: read_manifest(spark, root, version) for version in versions}
    named = {(table, run, month) for version in versions[-keep:] for table, months in manifests[version].tables.items()
             for month, run in months.items()}
    for version in versions[:-keep]:
        p, fs = _fs_path(spark, _manifest_path(root, version))
        fs.delete(p, False)
    gone = []

    def folders(path, prefix: str):
        return [(s.getPath(), s.getPath().getName()[len(prefix):]) for s in fs.listStatus(path)
                if s.getPath().getName().startswith(prefix)]

    for table in sorted({table for manifest in manifests.values() for table in manifest.tables}):
        p, fs = _fs_path(spark, f"{root.rstrip('/')}/{table}")
        for path, run in folders(p, "run=") if fs.exists(p) else []:
            if not any(key[:2] == (table, run) for key in named):
                fs.delete(path, True)
                gone.append(f"{table}/run={run}")
                continue
            for month_path, month in folders(path, f"{period_column}="):
                if (table, run, month) not in named:
                    fs.delete(month_path, True)
                    gone.append(f"{table}/run={run}/{period_column}={month}")
    return gone
