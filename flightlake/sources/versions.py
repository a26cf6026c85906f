"""Tables of immutable versions: partitions in folders that never change, and a manifest per version.

``<table>/version=<n>-<id>/<by>=<value>/`` holds the files that one landing wrote, and
``<table>/_versions/<n>.json`` lists, for every partition value, the folders that make it
up.  A landing writes its folder, then commits: the manifest is written under a
temporary name and renamed to the next number, which fails if that number exists.  So

* a crash before the rename leaves the newest version as it was (the folder is garbage);
* a reader has the files of its version, whatever is landed meanwhile;
* of two landings from one version the second one's rename fails, and it merges again.

The rename is atomic on HDFS and local disks.  A manifest names as many partitions as
the table has (days), and only it passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flightlake.session import materialize

MANIFESTS = "_versions"


@dataclass(frozen=True)
class Version:
    """A committed version: its number, partition column, schema and the folders of each partition value."""

    number: int
    by: str
    schema: T.StructType
    parts: dict[str, list[str]]


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    fs, at = _fs(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def find_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The version ``number`` (default: the newest one); None for a table without versions."""
    if number is None:
        numbers = version_numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    text = spark.read.text(f"{path}/{MANIFESTS}/{number:08d}.json", wholetext=True).first()[0]
    m = json.loads(text)
    return Version(m["number"], m["by"], T.StructType.fromJson(m["schema"]), m["parts"])


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(version_numbers(spark, path))


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version (default: the newest one)."""
    found = find_version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no committed version in {path}")
    return _rows(spark, path, found, found.parts)


def _rows(spark: SparkSession, path: str, version: Version, parts: dict[str, list[str]]) -> DataFrame:
    folders = [f"{path}/{folder}/{version.by}={value}" for value, held in sorted(parts.items()) for folder in held]
    if not folders:
        return spark.createDataFrame([], version.schema)
    rows = spark.read.schema(version.schema).option("basePath", path).parquet(*folders)
    return rows.select(*version.schema.names)


def commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Write the manifest of ``version``; False if its number is taken."""
    fs, folder = _fs(spark, f"{path}/{MANIFESTS}")
    fs.mkdirs(folder)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"number": version.number, "by": version.by, "schema": version.schema.jsonValue(),
                                    "parts": version.parts}).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{version.number:08d}.json")
    return _rename(spark, fs, draft, final)


def _rename(spark: SparkSession, fs, draft, final) -> bool:
    """Rename without replacing (the options of ``FileContext`` refuse an existing name)."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
        return True
    except Exception as e:  # noqa: BLE001 - the Java error's class decides
        if "FileAlreadyExistsException" not in str(e) or isinstance(e, PySparkException):
            raise
        fs.delete(draft, False)
        return False


def land(spark: SparkSession, path: str, rows: DataFrame, by: str,
         merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
         lay_out: Callable[[DataFrame], DataFrame] = lambda df: df, fresh: bool = False,
         row_group_bytes: int | None = None) -> Version:
    """Commit ``rows`` as the next version of the table.

    Partitions (values of ``by``) that ``rows`` does not touch are taken over.  Of those it
    touches the new ones are ``merge(rows, old rows)``; without ``merge`` rows are added.
    ``lay_out`` arranges what is written, in row groups of ``row_group_bytes``.  ``fresh`` starts from an empty table.
    """
    rows = materialize(rows, "landing")
    touched = [str(r[0]) for r in rows.select(by).distinct().collect()]  # one per partition, as the manifest has
    while True:
        base = find_version(spark, path)
        number = base.number + 1 if base else 1
        parts = dict(base.parts) if base and not fresh else {}
        old = {v: parts[v] for v in touched if v in parts}
        new = merge(rows, _rows(spark, path, base, old).select(*rows.columns)) if merge and old else rows
        folder = f"version={number:08d}-{uuid.uuid4().hex[:8]}"
        writer = lay_out(new).write.partitionBy(by)
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes)
        writer.parquet(f"{path}/{folder}")
        for v in touched:
            parts[v] = [folder] if merge else [*parts.get(v, []), folder]
        version = Version(number, by, rows.schema, parts)
        if commit(spark, path, version):
            return version
        fs, at = _fs(spark, f"{path}/{folder}")
        fs.delete(at, True)  # another landing was first: merge with what it wrote


def expire(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Remove all but the newest ``keep`` versions and the folders that none of those lists; returns the folders.

    Folders of landings under way (of the next number) stay.
    """
    numbers = version_numbers(spark, path)
    kept = [find_version(spark, path, n) for n in numbers[-keep:]] if keep > 0 else []
    if not kept:
        raise ValueError("keep at least one version")
    used = {folder for v in kept for held in v.parts.values() for folder in held}
    fs, root = _fs(spark, path)
    for n in numbers[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{n:08d}.json"), False)
    gone = []
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith("version=") and name not in used and int(name[8:16]) <= numbers[-1]:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
