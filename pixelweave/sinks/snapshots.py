"""Tables that are replaced or extended in one step.

A table is a folder with data folders nobody has written to before and numbered manifests. A
write first puts its rows into a new data folder and then creates the next manifest, which
names the data folders of the table from now on. Readers take the newest whole manifest, so a
writer that fails half-way leaves the table as it was, its files are never read, and rows of an
earlier run are never counted. A DataFrame that was read before keeps reading its own folders.

Manifests are created without overwriting: of two writers that extend the same version one
fails. A manifest also carries notes, which become valid together with the rows; the streaming
build keeps its batch number and next position there.

Folders begin with an underscore: a plain Parquet scan of the table's folder sees no rows
instead of those of several versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

_MANIFESTS, _DATA = "_manifests", "_data"


@dataclass(frozen=True)
class Snapshot:
    """One version of a table."""

    version: int
    folders: tuple[str, ...]
    schema: T.StructType
    notes: Mapping = field(default_factory=dict)


def _storage(spark: SparkSession, path: str):
    """Hadoop's file system and path, which reach every place that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, whole or not, in ascending order."""
    filesystem, place = _storage(spark, f"{root}/{_MANIFESTS}")
    if not filesystem.exists(place):
        return []
    names = (status.getPath().getName() for status in filesystem.listStatus(place))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_MANIFESTS}/{number:012d}.json"


def _load(spark: SparkSession, root: str, number: int) -> Snapshot | None:
    """A version, or nothing if its writer did not finish the manifest."""
    filesystem, place = _storage(spark, _manifest(root, number))
    stream = filesystem.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        held = json.loads(text)
    except ValueError:
        return None
    return Snapshot(number, tuple(held["folders"]), T.StructType.fromJson(held["schema"]), held["notes"])


def latest(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest version, or nothing where no table is."""
    for number in reversed(_numbers(spark, root)):
        if (found := _load(spark, root, number)) is not None:
            return found
    return None


def find(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The newest or a given version; an error where no table is."""
    found = latest(spark, root) if version is None else _load(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"no table in {root}")
    return found


def read(
    spark: SparkSession, root: str, version: int | None = None, files: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the newest or of a given version; with ``files``, of these files of its one folder."""
    found = find(spark, root, version)
    if not found.folders or files is not None and not files:
        return spark.createDataFrame([], found.schema)
    # The folders are partitions of one scan, however many there are.
    scan = spark.read.schema(found.schema).option("basePath", f"{root}/{_DATA}")
    paths = [data_path(root, f) for f in found.folders]
    if files is not None:
        paths = [f"{paths[0]}/{f}" for f in files]
    return scan.parquet(*paths).select(*found.schema.fieldNames())


def data_path(root: str, folder: str) -> str:
    """Where the rows of one of a version's folders lie."""
    return f"{root}/{_DATA}/{folder}"


def _commit(spark: SparkSession, root: str, after: int, folders: Sequence[str], schema: T.StructType,
            notes: Mapping) -> int:
    number = after + 1
    body = json.dumps({"folders": list(folders), "schema": schema.jsonValue(), "notes": dict(notes)})
    filesystem, place = _storage(spark, _manifest(root, number))
    stream = filesystem.create(place, False)
    try:
        stream.write(bytearray(body.encode("utf-8")))
    finally:
        stream.close()
    return number


def _save(df: DataFrame, root: str, by: Sequence[str], options: Mapping[str, str]) -> str:
    folder = f"folder=v{uuid.uuid4().hex}"
    df.write.options(**options).partitionBy(*by).parquet(f"{root}/{_DATA}/{folder}")
    return folder


def replace(df: DataFrame, root: str, by: Sequence[str] = (), notes: Mapping | None = None,
            keep: int = 2, describe: Callable[[str], Mapping] | None = None, **options: str) -> int:
    """Make the rows of ``df`` the table; its version. ``df`` may read the table itself.

    Of earlier versions, ``keep - 1`` stay for readers that opened them. ``describe`` is given
    the folder of the written rows before they become valid and returns further notes.
    """
    spark = df.sparkSession
    before = (_numbers(spark, root) or [0])[-1]
    folder = _save(df, root, by, options)
    described = describe(data_path(root, folder)) if describe else {}
    version = _commit(spark, root, before, [folder], df.schema, {**(notes or {}), **described})
    drop_old(spark, root, keep)
    return version


def append(df: DataFrame, root: str, by: Sequence[str] = (), notes: Mapping | None = None) -> int:
    """Add the rows of ``df`` to the table, which need not exist; its version."""
    spark = df.sparkSession
    before, found = (_numbers(spark, root) or [0])[-1], latest(spark, root)
    folder = _save(df, root, by, {})
    folders = [*(found.folders if found else ()), folder]
    return _commit(spark, root, before, folders, found.schema if found else df.schema, notes or {})


def drop_old(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete all versions but the newest ``keep``, and their data folders that none of these has.

    Folders of unfinished writes are in no version and stay.
    """
    whole = [v for n in _numbers(spark, root) if (v := _load(spark, root, n)) is not None]
    kept, old = whole[-keep:], whole[:-keep]
    used = {f for v in kept for f in v.folders}
    for version in old:
        filesystem, place = _storage(spark, _manifest(root, version.version))
        filesystem.delete(place, False)
        for folder in set(version.folders) - used:
            filesystem, place = _storage(spark, f"{root}/{_DATA}/{folder}")
            filesystem.delete(place, True)
