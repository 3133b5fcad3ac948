"""Tables in versions: readers see one version as a whole, writers replace only the parts that they touch.

    <path>/versions/00000007.json   parts of version 7: folder and rows of each
    <path>/data/<write>/_part=.../  Parquet files of one part, as one write left them

A part is a share of the rows by some key (a query year and a hash bucket of the domain). An upsert reads and rewrites only the parts that occur in the
new rows; the folders of all others are taken over into the next version. A version appears by renaming its finished file to its number,
which fails if another writer has taken the number; that writer then starts again from the newer version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism.session import stored

PART = "_part"
TRIES = 5
#: Metrics of one observation; parts beyond that are counted in further ones.
METRICS = 200


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    parts: dict = field(default_factory=dict)  # name -> {"folder": ..., "rows": ...}
    batches: dict = field(default_factory=dict)  # stream -> last batch that it has written

    @property
    def rows(self) -> int:
        return sum(p["rows"] for p in self.parts.values())


class Conflict(RuntimeError):
    """Another writer has made a version in the meantime."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    folder, files = _hadoop(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """A version of a table; the latest one without a number, an empty one for a table that was never written."""
    known = versions(spark, path)
    if not known and version is None:
        return Manifest()
    number = known[-1] if version is None else version
    if number not in known:
        raise ValueError(f"no version {number} of {path}")
    place, files = _hadoop(spark, f"{path}/versions/{number:08d}.json")
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _commit(spark: SparkSession, path: str, made: Manifest) -> None:
    folder = f"{path}/versions"
    temporary, files = _hadoop(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    files.mkdirs(temporary.getParent())
    stream = files.create(temporary, False)
    try:
        stream.write(json.dumps({"version": made.version, "parts": made.parts, "batches": made.batches}).encode())
    finally:
        stream.close()
    target, _ = _hadoop(spark, f"{folder}/{made.version:08d}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, target, no_overwrite)
    except Exception as failure:
        files.delete(temporary, False)
        if files.exists(target):
            raise Conflict(f"version {made.version} of {path} was made by another writer") from failure
        raise


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None,
                  wanted: Callable[[str], bool] | None = None) -> DataFrame:
    """Rows of one version; ``wanted`` picks parts by name, others are not read. Empty for a table that was never written."""
    parts = manifest(spark, path, version).parts
    folders = [f"{path}/{p['folder']}" for name, p in sorted(parts.items()) if p["rows"] and (wanted is None or wanted(name))]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(spark: SparkSession, path: str, new: DataFrame, part: Column, schema: T.StructType, merge: Callable[[DataFrame, DataFrame], DataFrame],
           batch: tuple[str, int] | None = None) -> Manifest:
    """Merges ``new`` into a table: ``merge(old, new)`` gets the old rows of those parts that occur in ``new``, and gives their rows in the next
    version. ``part`` names the part of a row; ``merge`` must keep rows in their parts.

    ``batch`` (stream, number) makes the write happen once: a batch that the table already has changes nothing. The new rows are
    stored first, so they are computed once; row counts are observed in the job that writes them.
    """
    names = schema.fieldNames()
    new = stored(new.select(*names, part.alias(PART)), "upsert")
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())  # as many as a table has parts at most
    for _ in range(TRIES):
        old = manifest(spark, path)
        if batch and old.batches.get(batch[0], -1) >= batch[1] or not touched and not batch:
            return old
        before = read_snapshot(spark, path, schema, old.version or None, wanted=set(touched).__contains__)
        counts, folder = {}, f"data/{uuid.uuid4().hex}"
        if touched:
            counts = _write(merge(before, new.select(*names)).select(*names, part.alias(PART)), f"{path}/{folder}", touched)
        parts = old.parts | {name: {"folder": f"{folder}/{_part_folder(spark, name)}", "rows": counts[name]} for name in touched}
        made = Manifest(old.version + 1, parts, old.batches | ({batch[0]: batch[1]} if batch else {}))
        try:
            _commit(spark, path, made)
        except Conflict:
            continue
        return made
    raise Conflict(f"{path}: other writers were faster {TRIES} times")


def _write(rows: DataFrame, folder: str, touched: list[str]) -> dict[str, int]:
    """Writes rows by part; returns the rows of each."""
    watched, seen = rows, []
    for i in range(0, len(touched), METRICS):
        one = Observation()
        seen.append(one)
        watched = watched.observe(one, *[F.count_if(F.col(PART) == name).alias(f"n{i + k}") for k, name in enumerate(touched[i:i + METRICS])])
    # Few files for small parts, several for large ones.
    watched.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
    found = {k: v for one in seen for k, v in one.get.items()}
    return {name: found[f"n{k}"] for k, name in enumerate(touched)}


def _part_folder(spark: SparkSession, name: str) -> str:
    """Name of the folder that Spark writes for a part."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(PART, name)


def expire(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Deletes all versions but the last ``keep`` and the folders that none of these needs; returns how many versions went. Folders of
    writes that are under way are newer than every version and must not run beside it."""
    known = versions(spark, path)
    gone = known[:-keep] if keep else known[:-1]
    kept = [manifest(spark, path, v) for v in known if v not in gone]
    needed = {p["folder"].split("/")[1] for m in kept for p in m.parts.values()}
    for v in gone:
        place, files = _hadoop(spark, f"{path}/versions/{v:08d}.json")
        files.delete(place, False)
    folder, files = _hadoop(spark, f"{path}/data")
    for status in files.listStatus(folder) if files.exists(folder) else []:
        if status.getPath().getName() not in needed:
            files.delete(status.getPath(), True)
    return len(gone)
