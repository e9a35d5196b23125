"""Folders whose content becomes visible by one line of a log.

Data lie under ``<data>/version=<v>/<key>=<k>``, and the log says which version of a (name, key) holds. A write makes a new
version and appends one file to the log when all of it is there: it replaces any number of keys, of several
tables, at once or not at all. A key in the log without a folder is empty, so emptying costs no job. Readers
see what the log said when they began; older versions can be read until they are removed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketloom.errors import BatchError
from marketloom.session import broadcast_if_small

LOG = "name STRING, key STRING, version STRING"
FORMAT = "%Y%m%dT%H%M%S%f"
COMPACTED = "compacted log"
# The log is compacted again after so many further commits.
COMPACT_FROM = 100


def new_version() -> str:
    """Versions sort by the time of writing."""
    return f"{datetime.now(timezone.utc).strftime(FORMAT)}-{uuid.uuid4().hex[:8]}"


def version_path(data: str, version: str) -> str:
    return f"{data}/version={version}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _hadoop(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it is not there."""
    place, files = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place, files = _hadoop(spark, path)
    files.delete(place, True)


def commit(log: str, entries: DataFrame, version: str) -> None:
    """Makes ``version`` the visible one of all ``entries`` (name, key): one file, which is there or not."""
    lines = entries.select("name", "key").distinct().withColumn("version", F.lit(version))
    lines.coalesce(1).write.mode("append").json(log)


def current(spark: SparkSession, log: str, as_of: str | None = None) -> DataFrame:
    """(name, key, version) of all keys; with ``as_of`` a version, as it was when that one was the last."""
    lines = spark.read.schema(LOG).json(log)
    seen = F.col("version") if as_of is None else F.when(F.col("version") <= as_of, F.col("version"))
    return lines.groupBy("name", "key").agg(F.max(seen).alias("version")).where("version IS NOT NULL")


def version_of(spark: SparkSession, log: str, name: str, key: str, as_of: str | None = None) -> str | None:
    found = current(spark, log, as_of).where((F.col("name") == name) & (F.col("key") == key)).first()
    return None if found is None else found.version


def history(spark: SparkSession, log: str) -> DataFrame:
    """All commits: version and how many keys it replaced."""
    return spark.read.schema(LOG).json(log).groupBy("version").agg(F.count(F.lit(1)).alias("keys"))


def read_visible(
    spark: SparkSession, log: str, data: str, name: str, schema: StructType, key: str, of: str | None = None,
    as_of: str | None = None, form: str = "parquet", foldered: bool = True,
) -> DataFrame:
    """The visible rows of ``name``; ``schema`` is that of its files, and ``key`` the partition column, a string.

    With ``of`` one key only, whose folder is looked up and read alone. Otherwise other versions are pruned
    by folder, at run time, by a join with the log. Where keys are not ``foldered`` they are a column of the version's files.
    """
    partitions = [StructField("version", StringType()), StructField(key, StringType())]
    whole = StructType([*(f for f in schema.fields if f.name != key), *(partitions if foldered else partitions[::-1])])
    reader = spark.read.schema(whole).option("basePath", data).format(form)
    names = [f.name for f in schema.fields if f.name != key]
    if of is not None:
        version = version_of(spark, log, name, of, as_of)
        folder = (version_path(data, version) + (f"/{key}={of}" if foldered else "")) if version else ""
        rows = reader.load(folder).where(F.col(key) == of) if folder and exists(spark, folder) else spark.createDataFrame([], whole)
        return rows.select(*names, key)
    if not exists(spark, data):
        return spark.createDataFrame([], whole).select(*names, key)
    visible = current(spark, log, as_of).where(F.col("name") == name).select(F.col("key").alias(key), "version")
    return reader.load(data).join(broadcast_if_small(visible), [key, "version"], "left_semi").select(*names, key)


def vacuum(spark: SparkSession, log: str, data: dict[str, str], key: str, before: str) -> int:
    """Removes what no reader that began with version ``before`` or later can see; gives the number of folders removed.

    Of every key the last version up to ``before`` and all later ones stay. Folders that no line names, left by
    writes that failed, go too when they are older than ``before``. The log is compacted into a file that says so; the
    files it replaces are removed by a later call, whose ``before`` is after the compaction, so no running reader misses one.
    """
    place, files = _hadoop(spark, log)
    listed = [s for s in files.listStatus(place) if s.getPath().getName().startswith("part-")]
    lines_of_log = spark.read.schema(LOG).json(log)
    usable = F.when(F.col("version") <= before, F.col("version"))
    compacted, marks = lines_of_log.where(F.col("name") == COMPACTED).agg(F.max(usable), F.max("version")).first()
    lines = lines_of_log.where(F.col("name") != COMPACTED)
    last = current(spark, log, before).withColumnRenamed("version", "last")
    kept = lines.join(last, ["name", "key"], "left").where(F.col("last").isNull() | (F.col("version") >= F.col("last")))
    kept = kept.select("name", "key", "version").distinct()
    # Names, keys and versions only: as many as there are partitions.
    named = {(r.name, r.version, r.key) for r in kept.collect()}
    if compacted is not None:
        written = datetime.strptime(compacted.split("-")[0], FORMAT).replace(tzinfo=timezone.utc).timestamp()
        for status in listed:
            if status.getModificationTime() / 1000 < written:
                files.delete(status.getPath(), False)
    since = 0.0 if marks is None else datetime.strptime(marks.split("-")[0], FORMAT).replace(tzinfo=timezone.utc).timestamp()
    if sum(s.getModificationTime() / 1000 > since for s in listed) > (COMPACT_FROM if marks else 1):
        mark = spark.range(1).select(F.lit(COMPACTED).alias("name"), F.lit("").alias("key"), F.lit(new_version()).alias("version"))
        kept.unionByName(mark).coalesce(1).write.mode("append").json(log)
    removed = 0
    for name, folder in data.items():
        for entry in children(spark, folder):
            version = entry.removeprefix("version=")
            if entry == version or version >= before:
                continue
            if not any(n == name and v == version for n, v, _ in named):
                removed += max(1, sum(part.startswith(f"{key}=") for part in children(spark, f"{folder}/{entry}")))
                remove(spark, f"{folder}/{entry}")
                continue
            for part in children(spark, f"{folder}/{entry}"):
                if part.startswith(f"{key}=") and (name, version, part.removeprefix(f"{key}=")) not in named:
                    remove(spark, f"{folder}/{entry}/{part}")
                    removed += 1
    return removed


def require_log(spark: SparkSession, log: str, what: str) -> None:
    if not exists(spark, log):
        raise BatchError(f"nothing has been written yet: {what}")
