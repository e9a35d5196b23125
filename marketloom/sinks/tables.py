"""Layer tables: Parquet under ``<root>/<layer>/<table>``, one folder per version and batch (see ``versions``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.schemas import LAYER_OF, columns_of, table_schema
from marketloom.session import shuffles_removed
from marketloom.sinks import versions


# Folders of counted records, which no manifest line names.
RECORDS_OF = "records-of-"


def table_path(root: str, table: str) -> str:
    return f"{root}/{LAYER_OF[table]}/{table}"


def manifest_path(root: str, table: str) -> str:
    return f"{table_path(root, table)}/_manifest"


def align_to_schema(rows: DataFrame, target: StructType) -> DataFrame:
    """Target columns in target order, missing ones NULL, unknown ones last."""
    known = [
        F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target
    ]
    return rows.select(*known, *[name for name in rows.columns if name not in target.names])


def read_table(
    spark: SparkSession, root: str, table: str, batch_date: str | None = None, as_of: str | None = None
) -> DataFrame:
    """A layer table, or one batch of it, whose folder is then read alone; ``as_of`` a version, as it was then.

    The fixed schema keeps ``dt`` a string and reads files written before a column existed as NULL.
    """
    versions.require_log(spark, manifest_path(root, table), table)
    return versions.read_visible(
        spark, manifest_path(root, table), table_path(root, table), table, table_schema(table), "dt", batch_date, as_of
    )


def replace_partition(rows: DataFrame, root: str, table: str, batch_date: str) -> str:
    """Make ``rows`` the only content of one batch of a table, also when there are none; gives the version."""
    spark, version = rows.sparkSession, versions.new_version()
    aligned = align_to_schema(rows.drop("dt"), columns_of(table)).select(*columns_of(table).names)
    aligned.write.parquet(f"{versions.version_path(table_path(root, table), version)}/dt={batch_date}")
    entry = spark.range(1).select(F.lit(table).alias("name"), F.lit(batch_date).alias("key"))
    versions.commit(manifest_path(root, table), entry, version)
    return version


def write_partitions(rows: DataFrame, root: str, table: str) -> tuple[str, DataFrame]:
    """Write ``rows`` as a new version that nobody sees yet; gives the version and the batches it has (``dt``).

    The rebalance hint gathers each batch into files of the advised size: small batches are not
    scattered over tasks and a large one is split over several. The batches are read from the written folders.
    """
    schema, version = table_schema(table), versions.new_version()
    path = versions.version_path(table_path(root, table), version)
    align_to_schema(rows, schema).select(*schema.names).hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    return version, rows.sparkSession.read.schema(schema).parquet(path).select("dt").distinct()


def commit_partitions(root: str, table: str, version: str, written: DataFrame, dates: DataFrame | None = None) -> None:
    """Show the version for all batches it has and, emptied, for all others of the requested ``dates``."""
    keys = written if dates is None else written.unionByName(dates.select("dt"))
    versions.commit(manifest_path(root, table), keys.where("dt IS NOT NULL").select(F.lit(table).alias("name"), F.col("dt").alias("key")), version)


def replace_partitions(rows: DataFrame, root: str, table: str, dates: DataFrame | None = None) -> str:
    """Replace every batch that occurs in ``rows`` and of the requested ``dates`` also those that do not, at once.

    One job writes, whatever the number of batches, and one line each in the manifest shows them; a reader sees all
    of the old batches or all of the new ones. Batches without new rows cost nothing but their line.
    """
    version, written = write_partitions(rows, root, table)
    commit_partitions(root, table, version, written, dates)
    return version


def write_kinds(rows: DataFrame, root: str, table: str, audit_columns: StructType) -> tuple[str, DataFrame]:
    """As ``write_partitions`` for rows of two kinds (column ``kind``): those of the table, and records to be counted.

    One job writes both. Gives the version and the records, which lie beside the table's batches in the version's folder
    and are no part of it.
    """
    version = versions.new_version()
    path = versions.version_path(table_path(root, table), version)
    names = [*columns_of(table).names, *audit_columns.names]
    placed = rows.select(*names, F.when(F.col("kind") == "row", F.col("dt")).otherwise(F.concat(F.lit(RECORDS_OF), "dt")).alias("dt"))
    with shuffles_removed(rows.sparkSession):
        placed.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    stored = StructType([*audit_columns.fields, *table_schema(table).fields[-1:]])
    seen = rows.sparkSession.read.schema(stored).parquet(path).where(F.col("dt").startswith(RECORDS_OF))
    return version, seen.withColumn("dt", F.substring("dt", len(RECORDS_OF) + 1, 10))


def rows_per_batch(spark: SparkSession, root: str, table: str, version: str) -> DataFrame:
    """(dt, written) of a version, from its files' footers."""
    path = versions.version_path(table_path(root, table), version)
    rows = spark.read.schema(table_schema(table)).parquet(path).where(~F.col("dt").startswith(RECORDS_OF))
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("written"))
