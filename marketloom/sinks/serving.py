"""Publication of the six serving tables.

Rows are written under a new version and become visible by one file of the log once all six tables are written
and checked (see ``versions``). Readers see all six tables of a batch or none; a failed run leaves
unreferenced folders only. Earlier publications can be read until ``vacuum`` removes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.contracts import merged_rows, require_contract, serving_rows
from marketloom.schemas import COLUMNS, METRICS, columns_of, schema_of
from marketloom.sinks import versions


def _data_path(root: str, table: str) -> str:
    return f"{root}/serving/{table}"


def _log_path(root: str) -> str:
    return f"{root}/serving/_published"


def _stored_schema(table: str):
    return schema_of(f"{COLUMNS[table]}, updated_at TIMESTAMP")


def _write(served: dict[str, DataFrame], root: str) -> str:
    """Dates are a sorted column and no folders: a date has few rows, and files of many dates are pruned by their statistics."""
    version = versions.new_version()
    for table, rows in served.items():
        stamped = rows.withColumn("updated_at", F.current_timestamp()).hint("rebalance", "date_id")
        stamped.sortWithinPartitions("date_id").write.parquet(versions.version_path(_data_path(root, table), version))
    return version


def _commit(spark: SparkSession, root: str, tables: list[str], dates: DataFrame, version: str) -> None:
    entries = dates.select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("name"), F.col("date_id").alias("key"))
    versions.commit(_log_path(root), entries, version)


def _require_all(tables: dict[str, DataFrame]) -> None:
    if set(tables) != set(METRICS):
        raise ValueError(f"exactly these tables are published together: {sorted(METRICS)}")


def publish(tables: dict[str, DataFrame], root: str, batch_date: str) -> str:
    """Check and publish one date of all six tables; gives the version written."""
    _require_all(tables)
    served = {
        table: serving_rows(table, rows).where(F.col("date_id") == batch_date) for table, rows in tables.items()
    }
    require_contract(served)
    version = _write(served, root)
    spark = next(iter(served.values())).sparkSession
    _commit(spark, root, list(served), spark.range(1).select(F.lit(batch_date).alias("date_id")), version)
    return version


def publish_dates(tables: dict[str, DataFrame], root: str, dates: DataFrame) -> str:
    """Check and publish many dates (``date_id``) of all six tables at once; dates without rows become empty."""
    _require_all(tables)
    wanted = dates.select("date_id").distinct()
    served = {table: serving_rows(table, rows).join(wanted, "date_id", "left_semi") for table, rows in tables.items()}
    require_contract(served)
    version = _write(served, root)
    _commit(wanted.sparkSession, root, list(served), wanted, version)
    return version


def upsert(tables: dict[str, DataFrame], root: str) -> str:
    """Merge rows into what is published: a row replaces the one whose key compares equal, others stay.

    Only the dates of the new rows are read and written again. Keys compare as the contract says; of new rows with
    one key the last in the order of all their columns counts. All given tables become visible at once.
    """
    fresh = {table: serving_rows(table, rows) for table, rows in tables.items()}
    merged, dates = {}, None
    spark = next(iter(fresh.values())).sparkSession
    for table, rows in fresh.items():
        touched = rows.select("date_id").distinct()
        old = read_served(spark, root, table).drop("updated_at").join(touched, "date_id", "left_semi")
        merged[table] = merged_rows(table, old, rows)
        keys = touched.select(F.lit(table).alias("name"), F.col("date_id").alias("key"))
        dates = keys if dates is None else dates.unionByName(keys)
    require_contract(merged)
    version = _write(merged, root)
    versions.commit(_log_path(root), dates, version)
    return version


def read_served(spark: SparkSession, root: str, table: str, as_of: str | None = None) -> DataFrame:
    """The published rows of a table, or those that were published when ``as_of`` was the last version."""
    rows = versions.read_visible(
        spark, _log_path(root), _data_path(root, table), table, _stored_schema(table), "date_id", None, as_of,
        foldered=False,
    )
    return rows.select(*columns_of(table).names, "updated_at")


def read_all_served(spark: SparkSession, root: str, as_of: str | None = None) -> dict[str, DataFrame]:
    return {table: read_served(spark, root, table, as_of) for table in METRICS}


def vacuum(spark: SparkSession, root: str, before: str) -> int:
    """Remove what cannot be read as of version ``before`` or later; gives the number of folders removed."""
    return versions.vacuum(spark, _log_path(root), {t: _data_path(root, t) for t in METRICS}, "date_id", before)
