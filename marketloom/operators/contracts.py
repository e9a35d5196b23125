"""Checks of the serving tables' constraints, as counts of violating rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from marketloom.errors import BatchError
from marketloom.schemas import METRICS, SERVING, columns_of

# Serving keys compare without case, accents and trailing spaces.
KEY_COLLATION = "UNICODE_CI_AI_RTRIM"


def serving_rows(table: str, rows: DataFrame) -> DataFrame:
    """Projection to the serving columns: unknown columns dropped, missing ones NULL."""
    if table not in METRICS:
        raise ValueError(f"unknown serving table: {table}")
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in columns_of(table)
        ]
    )


def _constraint_rows(table: str, violations: list[tuple[str, Column]]) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), count.alias("violations"))
                for name, count in violations
            ]
        )
    )


def _value_violations(table: str, rows: DataFrame) -> DataFrame:
    """NOT NULL and length limits in one aggregation."""
    contract = SERVING[table]
    counts = {f"not_null({name})": F.col(name).isNull() for name in (*contract.key, *contract.required)}
    counts |= {f"length({name})": F.char_length(name) > limit for name, limit in contract.lengths.items()}
    totals = rows.agg(*[F.count_if(broken).alias(name) for name, broken in counts.items()])
    return totals.select(_constraint_rows(table, [(name, F.col(f"`{name}`")) for name in counts]))


def _collated_key(table: str) -> list[Column]:
    """The primary key as it compares."""
    types = {f.name: f.dataType for f in columns_of(table)}
    return [
        (F.collate(name, KEY_COLLATION) if isinstance(types[name], StringType) else F.col(name)).alias(f"key_{name}")
        for name in SERVING[table].key
    ]


def _key_violations(table: str, rows: DataFrame) -> DataFrame:
    """Rows beyond the first of each primary key."""
    groups = rows.groupBy(*_collated_key(table)).agg(F.count(F.lit(1)).alias("copies"))
    surplus = groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"))
    return surplus.select(_constraint_rows(table, [("primary_key", F.col("surplus"))]))


def merged_rows(table: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the rows of ``new`` put in or in the place of those whose key compares equal.

    Keys compare by the collation of the serving tables; a NULL in a key equals NULL. Of several new rows with one
    key the greatest by its columns in order counts (``duplicate_keys`` reports them). One pass: new rows rank before
    old ones of their key, and the aggregate keeps one row a key, combined before the shuffle.
    """
    columns = columns_of(table).names
    both = serving_rows(table, old).withColumn("fresh", F.lit(0)).unionByName(serving_rows(table, new).withColumn("fresh", F.lit(1)))
    row = F.struct("fresh", *columns)
    kept = both.select(*_collated_key(table), row.alias("row")).groupBy(*[f"key_{k}" for k in SERVING[table].key]).agg(F.max("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in columns])


def with_defaults(table: str, rows: DataFrame) -> DataFrame:
    """Serving rows with 0 for a missing number of a required column; a missing text stays and breaks the contract."""
    required = set(SERVING[table].required)
    return serving_rows(table, rows).select(
        *[
            F.coalesce(f.name, F.lit(0).cast(f.dataType)).alias(f.name)
            if f.name in required and isinstance(f.dataType, NumericType) else F.col(f.name)
            for f in columns_of(table)
        ]
    )


def duplicate_keys(table: str, new: DataFrame) -> DataFrame:
    """Keys that several rows of ``new`` share (as they compare): the key's first spelling and the number of rows."""
    names = SERVING[table].key
    groups = serving_rows(table, new).select(*_collated_key(table), *names).groupBy(*[f"key_{k}" for k in names]).agg(
        F.min(F.struct(*names)).alias("key"), F.count(F.lit(1)).alias("copies")
    )
    return groups.where(F.col("copies") > 1).select(*[F.col("key")[k].alias(k) for k in names], "copies")


def contract_violations(tables: dict[str, DataFrame]) -> DataFrame:
    checks = []
    for table, rows in tables.items():
        served = serving_rows(table, rows)
        checks += [_key_violations(table, served), _value_violations(table, served)]
    return reduce(DataFrame.unionByName, checks)


def require_contract(tables: dict[str, DataFrame]) -> None:
    """Raise with the broken constraints; their number is fixed by the schema, not by the data."""
    broken = contract_violations(tables).where(F.col("violations") > 0).collect()
    if broken:
        raise BatchError("; ".join(f"{r.table_name}.{r.constraint_name}: {r.violations}" for r in broken))
