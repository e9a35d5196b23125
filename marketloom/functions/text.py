"""Text rules of the model: defaults, slugs, buckets, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.json_values import WHITE_SPACE

UNKNOWN = "unknown"

# Fixed values: (upper bound inclusive, label), in ascending order; ages above the last are "55+".
AGE_GROUPS = ((17, "<18"), (24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"))
OLDEST_GROUP = "55+"


def blank_to_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(UNKNOWN))


def slug(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_"))


def age_group(age: Column) -> Column:
    """Bucket label of a whole-number age; NULL (missing or not a whole number) is ``unknown``."""
    label = F.when(age.isNull(), UNKNOWN)
    for upper, name in AGE_GROUPS:
        label = label.when(age <= upper, name)
    return label.otherwise(OLDEST_GROUP)


def full_name(first: Column, last: Column) -> Column:
    parts = F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))
    return F.nullif(parts, F.lit(""))


def category_hint(url: Column) -> Column:
    """The path segment after ``/product-images/`` of an image URL, if there is one."""
    segment = F.regexp_extract(url, "/product-images/([^/]+)/", 1)
    return F.nullif(F.btrim(segment, F.lit(WHITE_SPACE)), F.lit(""))


def is_batch_date(text: Column) -> Column:
    """``YYYY-MM-DD`` and an existing calendar day; never NULL."""
    return F.coalesce(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


def labelled_value(kind: Column, value: Column) -> Column:
    return F.concat_ws(":", kind, value)
