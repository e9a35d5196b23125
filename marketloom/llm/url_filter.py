"""URL filter: rules for hosts and paths, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import ngram_buckets, sums_by

ALLOW, BLOCK = "allow", "block"
BITS = 16
HOST_SIZES, PATH_SIZES = range(3, 6), range(3, 6)
HOST_SEED, PATH_SEED = 1 << 40, 2 << 40
MAX_LABELLED = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, slash, rest = rule.partition("/")
    own = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
    return own & F.startswith(path, F.lit(slash + rest))


def matching_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule that fits, as struct<rule, verdict>; null when none fits. On ties, blocking wins."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1]))
    found = [
        F.when(_fits(rule, host, path), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, rule in ordered
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """The probability that a url is to be blocked."""
        owner, bucket = url_features(hosts, paths)
        n = len(hosts)
        size = np.maximum(np.bincount(owner, minlength=n)[:n], 1)
        return 1 / (1 + np.exp(-(self.bias + sums_by(owner, self.weights[bucket], n) / np.sqrt(size))))


def _strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pa.concat_arrays([pc.fill_null(column, "").cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[: offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def url_features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [
        ngram_buckets(*_strings(column), sizes, BITS, seed)
        for column, sizes, seed in ((hosts, HOST_SIZES, HOST_SEED), (paths, PATH_SIZES, PATH_SEED))
    ]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def train(labelled: DataFrame, rounds: int = 300, rate: float = 0.5, decay: float = 1e-3, limit: int = MAX_LABELLED) -> UrlModel:
    """Fits ``labelled`` (url, blocked 0/1). At most ``limit`` rows are used, those with the smallest hashes.

    Rows without a label are left out; without any rows the model allows everything.
    """
    rows = labelled.filter("blocked is not null").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked")
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "blocked").limit(limit).toArrow()
    n = rows.num_rows
    if n == 0:
        return UrlModel(np.zeros(1 << BITS), -2.0)
    label = np.asarray(rows.column("blocked"), dtype=float)
    owner, bucket = url_features(rows.column("host").combine_chunks(), rows.column("path").combine_chunks())
    value = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))[owner]
    # The bias is the share of blocked rows alone, so that a url without features is judged by that share.
    weights, bias = np.zeros(1 << BITS), float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(bias + sums_by(owner, weights[bucket] * value, n)))) - label
        gradient = np.bincount(bucket, weights=error[owner] * value, minlength=1 << BITS) / n
        weights -= 20 * rate * (gradient + decay * weights)
    return UrlModel(weights, bias)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, score.

    A rule's verdict comes first; without a rule, ``model`` blocks at ``threshold``. A null url, or one
    without ``://``, has an empty host and path and gets the model's verdict on nothing but its bias.
    Repeated rows give repeated results, an empty table none; other columns are ignored. The rules are part of
    the plan and so meant to be few; the model has a fixed size.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("score", pa.array(model.scores(batch.column("host"), batch.column("path"))))

    parts = parts.mapInArrow(scored, "page_id long, host string, path string, score double")
    found = matching_rule(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    return parts.withColumn("found", found).select(
        "page_id", "host", "path", "found.rule", F.coalesce("found.verdict", own).alias("verdict"), "score"
    )
