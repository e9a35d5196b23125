"""Near copies by the Jaccard similarity of their shingles.

Minima of hashed shingles, some to a band, name the groups in which texts meet. Texts that meet and are not linked
yet are compared by their whole sets of shingles: first every text with the best connected of its group, then all
that are still apart, inside the tasks. Only links that join something leave a task, so a large group of
near copies gives about as many rows as it has texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketloom.llm.common import BLANKS, Words, byte_table, group_bounds, mix, runs, slices, store

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Texts of similarity 0.8 share none of the bands with a chance of (1 - 0.8**5)**24, 1 in 14,000.
BANDS, BAND_ROWS = 24, 5
SEED = 42
CHUNK = 1024
SHARE_BYTES = 16 << 20
LOWER = byte_table(BLANKS, lower=True)
FACTORS = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) << np.uint64(20)) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted hashes of the different shingles of each text; a shorter text is one shingle."""
    words = Words(texts, LOWER)
    codes, distinct = words.encoded()
    names = np.fromiter((xxh64_intdigest(w, SEED) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        own = min(size, b - a)
        value = np.full(b - a - own + 1 if b > a else 0, own, np.uint64)
        for k in range(own):
            value = mix(value + names[a + k : a + k + len(value)])
        out.append(np.unique(value))
    return out


def band_keys(shingles: np.ndarray) -> np.ndarray:
    least = np.full(len(FACTORS), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), CHUNK):
        np.minimum(least, (shingles[at : at + CHUNK] * FACTORS[:, None]).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        key = mix(key + column)
    return key.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= similarity * (len(a) + len(b) - shared)


def meetings(docs: DataFrame) -> DataFrame:
    """(key, node) of each band in which different texts meet; ``docs`` has the texts and their names, ``node``."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                keys = [band_keys(s) for s in shingle_sets(part.column("text"))]
                node = part.column("node").take(pa.array(np.repeat(np.arange(j - i), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), node], names=["key", "node"])

    rows = store(docs.select("node", "text").mapInArrow(banded, "key long, node binary"), "bands")
    several = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    return rows.join(several.select("key"), "key", "left_semi").distinct()


def with_degrees(met: DataFrame) -> DataFrame:
    """(key, node, degree): in how large bands a text meets others. The text that many were copied from has most."""
    met = store(met, "met")
    sizes = met.groupBy("key").agg(F.count("*").alias("size"))
    degrees = met.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("degree"))
    return met.join(degrees, "node").select("key", "node", "degree")


def shingles_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of some texts, once each; shingles are sorted 64-bit hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                sets = pa.array([s.tobytes() for s in shingle_sets(part.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("node"), sets], names=["node", "shingles"])

    texts = docs.select("node", "text").join(nodes, "node", "left_semi").dropDuplicates(["node"])
    return texts.mapInArrow(cut, "node binary, shingles binary")


def star_pairs(rooted: DataFrame) -> DataFrame:
    """(a, b): a text of each band whose texts are under several roots, and all its texts under other roots than that one.

    The centre is the best connected text of the band.
    """
    seen = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.struct("degree", "node", "root")).alias("top"))
    centres = seen.filter("low <> high").select("key", F.col("top.node").alias("a"), F.col("top.root").alias("a_root"))
    return rooted.join(centres, "key").filter("root <> a_root").select("a", F.col("node").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of the pairs whose shingles have at least this Jaccard similarity."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            near = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    return both.select("a", "b", "left", "right").mapInArrow(compared, "a binary, b binary")


def settled(rooted: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """(a, b): links between all similar texts of a band that are under different roots, as far as they join anything new.

    The shingles come to the band's task and no pair leaves it. A band of many shingles becomes a grid of shares of
    about ``share_bytes``: every text meets every other in one of them.
    """
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    rows = store(rooted.join(apart, "key", "left_semi").select("key", "node", "root").join(sets, "node"), "still_apart")
    sizes = rows.groupBy("key").agg(F.sum(F.octet_length("shingles")).alias("bytes"))
    sizes = sizes.filter(F.col("bytes") > share_bytes).select("key", F.ceil(F.col("bytes") / share_bytes).cast("int").alias("parts"))
    rows = rows.join(sizes, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.hash("node"), "parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    share = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    dealt = rows.select("key", share.alias("share"), "own", "node", "root", "shingles").repartition("key", "share")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "share"]):
            key, share = (group.column(c).to_numpy() for c in ("key", "share"))
            bounds = group_bounds(key, share).tolist()
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                part = group.slice(i, j - i)
                sets = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                first, second = new_links(sets, part.column("root").to_numpy(), part.column("own").to_numpy(), similarity)
                if len(first):
                    nodes = part.column("node").combine_chunks()
                    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(first)), nodes.take(pa.array(second))], names=["a", "b"])

    return dealt.sortWithinPartitions("key", "share", "node").mapInArrow(compared, "a binary, b binary")


def new_links(sets: list[np.ndarray], roots: np.ndarray, own: np.ndarray, similarity: float) -> tuple[list[int], list[int]]:
    """Pairs of similar sets that join different roots; where ``own`` has two values, pairs across them only."""
    _, label = np.unique(roots, return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    _, names = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
    mixed = len(np.unique(own)) > 1
    first: list[int] = []
    second: list[int] = []
    mark = np.zeros(int(names.max(initial=-1)) + 1, bool)
    for i in range(len(sets)):
        fits = (label != label[i]) & (np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i]))
        fits[: i + 1] = False
        if mixed:
            fits &= own != own[i]
        other = np.flatnonzero(fits)
        if not len(other):
            continue
        mark[names[bounds[i] : bounds[i + 1]]] = True
        for j in other.tolist():
            if label[j] == label[i]:
                continue
            shared = int(mark[names[bounds[j] : bounds[j + 1]]].sum())
            if shared >= similarity * (sizes[i] + sizes[j] - shared):
                first.append(i)
                second.append(j)
                label[label == label[j]] = label[i]
        mark[names[bounds[i] : bounds[i + 1]]] = False
    return first, second
