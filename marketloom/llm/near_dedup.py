"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into three parts. Two fingerprints that differ in at most four bits differ in at
most one bit of some part. In each part the anchors are the words of the perfect binary Golay code, which
cover every 23-bit word within three bits. A fingerprint lives at its nearest anchor and also visits every
anchor within covering radius plus one, so each linked pair meets at the home of either of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketloom.llm.common import fields_of, group_bounds, joined, keyed, keyed_rows, runs, slices, store, text_name
from marketloom.llm.components import components
from marketloom.llm.near_copies import confirmed, meetings, settled, shingles_of, star_pairs, with_degrees

SHINGLE_WORDS = 4
SEED = 42
BITS = 4
# Generator polynomial of the binary Golay code, its length, check bits and covering radius.
GOLAY, CODE_BITS, CHECK_BITS, RADIUS = 0b110001110101, 23, 11, 3
PARTS = ((0, 22), (22, 21), (43, 21))
PART_BITS = BITS // len(PARTS)
HOMES_PER_TASK = 4096
HOME_CHUNK = 256


def fingerprint(text: str) -> int:
    """Bit i is set when it is set in over half of the hashes of the shingles, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = ends[min(SHINGLE_WORDS, len(words)) - 1 :] - 1
    first = np.concatenate(([0], ends))[: len(last)]
    shingles = [whole[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(shingles), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 and fp, the fingerprint as a signed number, of ``keyed`` documents.

    Null and wordless texts have fingerprint zero. A column ``node`` is kept.
    """
    kept = [c for c in ("doc_id", "k1", "k2", "node") if c in docs.columns]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                found = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
                own = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found.view(np.int64))], names=[*kept, "fp"])

    schema = "doc_id long, k1 long, k2 long, fp long" if "node" not in kept else "doc_id long, k1 long, k2 long, node binary, fp long"
    return docs.select(*kept, "text").mapInArrow(hashed, schema)


class Anchors:
    """The Golay code's syndromes, and for each the errors of few bits that lead to a code word."""

    def __init__(self, reach: int):
        unit = np.zeros(CODE_BITS, np.int64)
        for bit in range(CODE_BITS):
            rest = 1 << bit
            while rest.bit_length() > CHECK_BITS:
                rest ^= GOLAY << (rest.bit_length() - CHECK_BITS - 1)
            unit[bit] = rest
        self.unit = unit
        found: list[list[tuple[int, int]]] = [[] for _ in range(1 << CHECK_BITS)]
        for weight in range(reach + 1):
            for places in combinations(range(CODE_BITS), weight):
                syndrome = int(np.bitwise_xor.reduce(unit[list(places)])) if places else 0
                found[syndrome].append((weight, sum(1 << p for p in places)))
        most = max(map(len, found))
        self.errors = np.full((len(found), most), -1, np.int64)
        for syndrome, errors in enumerate(found):
            self.errors[syndrome, : len(errors)] = [e for _, e in sorted(errors)]

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the word, anchor, whether it is the word's home), for each anchor within reach."""
        syndrome = np.zeros(len(words), np.int64)
        for bit in range(CODE_BITS):
            syndrome ^= ((words >> bit) & 1) * self.unit[bit]
        errors = self.errors[syndrome]
        number, rank = np.nonzero(errors >= 0)
        return number, words[number] ^ errors[number, rank], rank == 0


def part_of(fps: np.ndarray, start: int, width: int) -> np.ndarray:
    return ((fps.view(np.uint64) >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64)


def covered(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home): each distinct fingerprint at its home and at the anchors it visits, for each part."""

    def replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(RADIUS + PART_BITS)
        for batch in batches:
            fp = np.asarray(batch.column("fp"))
            for number, (start, width) in enumerate(PARTS):
                which, anchor, home = anchors.of(part_of(fp, start, width))
                columns = [pa.array((number << CODE_BITS) + anchor), pa.array(fp[which]), pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "fp", "home"])

    return fps.mapInArrow(replicated, "anchor long, fp long, home boolean")


def linked(homes: np.ndarray, visitors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """For each visitor the number of the first visitor it is linked to by way of the homes.

    ``visitors`` are sorted and contain the homes. Pairs that are linked already are not compared again once
    one group holds most of the visitors, so a large group of near copies costs about its size.
    """
    label = np.arange(len(visitors))
    own = np.searchsorted(visitors, homes)
    u, h = visitors.view(np.uint64), homes.view(np.uint64)
    for at in range(0, len(h), HOME_CHUNK):
        some = np.arange(at, min(at + HOME_CHUNK, len(h)))
        sizes = np.bincount(label, minlength=len(label))
        top = int(sizes.argmax())
        inside = label[own[some]] == top if 2 * sizes[top] > len(label) else np.zeros(len(some), bool)
        for part, others in ((some[~inside], slice(None)), (some[inside], np.flatnonzero(label != top))):
            if not len(part):
                continue
            near = np.bitwise_count(h[part, None] ^ u[None, others]) <= bits
            i, j = np.nonzero(near)
            j = j if isinstance(others, slice) else others[j]
            i = own[part][i]
            label = joined(label, i, j)
    return label


def links(rows: DataFrame) -> DataFrame:
    """(a, b): for each anchor and each group of its fingerprints that are linked there, a star of links.

    A crowded anchor is dealt over several tasks: each gets a share of the homes and all visitors. The
    number of anchors is fixed by the code, so the list of crowded ones is bounded.
    """
    crowded = rows.filter("home").groupBy("anchor").count().filter(F.col("count") > HOMES_PER_TASK).collect()
    parts = F.lit(1)
    if crowded:
        shares = F.create_map(*[F.lit(x) for r in crowded for x in (r.anchor, -(-r["count"] // HOMES_PER_TASK))])
        parts = F.coalesce(shares[F.col("anchor")], F.lit(1))
    rows = rows.withColumn("parts", parts.cast("int"))
    rows = rows.withColumn("own", F.pmod(F.hash("fp"), "parts"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("anchor", "part", "fp", (F.col("home") & (F.col("own") == F.col("part"))).alias("home"))

    def starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["anchor", "part"]):
            anchor, part, fp, home = (rows.column(c).to_numpy() for c in ("anchor", "part", "fp", "home"))
            bounds = group_bounds(anchor, part)
            a, b = [], []
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if j - i > 1 and home[i:j].any():
                    visitors = fp[i:j]
                    label = linked(visitors[home[i:j]], visitors)
                    moved = label != np.arange(j - i)
                    a.append(visitors[moved])
                    b.append(visitors[label[moved]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    dealt = rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "fp")
    return dealt.mapInArrow(starred, "a long, b long")


def _rooted(found: DataFrame) -> DataFrame:
    """(fp, root): each distinct fingerprint and the smallest one it can reach over links."""
    distinct = store(found.select("fp").distinct(), "distinct_fingerprints")
    return _under_roots(distinct, links(covered(distinct)))


def _under_roots(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    roots = components(edges)
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at four or fewer differing bits; component_id is the smallest doc_id that can be reached
    over links, null ids left out (null when there is no other). Null and wordless texts have fingerprint
    zero and are linked like any other. Repeated rows give repeated results, an empty table none; other
    columns are ignored.
    """
    found = store(fingerprints(keyed(docs)), "fingerprints")
    first = found.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = _rooted(found).join(first, "fp")
    firsts = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = store(roots.join(firsts, "root").select("fp", "component_id"), "by_fingerprint")
    return found.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted_copies(docs: DataFrame, found: DataFrame) -> DataFrame:
    """As ``_rooted``, with links also between the fingerprints of texts whose shingles are similar.

    The first round compares the texts of a band with one of them, the best connected; the second compares those that
    are under different roots still, within the tasks, and gives links only.
    """
    distinct = store(found.select("fp").distinct(), "distinct_fingerprints")
    edges = store(links(covered(distinct)), "links")
    prints = store(found.select("node", "fp").distinct(), "prints")
    met = store(with_degrees(meetings(docs)), "meetings")
    sets = store(shingles_of(docs, met.select("node").distinct()), "shingles")
    for star in (True, False):
        roots = store(prints.join(_under_roots(distinct, edges), "fp").select("node", "root"), "roots")
        rooted = met.join(roots, "node")
        near = confirmed(star_pairs(rooted), sets) if star else settled(rooted, sets)
        near = near.join(prints.toDF("a", "fp_a"), "a").join(prints.toDF("b", "fp_b"), "b")
        edges = store(edges.union(near.select("fp_a", "fp_b")), "links")
    return _under_roots(distinct, edges)


def one_of_each_group(docs: DataFrame, copies: bool = False) -> DataFrame:
    """Of each group of near-duplicates one row of ``docs``, with all its columns: that with the smallest doc_id.

    Null ids come last; of rows with the same id and text, any one stays. With ``copies``, texts whose five-word
    shingles have a Jaccard similarity of 0.8 or more are near-duplicates too.
    """
    named = keyed(docs).withColumn("node", text_name())
    found = store(fingerprints(named), "fingerprints")
    roots = _rooted_copies(named, found) if copies else _rooted(found)
    order = F.struct(F.col("doc_id").isNull().alias("null"), "k1", "k2")
    first = found.groupBy("fp").agg(F.min(order).alias("first"))
    kept = roots.join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = store(kept.select("first.k1", "first.k2"), "kept")
    rows = keyed_rows(docs).join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return rows.select(*fields_of(docs))
