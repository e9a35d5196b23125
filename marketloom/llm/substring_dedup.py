"""Long repeated passages by de Bruijn compaction over sampled token k-mers.

Every window of 35 words names its smallest k-mer an anchor, so equal windows share an anchor. Anchors are
the nodes of a de Bruijn graph and the words from one anchor to the next its edges. An anchor that occurs
again and always has the same two edges does not branch. Chains of such anchors are compacted to one path
each; only windows that touch a branching anchor remain as paths of their own. Paths are then read back at
their source coordinates and counted by their words: those that occur twice are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketloom.llm.common import BY_BLANKS, Words, fields_of, keyed, keyed_rows, mix, slices, store
from marketloom.session import discard

WINDOW = 35
KMER = 10
DIGEST_BYTES = 16
# Texts read together: a word takes some twenty numbers, and a window of a branching anchor a digest.
SLICE = 1 << 20
# An odd multiplier for rolling hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Graph:
    """The anchors of some texts. Positions count the words of all the texts together."""

    def __init__(self, texts: pa.Array, window: int, k: int):
        self.words = words = Words(texts, BY_BLANKS)
        self.window, self.k = window, k
        n = len(words)
        codes, distinct = words.encoded()
        hashes = np.fromiter(map(xxh64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))[codes]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(BASE, n), dtype=np.uint64)))
        self.back = _powers(INVERSE, n + 1)
        starts, stops = words.first[:-1], words.first[1:] - window + 1
        counts = np.maximum(stops - starts, 0)
        self.windows = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        self.text_of_window = np.repeat(np.arange(len(starts)), counts)
        if len(self.windows):
            kmers = mix(self.span_hash(np.arange(n - k + 1), np.full(n - k + 1, k)))
            self.smallest = self._smallest(kmers, window - k + 1)[self.windows]
            self.anchors = np.unique(self.smallest)
            self.names = kmers[self.anchors].view(np.int64)
        else:
            self.smallest = self.anchors = self.names = np.zeros(0, np.int64)
        self.text_of_anchor = np.searchsorted(words.first, self.anchors, "right") - 1

    def span_hash(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    @staticmethod
    def _smallest(values: np.ndarray, width: int) -> np.ndarray:
        """Position of the leftmost smallest of each ``width`` values."""
        at = np.arange(len(values))
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            if len(at) <= step:
                return at[:0]
            left, right = at[:-step], at[step:]
            at = np.where(values[right] < values[left], right, left)
            reach += step
        return at

    def surroundings(self) -> np.ndarray:
        """A hash of the edges before and after each anchor; zero where one of them is missing."""
        a = self.anchors
        out = np.zeros(len(a), np.uint64)
        if len(a) > 2:
            edges = mix(self.span_hash(a[:-1], a[1:] - a[:-1] + self.k) + (a[1:] - a[:-1]).astype(np.uint64))
            inner = (self.text_of_anchor[:-2] == self.text_of_anchor[1:-1]) & (self.text_of_anchor[1:-1] == self.text_of_anchor[2:])
            out[1:-1] = np.where(inner, mix(edges[:-1] + mix(edges[1:] ^ np.uint64(1))) | np.uint64(1), 0)
        return out.view(np.int64)

    def paths(self, again: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, length) of the paths that may be repeated.

        again: the anchors that occur again; plain: those of them that do not branch.
        """
        branching = np.concatenate(([0], np.cumsum(~plain)))
        lo = np.searchsorted(self.anchors, self.windows)
        hi = np.searchsorted(self.anchors, self.windows + self.window - self.k, "right")
        own = np.searchsorted(self.anchors, self.smallest)
        alone = again[own] & (branching[hi] > branching[lo]) if len(own) else np.zeros(0, bool)
        edge = np.diff(np.concatenate(([0], plain.view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        first, last = self._within_texts(first, last)
        start = np.concatenate((self.windows[alone], self.anchors[first - 1]))
        end = np.concatenate((self.windows[alone] + self.window, self.anchors[last + 1] + self.k))
        text = np.concatenate((self.text_of_window[alone], self.text_of_anchor[first]))
        whole = end - start >= self.window
        return text[whole], start[whole], (end - start)[whole]

    def _within_texts(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # An anchor that does not branch has neighbours in its text, so chains never reach over two texts.
        same = self.text_of_anchor[first - 1] == self.text_of_anchor[np.minimum(last + 1, len(self.anchors) - 1)] if len(first) else np.zeros(0, bool)
        return first[same], last[same]


class Spaced:
    """The words' bytes, each word with one space after it."""

    def __init__(self, words: Words):
        n = len(words)
        self.at = words.offsets + np.arange(n + 1)
        spaced = np.full(self.at[-1], 32, np.uint8)
        inner = np.ones(len(spaced), bool)
        inner[self.at[1:] - 1] = False
        spaced[inner] = words.data
        self.bytes = spaced.tobytes()

    def cut(self, start: int, end: int) -> bytes:
        return self.bytes[self.at[start] : max(self.at[start], self.at[end] - 1)]


def anchored(docs: DataFrame, window: int, k: int) -> DataFrame:
    """For each document its word count, the hash of its words, and its anchors with their surroundings."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text"), SLICE):
                part = batch.slice(i, j - i)
                graph = Graph(part.column("text"), window, k)
                first, spaced = graph.words.first, Spaced(graph.words)
                whole = [sha256(spaced.cut(a, b)).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                at = np.searchsorted(graph.text_of_anchor, np.arange(j - i + 1)).astype(np.int32)
                around = graph.surroundings()
                pos = graph.anchors - first[graph.text_of_anchor]
                columns = {
                    "doc_id": part.column("doc_id"),
                    "k1": part.column("k1"),
                    "k2": part.column("k2"),
                    "n_words": pa.array(np.diff(first)),
                    "whole_sha256": pa.array(whole),
                    "name": pa.ListArray.from_arrays(pa.array(at), pa.array(graph.names)),
                    "around": pa.ListArray.from_arrays(pa.array(at), pa.array(around)),
                    "pos": pa.ListArray.from_arrays(pa.array(at), pa.array(pos.astype(np.int32))),
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, k1 long, k2 long, n_words long, whole_sha256 string, name array<long>, around array<long>, pos array<int>"
    return docs.mapInArrow(found, schema)


def path_rows(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(k1, k2, digest, start, length, n) of the paths of documents with flagged anchors.

    n = 1: a path. Paths that occur again among the texts read together need no count: n = 2 announces them
    to others, without a place, and n = 0 has the spans of words they cover.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text"), SLICE):
                part = batch.slice(i, j - i)
                graph = Graph(part.column("text"), window, k)
                first = graph.words.first
                flags = part.column("flags")
                owner = np.asarray(pc.list_parent_indices(flags))
                flat = pc.list_flatten(flags)
                where = first[owner] + np.asarray(flat.field("pos"))
                again = np.isin(graph.anchors, where)
                plain = np.isin(graph.anchors, where[np.asarray(flat.field("plain"), dtype=bool)])
                text, start, length = graph.paths(again, plain)
                spaced = Spaced(graph.words)
                digests = [
                    blake2b(spaced.cut(a, a + n), digest_size=DIGEST_BYTES).digest()
                    for a, n in zip(start.tolist(), length.tolist(), strict=True)
                ]
                coded = pa.array(digests, pa.binary()).dictionary_encode()
                codes = np.asarray(coded.indices)
                counts = np.bincount(codes, minlength=len(coded.dictionary))
                here, there = np.flatnonzero(counts[codes] > 1), np.flatnonzero(counts[codes] == 1)
                first_of = here[np.unique(codes[here], return_index=True)[1]]
                place, covered = _merged(start[here], length[here])
                of = np.searchsorted(first, place, "right") - 1
                yield _path_batch(part, text[there], coded.take(pa.array(there)), start[there] - first[text[there]], length[there], 1)
                yield _path_batch(part, text[first_of], coded.take(pa.array(first_of)), np.full(len(first_of), -1), length[first_of], 2)
                yield _path_batch(part, of, pa.nulls(len(of), pa.binary()), place - first[of], covered, 0)

    return docs.mapInArrow(found, "k1 long, k2 long, digest binary, start int, length int, n int")


def _merged(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap, as one each. Spans that only touch stay apart: they may belong to two texts."""
    if not len(start):
        return start, length
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + length)[order])
    new = np.concatenate(([True], start[1:] >= end[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))
    return start[new], end[last] - start[new]


def _path_batch(part: pa.RecordBatch, text: np.ndarray, digest: pa.Array, start: np.ndarray, length: np.ndarray, n: int) -> pa.RecordBatch:
    at = pa.array(text)
    columns = {
        "k1": part.column("k1").take(at),
        "k2": part.column("k2").take(at),
        "digest": digest.cast(pa.binary()),
        "start": pa.array(start.astype(np.int32)),
        "length": pa.array(length.astype(np.int32)),
        "n": pa.array(np.full(len(text), n, np.int32)),
    }
    return pa.RecordBatch.from_pydict(columns)


def repeated_spans(docs: DataFrame, facts: DataFrame, window: int, k: int) -> DataFrame:
    """(k1, k2, spans): the spans of words, as start and length, whose windows all occur elsewhere too."""
    anchors = facts.select("k1", "k2", F.explode(F.arrays_zip("name", "around", "pos")).alias("x")).select(
        "k1", "k2", "x.name", F.nullif(F.col("x.around"), F.lit(0)).alias("around"), "x.pos"
    )
    nodes = anchors.groupBy("name").agg(
        F.count("*").alias("n"), F.count("around").alias("inner"), F.min("around").alias("low"), F.max("around").alias("high")
    )
    same = (F.col("n") == F.col("inner")) & (F.col("low") == F.col("high"))
    nodes = nodes.filter("n > 1").select("name", F.coalesce(same, F.lit(False)).alias("plain"))
    flagged = anchors.select("k1", "k2", "name", "pos").join(nodes, "name")
    flagged = flagged.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "plain")).alias("flags"))
    paths = store(path_rows(docs.drop("doc_id").join(flagged, ["k1", "k2"]), window, k), "paths")
    again = paths.filter("n > 0").groupBy("digest", "length").agg(F.sum("n").alias("n")).filter("n > 1").select("digest", "length")
    spans = paths.filter("n = 1").join(again, ["digest", "length"]).select("k1", "k2", "start", "length")
    spans = spans.union(paths.filter("n = 0").select("k1", "k2", "start", "length"))
    spans = store(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "length")).alias("spans")), "spans")
    discard(paths)
    return spans


def _kept(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth[:-1]) == 0


def _cut_text(text: str, starts: np.ndarray, lengths: np.ndarray) -> tuple[int, str]:
    """(number of words removed, the words outside the spans joined by one space)."""
    words = text.encode().split()
    keep = _kept(len(words), np.asarray(starts), np.asarray(lengths))
    return len(words) - int(keep.sum()), b" ".join([words[i] for i in np.flatnonzero(keep).tolist()]).decode()


def cut_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(k1, k2, n_removed, kept): the words outside the spans, joined by one space; only documents with spans."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                _cut_text(text.as_py(), [s["start"] for s in some], [s["length"] for s in some])
                for text, some in zip(batch.column("text"), (x.as_py() for x in batch.column("spans")), strict=True)
            ]
            columns = {
                "k1": batch.column("k1"),
                "k2": batch.column("k2"),
                "n_removed": pa.array([n for n, _ in found], pa.int64()),
                "kept": pa.array([t for _, t in found], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    joined = docs.drop("doc_id").join(spans, ["k1", "k2"])
    return joined.mapInArrow(cut, "k1 long, k2 long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes when it lies in a window of ``window`` consecutive words whose word sequence starts anywhere
    else too, in the same document or another; windows are judged on the input. Repeated rows are
    copies of each other and lose every window. Null texts have no words; texts shorter than a window
    lose nothing; an empty table gives none; other columns are ignored.
    """
    docs = keyed(docs)
    facts = store(anchored(docs, window, k), "anchors")
    spans = repeated_spans(docs, facts, window, k)
    # The anchors are read no more; what is left of the facts is small.
    facts, anchors = store(facts.drop("name", "around", "pos"), "facts"), facts
    discard(anchors)
    cut = cut_texts(docs, spans)
    cut = cut.select("k1", "k2", "n_removed", F.sha2("kept", 256).alias("cut_sha256")).dropDuplicates(["k1", "k2"])
    return facts.join(cut, ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """``docs`` with all its columns, and texts without their repeated words; untouched texts stay as they are."""
    own = keyed(docs)
    facts = store(anchored(own, window, k), "anchors")
    spans = repeated_spans(own, facts, window, k)
    discard(facts)
    spans = spans.select("k1", "k2", F.col("spans.start").alias("starts"), F.col("spans.length").alias("lengths"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        rows = zip(texts, starts, lengths, strict=True)
        return pd.Series([None if some is None else _cut_text(text, some, sizes)[1] for text, some, sizes in rows], dtype=object)

    # The texts cross the network once more, with their spans beside them.
    joined = keyed_rows(docs).join(spans, ["k1", "k2"], "left")
    kept = cut(F.coalesce("row.text", F.lit("")), "starts", "lengths")
    return joined.select(*fields_of(docs, F.coalesce(kept, "row.text")))
