"""Near-equal lines by a segment-partition edit join.

A line within ``errors`` edits of another contains at least one of the other's ``errors + 1`` segments
unchanged, at a place that the two lengths narrow down. Every line indexes its own segments and probes the
segments of lines that are as long or a little shorter; lines that meet are compared by a bit-parallel
automaton on the band of diagonals that matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import BLANK_CLASS, fields_of, group_bounds, joined, keyed, keyed_rows, mix, runs, slices, store
from marketloom.llm.components import components

ERRORS = 2
MIN_CHARS = 20
KEY_SLICE = 1 << 20
PAIRS_AT_ONCE = 1 << 18
COMPARED_AT_ONCE = 4096
GROUP_ROWS = 4096
BROADCAST_IDS = 1_000_000
# An odd multiplier for rolling hashes, and its inverse modulo 2**64.
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _chars(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all lines, and where each line starts in them, and the end."""
    sizes = np.asarray(pc.utf8_length(lines), dtype=np.int64)
    chars = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le"), np.uint32)
    return chars, np.concatenate(([0], np.cumsum(sizes)))


def segment(length: np.ndarray, number: int, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of one of the ``errors + 1`` segments of lines; the last ones may be longer by one."""
    parts = errors + 1
    size, longer = length // parts, length % parts
    extra = np.maximum(0, number - (parts - longer))
    return number * size + extra, size + (number >= parts - longer)


def segment_keys(lines: pa.Array, errors: int = ERRORS, min_chars: int = MIN_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, whether it probes) of every segment to index and every substring to probe."""
    chars, first = _chars(lines)
    n = len(chars)
    room = 1 << max(10, int(n).bit_length())
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * _powers(BASE, room)[:n], dtype=np.uint64)))
    back = _powers(INVERSE, room)
    lengths = np.diff(first)
    out: list[tuple[np.ndarray, np.ndarray, bool]] = []

    def add(which: np.ndarray, at: np.ndarray, size: np.ndarray, length: np.ndarray, number: int, probes: bool) -> None:
        start = first[which] + at
        value = (sums[start + size] - sums[start]) * back[start]
        out.append((which, mix(value + mix(length.astype(np.uint64) * np.uint64(16) + np.uint64(number))).view(np.int64), probes))

    every = np.flatnonzero(lengths >= min_chars)
    for number in range(errors + 1):
        at, size = segment(lengths[every], number, errors)
        add(every, at, size, lengths[every], number, False)
    for shorter in range(errors + 1):
        which = every[lengths[every] - shorter >= min_chars]
        length = lengths[which] - shorter
        for number in range(errors + 1):
            at, size = segment(length, number, errors)
            low = max(-number, shorter - (errors - number))
            high = min(number, shorter + (errors - number))
            for shift in range(low, high + 1):
                fits = (at + shift >= 0) & (at + shift + size <= lengths[which])
                add(which[fits], (at + shift)[fits], size[fits], length[fits], number, True)
    return (
        np.concatenate([w for w, _, _ in out]),
        np.concatenate([k for _, k, _ in out]),
        np.concatenate([np.full(len(w), p) for w, _, p in out]),
    )


def within(a: pa.Array, b: pa.Array, errors: int = ERRORS) -> np.ndarray:
    """Whether the edit distance of each pair of lines is at most ``errors``.

    reach[e] has a bit for each diagonal of the band that e edits can reach; bit d stands for position
    j + d - errors of the first line, where j characters of the second are read.
    """
    left, first_left = _chars(a)
    right, first_right = _chars(b)
    n_left, n_right = np.diff(first_left), np.diff(first_right)
    answer = np.zeros(len(a), bool)
    close = np.flatnonzero(np.abs(n_left - n_right) <= errors)
    close = close[np.argsort(n_right[close], kind="stable")]
    width = 2 * errors + 1
    for at in range(0, len(close), COMPARED_AT_ONCE):
        some = close[at : at + COMPARED_AT_ONCE]
        longest = int(n_right[some].max())
        reading = np.arange(longest)[:, None]
        inside = reading < n_right[some]
        read = np.where(inside, right[np.where(inside, first_right[some] + reading, 0)] if len(right) else 0, 0xFFFFFFFF).astype(np.uint32)
        places = np.arange(-errors, longest + errors)[:, None]
        inside = (places >= 0) & (places < n_left[some])
        held = np.where(inside, left[np.where(inside, first_left[some] + places, 0)] if len(left) else 0, 0xFFFFFFFE).astype(np.uint32)
        full = np.uint16((1 << width) - 1)
        reach = [np.full(len(some), sum(1 << (errors + d) for d in range(e + 1)), np.uint16) for e in range(errors + 1)]
        for j in range(longest):
            same = np.zeros(len(some), np.uint16)
            for d in range(width):
                same |= (held[j + d] == read[j]).astype(np.uint16) << np.uint16(d)
            active = j < n_right[some]
            now = [reach[0] & same]
            for e in range(1, errors + 1):
                now.append(((reach[e] & same) | reach[e - 1] | (reach[e - 1] >> 1) | (now[e - 1] << 1)) & full)
            reach = [np.where(active, new, old) for new, old in zip(now, reach, strict=True)]
        end = n_left[some] - n_right[some] + errors
        answer[some] = (reach[errors] >> end.astype(np.uint16)) & 1 == 1
    return answer


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, probes, id) in this order, those of keys with an indexed line and another line.

    Between batches only the rows of a key's first line are held, so a crowded key is never gathered.
    """
    open_key, indexed, first_id, several, held = None, False, 0, False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, probes, ids = (np.asarray(batch.column(c)) for c in ("key", "probes", "id"))
        bounds = group_bounds(key)
        starts = bounds[:-1]
        run = np.repeat(np.arange(len(starts)), np.diff(bounds))
        has_index, firsts = ~probes[starts], ids[starts].copy()
        follows = key[0] == open_key
        if follows:
            has_index[0], firsts[0] = indexed, first_id
        more = np.logical_or.reduceat(ids != firsts[run], starts)
        before = follows and several
        more[0] |= before
        good = has_index & more
        if follows and good[0] and not before and held is not None:
            yield held
        chosen = good[run]
        if chosen.any():
            yield batch.filter(pa.array(chosen))
        last = batch.slice(int(starts[-1])) if has_index[-1] and not more[-1] else None
        if follows and len(starts) == 1 and held is not None and last is not None:
            last = pa.Table.from_batches([held, last]).combine_chunks().to_batches()[0]
        open_key, indexed, first_id, several, held = key[-1], bool(has_index[-1]), firsts[-1], bool(more[-1]), last


def live_keys(lines: DataFrame, errors: int, min_chars: int) -> DataFrame:
    """(key, probes, id) of the keys at which different lines meet."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("line"), KEY_SLICE):
                part = batch.slice(i, j - i)
                line, key, probes = segment_keys(part.column("line"), errors, min_chars)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(probes), part.column("id").take(pa.array(line))], names=["key", "probes", "id"])

    schema = "key long, probes boolean, id long"
    rows = lines.select("id", "line").mapInArrow(cut, schema)
    return rows.repartition("key").sortWithinPartitions("key", "probes", "id").mapInArrow(_live, schema)


def _signs(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Parities of hashed characters and of hashed pairs of characters, 64 bits each.

    An edit changes at most two of the first and four of the second.
    """
    chars, first = _chars(lines)
    one = np.uint64(1)
    owner = np.repeat(np.arange(len(lines)), np.diff(first))
    pairs = chars[:-1].astype(np.uint64) << np.uint64(32) | chars[1:].astype(np.uint64)
    inner = owner[:-1] == owner[1:]
    out = []
    for values, of in ((chars.astype(np.uint64), owner), (pairs[inner], owner[:-1][inner])):
        bits = one << (mix(values) >> np.uint64(58))
        sign = np.zeros(len(lines), np.uint64)
        np.bitwise_xor.at(sign, of, bits)
        out.append(sign)
    return out[0], out[1]


def _pairs(bounds: np.ndarray, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexed row, probing row) of each group, some at a time; within a group indexed rows come first."""
    starts, ends = bounds[:-1], bounds[1:]
    probing = np.concatenate(([0], np.cumsum(probes)))
    n_probe = probing[ends] - probing[starts]
    n_index = ends - starts - n_probe
    total = np.concatenate(([0], np.cumsum(n_index * n_probe)))
    for at in range(0, int(total[-1]), PAIRS_AT_ONCE):
        flat = np.arange(at, min(at + PAIRS_AT_ONCE, int(total[-1])))
        group = np.searchsorted(total, flat, "right") - 1
        rest = flat - total[group]
        yield starts[group] + rest // n_probe[group], starts[group] + n_index[group] + rest % n_probe[group]


def linked_lines(rows: DataFrame, errors: int) -> DataFrame:
    """(a, b): links between lines within ``errors`` edits; of lines that are linked already, none."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "share"]):
            lines = group.column("line").combine_chunks()
            key, share, probes, ids = (group.column(c).to_numpy() for c in ("key", "share", "probes", "id"))
            names, node = np.unique(ids, return_inverse=True)
            label = np.arange(len(names))
            single, double = _signs(lines)
            for i, j in _pairs(group_bounds(key, share), probes):
                fit = label[node[i]] != label[node[j]]
                i, j = i[fit], j[fit]
                fit = (np.bitwise_count(single[i] ^ single[j]) <= 2 * errors) & (np.bitwise_count(double[i] ^ double[j]) <= 4 * errors)
                i, j = i[fit], j[fit]
                if not len(i):
                    continue
                _, one = np.unique(node[i] * len(names) + node[j], return_index=True)
                i, j = i[one], j[one]
                near = within(lines.take(pa.array(i)), lines.take(pa.array(j)), errors)
                label = joined(label, node[i][near], node[j][near])
            moved = label != np.arange(len(names))
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[label[moved]])], names=["a", "b"])

    sizes = rows.groupBy("key").agg(F.count_if("probes").alias("p"), F.count_if(~F.col("probes")).alias("i"))
    sizes = sizes.filter((F.col("p") > GROUP_ROWS) | (F.col("i") > GROUP_ROWS))
    parts = {c: F.ceil(F.coalesce(c, F.lit(1)) / GROUP_ROWS).cast("int") for c in "pi"}
    rows = rows.join(sizes, "key", "left").withColumns({"np": parts["p"], "ni": parts["i"]})
    # A crowded key becomes a grid of shares: a line is dealt to one row (or column) of it and meets all others.
    own = F.pmod(F.hash("id"), F.when(F.col("probes"), F.col("np")).otherwise(F.col("ni")))
    across = F.explode(F.sequence(F.lit(0), F.when(F.col("probes"), F.col("ni")).otherwise(F.col("np")) - 1))
    rows = rows.withColumns({"own": own, "across": across})
    share = F.when(F.col("probes"), F.col("across") * F.col("np") + F.col("own")).otherwise(F.col("own") * F.col("np") + F.col("across"))
    rows = rows.select("key", share.alias("share"), "probes", "id", "line")
    dealt = rows.repartition("key", "share").sortWithinPartitions("key", "share", "probes", "id")
    return dealt.mapInArrow(compared, "a long, b long")


def _split(docs: DataFrame, hash_bits: int) -> DataFrame:
    """(k1, k2, no, line, id) of every line that is not blank; ids are hashes, not negative."""
    lines = docs.select("doc_id", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    lines = lines.filter(~F.col("line").rlike(f"^{BLANK_CLASS}*$"))
    return lines.withColumn("id", F.shiftrightunsigned(F.xxhash64("line"), 64 - hash_bits))


def _identified(docs: DataFrame, hash_bits: int = 63) -> tuple[DataFrame, DataFrame]:
    """The lines of ``docs``, and the distinct lines, under ids that no two lines share.

    Lines that share a hash with another line are numbered, below zero, and find their number by their content.
    """
    lines = _split(docs, hash_bits)
    distinct = store(lines.select("id", "line").distinct(), "lines")
    clashes = distinct.groupBy("id").count().filter("count > 1").select("id")
    if clashes.isEmpty():
        return lines, distinct
    named = store(distinct.join(clashes, "id", "left_semi").withColumn("own", -1 - F.monotonically_increasing_id()), "clash_names")

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.join(named, ["id", "line"], "left").withColumn("id", F.coalesce("own", "id")).drop("own")

    return renamed(lines), store(renamed(distinct), "named_lines")


def repeated_lines(docs: DataFrame, errors: int = ERRORS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, removed) of ``keyed`` documents with lines to remove: their numbers, in order.

    Lines are of one class when they are equal, or when a chain of lines of at least ``min_chars`` characters
    leads from one to the other with at most ``errors`` edits a step. The first line of a class stays: that of
    the smallest doc_id (null ids last), then the one that comes first in its text.
    """
    lines, distinct = _identified(docs)
    order = F.struct(F.col("doc_id").isNull().alias("null"), "k1", "k2", "no")
    places = store(lines.select("id", order.alias("place")), "places")
    live = store(live_keys(distinct, errors, min_chars), "live_keys")
    ids = live.select("id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    met = store(distinct.join(ids, "id", "left_semi"), "met")
    classes = components(linked_lines(live.join(met, "id"), errors))
    firsts = places.groupBy("id").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    firsts = firsts.join(classes, firsts.id == classes.node, "left").select("id", "first", "n", F.coalesce("root", "id").alias("root"))
    firsts = store(firsts, "first_places")
    heads = firsts.groupBy("root").agg(F.min("first").alias("head"), F.sum("n").alias("n")).filter("n > 1")
    heads = firsts.join(heads.drop("n"), "root").select("id", "head")
    gone = places.join(heads, "id").filter("place <> head")
    return gone.groupBy("place.k1", "place.k2").agg(F.sort_array(F.collect_set("place.no")).alias("removed"))


def judge_lines(docs: DataFrame, errors: int = ERRORS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed (the numbers of the lines that go, from 0).

    See ``repeated_lines`` for what goes. Lines end at line feeds; blank lines stay and are never compared;
    null and empty texts have one blank line. Rows with the same id and text share one result; an empty table
    gives none; other columns are ignored.
    """
    docs = keyed(docs)
    gone = repeated_lines(docs, errors, min_chars)
    own = docs.select("doc_id", "k1", "k2", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    none = F.array().cast("array<int>")
    removed = F.coalesce("removed", none)
    return own.join(gone, ["k1", "k2"], "left").select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def without_repeated_lines(docs: DataFrame, errors: int = ERRORS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with all their columns, and texts without the lines that ``repeated_lines`` names."""
    gone = repeated_lines(keyed(docs), errors, min_chars)
    numbered = F.transform(F.split("row.text", "\n", -1), lambda line, no: F.struct(no.alias("no"), line.alias("line")))
    kept = F.filter(numbered, lambda x: ~F.array_contains("removed", x["no"]))
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    return keyed_rows(docs).join(gone, ["k1", "k2"], "left").select(*fields_of(docs, text))
