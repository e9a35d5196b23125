"""Token ids in Parquet files that can be read in parts.

A folder holds ``tokens`` (one file per task, documents in ascending order of id) and ``manifest`` (one row per
file, written last: without it the folder counts as unfinished). The ids are a list column with dictionary
pages; ids of documents, starts and lengths are delta-encoded; row groups and pages have a set size and every page is indexed.
So lengths are read without a page of tokens, and a range of documents or of tokens touches the pages it needs.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import BLANKS, byte_table, slices

END_ID = 2
CACHED_WORDS = 400_000
GROUP_BYTES = 32 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000
WRITTEN = "part int, doc_id long, start long, n_tokens int, ids array<int>"
LETTER, DIGIT, OTHER, ODD = 1, 2, 3, 4


def _classes() -> np.ndarray:
    kinds = np.full(256, ODD, np.uint8)
    kinds[33:127] = OTHER
    kinds[[*range(48, 58)]] = DIGIT
    kinds[[*range(65, 91), *range(97, 123)]] = LETTER
    kinds[ord("'")] = ODD
    kinds[list(BLANKS)] = 0
    return kinds


CLASSES = _classes()
LOWERED = byte_table(b"", lower=True)


class LowerCaseEncoder:
    """Ids of a tokenizer that lower-cases, drops white space, and splits letters, single digits and other signs.

    No token crosses white space, so each stretch between blanks is encoded on its own. A stretch of ASCII
    and the letters of Latin-1 is split here into runs of letters, digits and runs of signs, and only runs not seen
    before are encoded, all at once: every run's last token carries the end-of-word suffix, which shows where it ends. All other stretches
    (apostrophes, added tokens, other scripts, control characters) go whole through the tokenizer itself.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"]["end_of_word_suffix"]
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.runs = Tokenizer.from_str(json.dumps(spec))
        size = self.whole.get_vocab_size()
        self.last = np.array([(self.runs.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.added = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        # Byte-level vocabularies write printable Latin-1 bytes as themselves and the rest from U+0100 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = sorted(set(range(256)) - plain)
        self.shown = {b: 256 + i for i, b in enumerate(hidden) if b != 32}
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start in them, and their end); nulls are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        at = at - at[0]
        units, codes, first = self._units(raw, at)
        found = self._ids(units)
        sizes = np.array(list(map(len, found)), np.int64) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        begin = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        tokens = ids[np.repeat(begin[codes] - (ends - counts), counts) + np.arange(total)]
        return tokens, np.append(0, ends)[first]

    def _units(self, raw: np.ndarray, at: np.ndarray) -> tuple[list[tuple[bytes, bool]], np.ndarray, np.ndarray]:
        """(distinct units with whether they are odd, the unit of each place, the first place of each text)."""
        kinds = CLASSES[raw]
        lowered = LOWERED[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        follow = raw[lead + 1]
        lead = lead[(follow >= 0x80) & (follow != 0x97) & (follow != 0xB7)]
        kinds[lead] = kinds[lead + 1] = LETTER
        second = raw[lead + 1]
        lowered[lead + 1] = np.where(second < 0x9F, second | 0x20, second)
        inside = kinds != 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        begins = at[:-1][at[:-1] < at[1:]]
        starts[begins] = inside[begins]
        stretch = np.cumsum(starts) - 1
        odd = np.zeros(int(starts.sum()) + 1, bool)  # the last one is for blanks before the first stretch
        odd[stretch[kinds == ODD]] = True
        whole = raw.tobytes() if self.added else b""
        for token in self.added:
            place = whole.find(token)
            while place >= 0:
                odd[stretch[place]] = True
                place = whole.find(token, place + 1)
        is_odd = inside & odd[stretch]
        cuts = np.zeros(len(raw), bool)
        cuts[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        starts |= cuts & inside & ~is_odd
        where = np.flatnonzero(starts)
        np.copyto(lowered, raw, where=is_odd)
        kept = lowered[inside]
        offsets = np.append((np.cumsum(inside) - 1)[where], len(kept)).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(where), buffers).dictionary_encode()
        codes = np.asarray(coded.indices)
        flags = np.zeros(len(coded.dictionary), bool)
        flags[codes[is_odd[where]]] = True
        return list(zip(coded.dictionary.to_pylist(), flags.tolist(), strict=True)), codes, np.searchsorted(where, at)

    def _ids(self, units: list[tuple[bytes, bool]]) -> list[bytes]:
        if len(self.known) > CACHED_WORDS:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        found = [known.get(u) for u, _ in units]
        plain, marked, odd = [], [], []
        for (unit, is_odd), ids in zip(units, found, strict=True):
            if ids is None:
                if unit in earlier:
                    known[unit] = earlier[unit]
                else:
                    (odd if is_odd else plain if unit.isascii() else marked).append(unit)
        for runs, shown in ((plain, None), (marked, self.shown)):
            if runs:
                joined = b" ".join(runs).decode("latin-1")
                joined = joined.translate(shown) if shown else joined
                ids = np.array(self.runs.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                cuts = (4 * np.append(0, np.flatnonzero(self.last[ids]) + 1)).tolist()
                raw = ids.tobytes()
                known.update(zip(runs, (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)), strict=True))
        if odd:
            encoded = self.whole.encode_batch_fast([u.decode() for u in odd], add_special_tokens=False)
            known.update(zip(odd, (np.array(e.ids, "<u4").tobytes() for e in encoded), strict=True))
        return [known[u] if ids is None else ids for (u, _), ids in zip(units, found, strict=True)]


_ENCODERS: dict[str, LowerCaseEncoder] = {}


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    group_bytes: int = GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the ids of every text of ``docs`` (doc_id, text) to the folder ``path``, which must not exist.

    A null or empty text is the end id alone, a long text one row with all its ids. Documents lie in ascending
    order of doc_id, null ids last; rows with one id keep the order of the input, repeated rows stay repeated, and other columns
    are not read. An empty table gives a folder without documents. ``docs`` should be a stored table, so that a
    repeated task sees its rows in the same order. The row's number takes part in the range bounds, so a hot id is divided too.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = LowerCaseEncoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for i, j in slices(texts):
                ids, first = encoder.encode(texts.slice(i, j - i))
                n = j - i
                ids = np.insert(ids, first[1:], END_ID).astype(np.int32)
                offsets = (first + np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        doc_ids.slice(i, n).cast(pa.int64()),
                        pa.array(start + offsets[:-1].astype(np.int64)),
                        pa.array(np.diff(offsets)),
                        lists,
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids"],
                )
                start += len(ids)

    order = [F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    writer = rows.mapInArrow(encoded, WRITTEN).write
    for option, value in {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
        "parquet.block.size": group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
    }.items():
        writer = writer.option(option, str(value))
    writer.parquet(f"{path}/tokens")
    _parts(docs.sparkSession, path).write.parquet(f"{path}/manifest")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, and ``base``: the ids of all files before it. As many rows as the writer had tasks."""
    parts = (
        spark.read.schema(WRITTEN).parquet(f"{path}/tokens")
        .groupBy("part")
        .agg(
            F.min("doc_id").alias("first_doc_id"),
            F.max("doc_id").alias("last_doc_id"),
            F.count_if(F.col("doc_id").isNull()).alias("n_null_ids"),
            F.count("*").alias("n_docs"),
            F.sum("n_tokens").alias("n_tokens"),
        )
    )
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return parts.select("*", F.coalesce(before, F.lit(0)).alias("base"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document.

    Select columns and filter ids as in any table: lengths and starts alone read no page of tokens, and filters
    on doc_id skip files, row groups and pages. The manifest has one short row per file and is broadcast.
    """
    bases = F.broadcast(read_manifest(spark, path).select("part", "base"))
    tokens = spark.read.schema(WRITTEN).parquet(f"{path}/tokens")
    return tokens.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """The ids from ``start`` up to ``stop`` of the whole sequence: doc_id, start and ids of each document's share.

    The files are chosen from the manifest, the pages by the place within their file.
    """
    touched = read_manifest(spark, path).filter((F.col("base") < stop) & (F.col("base") + F.col("n_tokens") > start))
    places = touched.agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("base").alias("base")).first()
    tokens = read_tokens_of(spark, path, places["low"], places["high"]) if places["low"] is not None else read_tokens(spark, path).limit(0)
    end = F.col("start") + F.col("n_tokens")
    low, high = F.greatest("start", F.lit(start)), F.least(end, F.lit(stop))
    cut = F.slice("ids", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    return tokens.filter((F.col("start") < stop) & (end > start)).select("doc_id", low.alias("start"), cut.alias("ids"))


def read_tokens_of(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """As ``read_tokens``, of the files numbered ``low`` to ``high`` only; the numbers are in every page's index."""
    bases = F.broadcast(read_manifest(spark, path).filter(F.col("part").between(low, high)).select("part", "base"))
    tokens = spark.read.schema(WRITTEN).parquet(f"{path}/tokens").filter(F.col("part").between(low, high))
    return tokens.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, the crc32 of the ids as little-endian unsigned 32-bit numbers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().tolist()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(summed, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Writes ``docs`` to ``path`` and gives the digests of what is read back from there."""
    write_tokens(docs, path, tokenizer)
    return token_digests(read_tokens(docs.sparkSession, path))
