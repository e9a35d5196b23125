"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import materialise

# Words end at these bytes: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
BLANK_CLASS = r"[\x20\x09-\x0D]"
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialise(df, name)


def _keys() -> list[Column]:
    """Halves of the text's sha256: k2 is the first, and k1 the id, or the second half where there is no id."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    first, second = (F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))
    return [F.coalesce(F.col("doc_id").cast("long"), second).alias("k1"), first.alias("k2")]


def text_name(text: str = "text") -> Column:
    """16 bytes that name a text, whoever has it."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and a key without nulls, k1 and k2. Rows that share a key have equal ids and texts.

    What an operator finds for a text depends on the text alone, so equal rows may share a result.
    """
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_keys())


def keyed_rows(docs: DataFrame) -> DataFrame:
    """The whole row as ``row``, and its key: other columns cannot clash with an operator's own."""
    return docs.select(F.struct("*").alias("row"), *_keys())


def fields_of(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``row``, under their names; with ``text`` in the place of the text."""
    whole = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return whole if text is None else [text.alias(c) if c == "text" else f for c, f in zip(docs.columns, whole, strict=True)]


def byte_table(separators: bytes, lower: bool = False) -> np.ndarray:
    """Maps each byte to itself (A-Z lower-cased on wish), and separators to zero."""
    out = np.arange(256, dtype=np.uint8)
    if lower:
        out[65:91] += 32
    out[list(separators)] = 0
    return out


BY_BLANKS = byte_table(BLANKS)
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())
BY_ALNUM = byte_table(NOT_ALNUM, lower=True)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


class Words:
    """The words of some texts as numpy arrays.

    data: the words' bytes without separators; offsets: where each word starts in them, and the end;
    first: the number of the first word of each text, and the number of words.
    """

    def __init__(self, texts: pa.Array, to: np.ndarray):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        raw = to[raw[at[0] : at[-1]]]
        at = at - at[0]
        inside = raw != 0
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        begins = at[:-1][at[:-1] < at[1:]]
        starts[begins] = inside[begins]
        where = np.flatnonzero(starts)
        self.data = raw[inside]
        self.offsets = np.append(np.cumsum(inside)[where] - 1, len(self.data)).astype(np.int64)
        self.first = np.searchsorted(where, at)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """The number of each word in the list of distinct words, and that list."""
        buffers = [None, pa.py_buffer(self.offsets), pa.py_buffer(np.ascontiguousarray(self.data))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()
        return np.asarray(coded.indices), coded.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of MurmurHash3)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``keys``, regrouped so that no key is divided between two tables."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1] for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= np.asarray(pc.equal(batch.column(k), v))
        cut = int(np.argmax(same))
        if cut == 0 and kept and all(kept[-1].column(k)[-1] == v for k, v in zip(keys, last, strict=True)):
            kept.append(batch)
            continue
        head = [*kept, batch.slice(0, cut)]
        if sum(b.num_rows for b in head):
            yield pa.Table.from_batches(head)
        kept = [batch.slice(cut)]
    if kept:
        yield pa.Table.from_batches(kept)


def group_bounds(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts in sorted columns, and the end."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the groups of i and j became one, pair by pair; a group is labelled by its first member."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            break
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]
    return label


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once a session, where it was not installed or sent with the job."""
    if getattr(spark, "_marketloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="marketloom-code-")) / "marketloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    spark._marketloom_shipped = True


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, sizes: range, bits: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(number of the string, bucket) of every byte n-gram of some strings, each with a mark before and after.

    Sizes go up to 7 bytes, so an n-gram is one integer and only its scrambling to ``bits`` bits can collide.
    """
    lengths = np.diff(offsets) + 2
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    marked = np.full(ends[-1] if len(ends) else 0, 1, np.uint8)
    inner = np.ones(len(marked), bool)
    inner[ends - lengths] = False
    inner[ends - 1] = False
    marked[inner] = data
    room = ends[owner] - np.arange(len(marked))
    value = marked.astype(np.uint64)
    grams, owners = [], []
    for n in range(1, sizes.stop):
        if n > 1:
            value = (value[:-1] << np.uint64(8)) | marked[n - 1 :].astype(np.uint64)
        if n in sizes:
            whole = room[: len(value)] >= n
            grams.append(mix(value[whole] + np.uint64((n << 56) ^ seed)) & np.uint64((1 << bits) - 1))
            owners.append(owner[: len(value)][whole])
    return np.concatenate(owners), np.concatenate(grams).astype(np.int64)


def sums_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)[:n]
