"""Packing documents into training sequences by bounded-space online best-fit.

Every task packs the documents of its own split and keeps a fixed number of bins open. The open bins'
free spaces are bits of one integer, so the tightest bin that fits is found by a shift and a mask. When
too many bins are open, the fullest closes.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marketloom.llm.common import slices

SEQUENCE_TOKENS = 1024
OPEN_BINS = 1024
END_ID = 2
CACHED_WORDS = 400_000
PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"
)
# Fixed value: how the tokenizer writes a space.
SPACE_SIGN = "Ġ"
# Fixed value: the published splitting pattern of byte-level tokenizers of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COMMON_END = "\u0250"


class WordEncoder:
    """Token ids of texts as little-endian 32-bit numbers, by way of the distinct words.

    The tokenizer's own pattern always starts a new pre-token at a single space between two other
    characters, so the stretches between such spaces can be encoded one by one. Texts with other spaces beside
    blanks, or with an added token, are encoded whole. New stretches are encoded in one run: the tokens that begin with a space, which
    no stretch contains, tell where each starts. Stretches of Latin letters are encoded by a faster library
    from the tokenizer's own vocabulary and pattern, which gives the same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith(SPACE_SIGN) for i in range(size)])
        self.ranked = _ranked(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; ``texts`` has no nulls."""
        lists = pc.split_pattern(texts, " ")
        first = np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]
        coded = lists.flatten().dictionary_encode()
        codes, words = np.asarray(coded.indices), coded.dictionary.to_pylist()
        special = np.zeros(len(texts), bool)
        for token in self.added:
            special |= np.asarray(pc.match_substring(texts, token))
        inner = ~np.repeat(special, np.diff(first))
        inner[first[:-1]] = False
        used = np.zeros(len(words), bool)
        used[codes[inner]] = True
        found = self._known([w if u else None for w, u in zip(words, used.tolist(), strict=True)])
        odd = np.array([w is None for w in found], bool) & used
        heads = [words[c] for c in codes[first[:-1]].tolist()]
        irregular = np.add.reduceat(np.append(odd[codes] & inner, False), first[:-1]) > 0 if len(first) > 1 else np.zeros(0, bool)
        alone = np.diff(first) == 1
        irregular |= special
        irregular |= ~alone & np.array([not h or h[-1].isspace() for h in heads], bool)
        whole = np.flatnonzero(irregular).tolist()
        starts = self._ids([texts[i].as_py() if odd_text else h for i, (h, odd_text) in enumerate(zip(heads, irregular.tolist(), strict=True))])
        raw = [w or b"" for w in found]
        sizes = np.array([len(w) // 4 for w in raw], np.int64)
        at = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(raw), "<u4")
        inner &= ~np.repeat(irregular, np.diff(first))
        counts = np.where(inner, sizes[codes], 0)
        ends = np.cumsum(counts)
        tokens = ids[np.repeat(at[codes] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        bounds = (4 * np.append(0, ends)[first]).tolist()
        return [start + tokens[a:b] for start, a, b in zip(starts, bounds[:-1], bounds[1:], strict=True)] if len(whole) < len(texts) else starts

    def _known(self, words: list[str | None]) -> list[bytes | None]:
        """The ids of each stretch with a space before it; none where blanks at its ends forbid it."""
        if len(self.known) > CACHED_WORDS:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        found = [known.get(w) for w in words]
        common, other, places = [], [], []
        for place, (w, ids) in enumerate(zip(words, found, strict=True)):
            if ids is None and w:
                ids = earlier.get(w)
                if ids is not None:
                    found[place] = known[w] = ids
                elif not (w[0].isspace() or w[-1].isspace()):
                    places.append(place)
                    (common if self.ranked and max(w) < COMMON_END else other).append(w)
        if common:
            known.update(zip(common, self._cut(self.ranked.encode_ordinary(" " + " ".join(common))), strict=True))
        if other:
            known.update(zip(other, self._cut(self.tokenizer.encode_batch_fast([" " + " ".join(other)], add_special_tokens=False)[0].ids), strict=True))
        for place in places:
            found[place] = known[words[place]]
        return found

    def _cut(self, ids: list[int]) -> list[bytes]:
        ids = np.array(ids, "<u4")
        raw, cuts = ids.tobytes(), (4 * np.append(np.flatnonzero(self.spaced[ids]), len(ids))).tolist()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]


def _ranked(path: str):
    """The tokenizer's vocabulary as byte ranks, if it is byte-level and its merges are in the order of their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary, before = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"] or None in merged or merged != sorted(merged):
        return None
    # Byte-level vocabularies write printable Latin-1 bytes as themselves and the rest from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class OpenBins:
    """Bins of ``size`` tokens, at most ``most`` of them open; bit f of ``free`` is set when a bin has f left."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free, self.count, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset for a piece: the tightest open bin it fits, else a new one."""
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.count += 1
            if self.count > self.most:
                self._take((self.free & -self.free).bit_length() - 1)
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free ^= 1 << free
        self.count -= 1
        return number


def pieces(length: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length): whole documents, or pieces of ``size`` of which the first may be shorter."""
    start, step = 0, length % size or size
    while start < length:
        yield start, step
        start, step = start + step, size


_ENCODERS: dict[str, WordEncoder] = {}


def pack(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and the ids' bytes.

    A document is the ids of its text (null: empty) and the end id, so an empty text is one token. Rows with
    equal ids are packed as separate documents, null ids too; an empty table gives no rows; other columns
    are ignored. Each split of the input is packed by one task in one pass; there is no shuffle, and a lost
    task packs its split again in the same way. A task keeps no more than ``open_bins`` bins open.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = WordEncoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 33
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            column = batch.column("text")
            ids = batch.column("doc_id")
            for i, j in slices(column):
                texts = pc.fill_null(column.slice(i, j - i), "")
                out: list[tuple] = []
                for doc_id, raw in zip(ids.slice(i, j - i).to_pylist(), encoder.encode(texts), strict=True):
                    raw += end
                    for number, (start, length) in enumerate(pieces(len(raw) // 4, size)):
                        part = raw[4 * start : 4 * (start + length)]
                        sequence, offset = bins.place(length)
                        out.append((doc_id, number, start, length, zlib.crc32(part), base + sequence, offset, part if with_ids else None))
                columns = list(zip(*out, strict=True))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))

    out = docs.select("doc_id", "text").mapInArrow(packed, PACKED)
    return out if with_ids else out.drop("ids")
