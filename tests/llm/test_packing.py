import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketloom.llm.packing import OpenBins, WordEncoder, pack, pieces
from marketloom.llm.queries import TOKENIZER, tokenizer_path

TEXTS = [
    None, "", " ", "a", "  two  spaces ", "line\n next\n\n more \t tab", "it's don't", "x" * 5000, "word " * 3000,
    " nbsp  em", "end\n", "<|endoftext|> plain", "été 123 !!! ...", "a b\nc d", "trailing ", "\nlead",
]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_path(TOKENIZER))


def whole_ids(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'1. \n\t é !s\x1c\x85"), max_size=40), max_size=4))
def test_words_give_the_ids_of_the_whole_text(encoder, texts):
    for text, raw in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == whole_ids(encoder, text)


def test_whole_sample_texts_and_all_latin_letters(encoder, sample):
    from pyarrow.parquet import read_table

    texts = read_table(f"{sample}/documents.parquet")["text"].to_pylist()
    texts += ["".join(chr(c) + ("" if c % 3 else " x") for c in range(1, 0x2000)), " ".join(chr(c) * 2 for c in range(1, 0x300))]
    for text, raw in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == whole_ids(encoder, text)


def test_added_tokens_have_their_own_ids(encoder):
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a b <|endoftext|>", "a <|endoftext| > b", "a b", ""]
    found = [np.frombuffer(raw, "<u4").tolist() for raw in encoder.encode(pa.array(texts))]
    assert found == [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert found[0] == [64, 220, 50256, 275]


def test_pieces_cut_only_long_documents():
    assert list(pieces(5, 8)) == [(0, 5)]
    assert list(pieces(16, 8)) == [(0, 8), (8, 8)]
    assert list(pieces(19, 8)) == [(0, 3), (3, 8), (11, 8)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60), st.integers(1, 5))
def test_bins_take_the_tightest_fit_and_close_the_fullest(lengths, most):
    bins, open_ = OpenBins(16, most), {}
    for length in lengths:
        number, offset = bins.place(length)
        fitting = {n: f for n, f in open_.items() if f >= length}
        if fitting:
            assert open_[number] == min(fitting.values()) and offset == 16 - open_[number]
        else:
            assert number not in open_ and offset == 0
        open_[number] = open_.pop(number, 16) - length
        if not open_[number]:
            del open_[number]
        if len(open_) > most:
            closed = min(open_, key=lambda n: (open_[n],))
            least = [n for n, f in open_.items() if f == open_[closed]]
            gone = [n for n in least if n not in bins.by_free[open_[n]]]
            assert len(gone) == 1
            del open_[gone[0]]


def test_packing_is_a_partition_of_all_tokens(spark, encoder):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(None, "a b", 1), (3, "a", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int").repartition(2)
    found = pack(docs, tokenizer_path(TOKENIZER)).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[(r.doc_id, r.start, r.piece, bytes(r.ids))].append(r)
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    for i, text in enumerate(TEXTS):
        parts = sorted((r.piece, bytes(r.ids)) for r in found if r.doc_id == i)
        ids = np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist()
        wanted = whole_ids(encoder, text or "") + [2]
        assert ids == (wanted if i != 3 else ids) and (i != 3 or len(ids) == 2 * len(wanted))
    assert sum(r.doc_id is None for r in found) == 1


def test_an_empty_table_gives_nothing(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path(TOKENIZER)).count() == 0
