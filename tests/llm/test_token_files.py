import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketloom.llm.queries import tokenizer_path
from marketloom.llm.token_files import (
    LowerCaseEncoder, read_manifest, read_span, read_tokens, token_file_report, write_tokens,
)

WORDS = tokenizer_path("word_bpe_49k.json")
TEXTS = [
    None, "", "  ", "a", "Don't  STOP", "it''s 'stuff 're '", "x" * 5000, "Word9 12 " * 3000, "été ÀÉÎÕÜ ß × ÷ ÿ Þ", "été Å",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|EndOfText|>", "tab\tline\nnbsp em x", "a\x1cb\x85c \x00 \x7f", "ΣΑΣ İI ǅ", "日本語 text", "...!!! a.b,c-d",
    "́lead", "Ã̃ Ã", "½ ² 3²", "a ́b",
]


@pytest.fixture(scope="module")
def encoder():
    return LowerCaseEncoder(WORDS)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(WORDS)


def encoded(encoder, texts):
    ids, first = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB'1 .,!\n\té Àß×÷́\x1c\x85sdtlΣ"), max_size=30), max_size=4))
def test_runs_give_the_ids_of_the_whole_text(encoder, plain, texts):
    assert encoded(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_any_signs(encoder, plain, texts):
    assert encoded(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_and_whole_sample_texts(encoder, plain, sample):
    texts = TEXTS + pq.read_table(f"{sample}/documents.parquet")["text"].to_pylist() + ["".join(chr(c) + ("" if c % 3 else " x") for c in range(1, 0x500))]
    assert encoded(encoder, texts) == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def expected(plain, rows):
    """(doc_id, start, n_tokens, crc) by a plain loop; rows are in the order of their ids already."""
    start = 0
    for doc_id, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_report_equals_a_plain_loop(spark, plain, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a")]
    docs = spark.createDataFrame([(i, t, 0, [1]) for i, t in reversed(rows)] + [(None, "no id", 7, [2])], "doc_id long, text string, start int, ids array<int>").repartition(3)
    found = [tuple(r) for r in token_file_report(docs, f"{tmp_path}/t", WORDS).collect()]
    wanted = list(expected(plain, sorted(rows, key=lambda r: r[0]) + [(None, "no id")]))
    key = lambda r: r[1]
    assert sorted(found, key=key) == wanted


def test_sample_in_order_of_ids(spark, plain, sample, tmp_path):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    found = sorted((tuple(r) for r in token_file_report(docs, f"{tmp_path}/t", WORDS).collect()), key=lambda r: r[1])
    assert found == list(expected(plain, [tuple(r) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]))


def test_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_file_report(docs, f"{tmp_path}/t", WORDS).count() == 0
    assert read_span(spark, f"{tmp_path}/t", 0, 10).count() == 0


def test_files_have_encodings_groups_and_page_indexes(spark, sample, tmp_path):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    write_tokens(docs, f"{tmp_path}/t", WORDS, group_bytes=1 << 18, page_bytes=1 << 12, page_rows=20)
    file = pq.ParquetFile(max((tmp_path / "t" / "tokens").glob("*.parquet"), key=lambda p: p.stat().st_size))
    assert file.metadata.num_row_groups > 1
    columns = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i) for i in range(file.metadata.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert all("DELTA_BINARY_PACKED" in columns[c].encodings for c in ("doc_id", "start", "n_tokens"))
    assert all(c.has_column_index and c.has_offset_index for name, c in columns.items() if name != "ids.list.element") and columns["ids.list.element"].has_offset_index


def test_metadata_reads_leave_the_tokens_alone(spark, sample, tmp_path):
    write_tokens(spark.read.parquet(f"{sample}/documents.parquet"), f"{tmp_path}/t", WORDS)
    tokens = read_tokens(spark, f"{tmp_path}/t")
    plan = tokens.filter("doc_id between 5 and 7").select("doc_id", "start", "n_tokens")._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "doc_id" in line]
    assert scans and all("ids" not in line.split("ReadSchema: ")[1] and "GreaterThanOrEqual(doc_id,5)" in line for line in scans)
    manifest = read_manifest(spark, f"{tmp_path}/t")
    assert manifest.agg({"n_docs": "sum"}).first()[0] == tokens.count()


def test_spans_are_cuts_of_the_whole_sequence(spark, sample, tmp_path):
    write_tokens(spark.read.parquet(f"{sample}/documents.parquet").repartition(4), f"{tmp_path}/t", WORDS)
    rows = sorted(read_tokens(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    whole = [i for r in rows for i in r.ids]
    for start, stop in ((0, 1), (0, len(whole)), (777, 4321), (len(whole) - 3, len(whole) + 5), (50, 50)):
        found = sorted(read_span(spark, f"{tmp_path}/t", start, stop).collect(), key=lambda r: r.start)
        assert [i for r in found for i in r.ids] == whole[start:stop]
