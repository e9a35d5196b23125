"""The thin queries against plain Python over the sample tables."""

import zlib

import numpy as np
from pyarrow.parquet import read_table
from tokenizers import Tokenizer

from marketloom.llm.queries import LOWER_CASE, QUERIES, tokenizer_path
from .test_bit_planes import brute as brute_clusters
from .test_spelling import brute_counts


def test_token_files(spark, sample):
    plain, start, wanted = Tokenizer.from_file(tokenizer_path(LOWER_CASE)), 0, []
    for row in sorted(read_table(f"{sample}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"]):
        ids = [*plain.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        wanted.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op13_token_files"](spark, sample).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in found) == wanted


def test_clusters(spark, sample):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(f"{sample}/embeddings.parquet").to_pylist()]
    found = QUERIES["op12_centroid_clusters"](spark, sample).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == sorted(brute_clusters(rows, 40)[0])


def test_spelling_words(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in read_table(f"{sample}/documents.parquet").to_pylist()]
    found = QUERIES["op11_spelling_variants"](spark, sample).collect()
    assert {r.word: r.n for r in found} == brute_counts(rows)
    assert all(r.form is None or r.form_n >= 10 * r.n and r.n_near > 0 for r in found)
