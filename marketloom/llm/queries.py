"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm.bit_planes import CENTROIDS, ROUNDS, cluster_report
from marketloom.llm.common import ship, table
from marketloom.llm.exact_dedup import exact_groups
from marketloom.llm.labelled_urls import labelled_urls
from marketloom.llm.lattice import encode_samples
from marketloom.llm.line_dedup import judge_lines
from marketloom.llm.near_dedup import near_groups
from marketloom.llm.packing import pack
from marketloom.llm.quality import judge_quality
from marketloom.llm.search import top_k
from marketloom.llm.spelling import spelling_variants
from marketloom.llm.substring_dedup import remove_repeats
from marketloom.llm.token_files import token_file_report
from marketloom.llm.toxicity import judge_toxicity
from marketloom.llm.toxicity import train as train_toxicity
from marketloom.llm.url_filter import judge_urls, train
from marketloom.session import shared_folder

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
LOWER_CASE = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# The rules of the url query.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES, train(labelled_urls(spark)))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path(TOKENIZER), with_ids=False)


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return judge_lines(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return judge_toxicity(docs, train_toxicity(docs, table(spark, folder, "labels")))


def op9_exact_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return top_k(docs, docs.filter("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"))


def op10_sentencepiece_samples(spark: SparkSession, folder: str) -> DataFrame:
    return encode_samples(table(spark, folder, "documents"), tokenizer_path(PIECES), with_ids=False)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_report(spark, table(spark, folder, "embeddings"))


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}/token_files"
    return token_file_report(table(spark, folder, "documents"), path, tokenizer_path(LOWER_CASE))


OPERATORS = (op1_url_filter, op2_quality_classifier, op3_exact_dedup, op4_substring_dedup, op6_simhash_near_dedup, op5_best_fit_packing, op7_line_dedup, op8_toxicity, op9_exact_top_k_search, op10_sentencepiece_samples, op11_spelling_variants, op12_centroid_clusters, op13_token_files)


def _with_code(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {query.__name__: _with_code(query) for query in OPERATORS}


def _clusters_sql() -> str:
    """Every round as two expressions: the nearest centroid of every vector, then the floored means."""
    parts = [f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept QUALIFY c < {CENTROIDS})"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT r, vec_id, k.v, c, list_sum(list_transform(list_zip(k.v, o.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM kept k CROSS JOIN c{n} o QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        parts.append(f"""c{n + 1} AS MATERIALIZED (
            SELECT c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
                FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{n}) GROUP BY c, i)
                GROUP BY c) m USING (c))""")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
            CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(o.v, ',')) AS centroid_sha256
        FROM a{ROUNDS} a JOIN c{ROUNDS} o USING (c)"""


SQL = {
    "op3_exact_dedup": """
        WITH n AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM n WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op4_substring_dedup": """
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), starts AS (SELECT doc_id, words, unnest(range(len(words) - 34)) AS s FROM w WHERE len(words) >= 35
        ), windows AS (SELECT doc_id, s, sha256(array_to_string(words[s + 1 : s + 35], ' ')) AS h FROM starts
        ), again AS (SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
        ), gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM again
        ), gone_lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN gone_lists USING (doc_id)
        )
        SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed,
            sha256(array_to_string(list_transform(
                list_filter(range(len(words)), lambda i: NOT list_contains(gone, i)), lambda i: words[i + 1]), ' ')) AS kept_sha256
        FROM kept
    """,
    "op9_exact_top_k_search": """
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[a-z0-9\\x{80}-\\x{10FFFF}]+')) AS term
            FROM documents
        ), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
        ), size AS (SELECT doc_id, sum(tf) AS size FROM tf GROUP BY doc_id
        ), whole AS (
            SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(size) FROM size) / (SELECT count(*) FROM documents) AS average
        ), idf AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, whole GROUP BY term, n
        ), weight AS (
            SELECT doc_id, term, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / average)) AS impact
            FROM tf JOIN size USING (doc_id), whole
        ), scored AS (
            SELECT q.doc_id AS query_id, w.doc_id, round(sum(q.tf * idf * impact), 6) AS score
            FROM tf q JOIN weight w USING (term) JOIN idf USING (term) WHERE q.doc_id % 100 = 0 GROUP BY ALL
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
    "op11_spelling_variants": """
        WITH RECURSIVE crc AS (
            SELECT list(c ORDER BY b) AS t FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
                FROM (SELECT unnest(range(256)) AS b))
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
            WHERE length(run) >= 7
        ), counted AS (
            SELECT run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM runs GROUP BY doc_id, run
        ), summed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda i: CAST('0x' || substr(bytes, i, 2) AS BIGINT))),
                lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) % length(run) AS place, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda i: CAST('0x' || substr(bytes, i, 2) AS BIGINT))),
                lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) % 31 = 0 AS cut
            FROM counted, crc
        ), words AS MATERIALIZED (
            SELECT CASE WHEN cut THEN left(run, place) || substr(run, place + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
            FROM summed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
        ), less AS MATERIALIZED (
            SELECT word, i, left(word, i) || substr(word, i + 2) AS v FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS near FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
            UNION SELECT l.word, w.word FROM less l JOIN words w ON l.v = w.word
            UNION SELECT w.word, l.word FROM less l JOIN words w ON l.v = w.word
        ), best AS (
            SELECT a.word, count(*) AS n_near, arg_min(near, (-b.n, near)) AS form FROM near a JOIN words b ON b.word = near GROUP BY a.word
        ), formed AS MATERIALIZED (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 10 * w.n THEN form END AS form, CASE WHEN f.n >= 10 * w.n THEN f.n END AS form_n
            FROM words w LEFT JOIN best USING (word) LEFT JOIN words f ON f.word = form
        ), chain AS (
            SELECT word, word AS root FROM formed WHERE form IS NULL
            UNION ALL SELECT f.word, c.root FROM chain c JOIN formed f ON f.form = c.word
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
    """,
    "op12_centroid_clusters": _clusters_sql(),
}
