"""Exact top-k search: BM25 over sharded inverted indexes with block maxima.

Every shard has the postings of its documents, in blocks of similar documents, and for its frequent terms
the largest weight in each block. What the rare terms give a document, and the block maxima of the
frequent ones, bound its score. Many queries are answered together: a panel of blocks is scored, by one product of
matrices, for those of them that it can give one of the k best, and only documents near the k-th best score are
scored in double precision. Term statistics are global, so the shards' best lists merge to the exact answer.

A fixed number of slots share the documents. A slot's task holds the queries, makes one shard after the other
of the documents that stream in, and keeps the best of all its shards, so queries are sent and answers
returned once for each slot, however many shards there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import BY_ALNUM, Words, group_bounds, slices, store

K1, B = 1.2, 0.75
BLOCK = 64
PANEL = 8
DENSE_SHARE = 1 / 40
DENSE_CELLS = 4 << 20
MARGIN = 1e-3
TERMS = 1 << 20
POSTINGS = 1 << 16
SCORES = 1 << 21
SHARD_BYTES = 20 << 20
SLOTS = 48
QUERY_BYTES = 96 << 20
DECIMALS = 6


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(text, term, count) of each distinct term of each text, sorted by text; the terms; the texts' lengths."""
    words = Words(texts, BY_ALNUM)
    codes, terms = words.encoded()
    lengths = np.diff(words.first)
    text = np.repeat(np.arange(len(lengths)), lengths)
    pairs, counts = np.unique(text * max(len(terms), 1) + codes, return_counts=True)
    return pairs // max(len(terms), 1), pairs % max(len(terms), 1), counts, terms, lengths


def statistics(docs: DataFrame) -> DataFrame:
    """(term, df, words) of each term; the row without a term has the number of documents and words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text"), 16 << 20):
                _, term, _, terms, lengths = term_counts(batch.column("text").slice(i, j - i))
                df = np.bincount(term, minlength=len(terms))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([terms.cast(pa.binary()), pa.array([None], pa.binary())]),
                        pa.array(np.append(df, len(lengths)).astype(np.int64)),
                        pa.array(np.append(np.zeros(len(df)), lengths.sum()).astype(np.int64)),
                    ],
                    names=["term", "df", "words"],
                )

    counts = docs.select("text").mapInArrow(counted, "term binary, df long, words long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))


def weighted_queries(queries: DataFrame, stats: DataFrame, n_docs: int) -> DataFrame:
    """(query_id, query_key, text, weights): each query's distinct terms with a space between them, and what each
    counts: inverse document frequency times repeats.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                text, term, count, terms, _ = term_counts(part.column("text"))
                at = pa.array(text)
                columns = [part.column("query_id").take(at), part.column("query_key").take(at), terms.cast(pa.binary()).take(pa.array(term)), pa.array(count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query_key", "term", "times"])

    terms = queries.mapInArrow(split, "query_id long, query_key long, term binary, times long")
    idf = F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = terms.join(stats.filter("term is not null"), "term").withColumn("weight", idf * F.col("times"))
    lists = terms.groupBy("query_id", "query_key").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    words = F.array_join(F.transform("terms.term", lambda t: t.cast("string")), " ")
    return lists.select("query_id", "query_key", words.alias("text"), F.col("terms.weight").alias("weights"))


def stretches(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes, given by their running sums, add up to about ``limit``; a larger item is a range of its own."""
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


class Shard:
    """The inverted index of some documents."""

    def __init__(self, ids: list[pa.Array], texts: list[pa.Array], average: float):
        self.ids = np.concatenate([np.asarray(pc.fill_null(i, 0)) for i in ids])
        self.null = np.concatenate([np.asarray(pc.is_null(i)) for i in ids])
        n = len(self.ids)
        parts, terms, base = [], [], 0
        lengths = []
        for texts_of in texts:
            for i, j in slices(texts_of):
                text, term, count, names, size = term_counts(texts_of.slice(i, j - i))
                parts.append(((text + base).astype(np.int32), term.astype(np.int32), count.astype(np.int32)))
                terms.append(names)
                lengths.append(size)
                base += j - i
        sizes = np.concatenate(lengths)
        coded = pa.chunked_array(terms).dictionary_encode().combine_chunks()
        self.terms = coded.dictionary
        numbers = np.asarray(coded.indices)
        starts = np.cumsum([0, *map(len, terms)])
        doc = np.concatenate([p[0] for p in parts])
        term = np.concatenate([numbers[s:][p[1]] for p, s in zip(parts, starts[:-1], strict=True)])
        tf = np.concatenate([p[2] for p in parts])
        del parts, terms, coded
        # Documents with the same most repeated term and about the same length are neighbours: tighter maxima.
        df = np.bincount(term, minlength=len(self.terms))
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        common = np.full(n, -1, np.int32)
        if len(first):
            common[doc[first]] = term[np.maximum.reduceat(tf.astype(np.int64) * len(tf) + np.arange(len(tf)), first) % len(tf)]
        order = np.lexsort((sizes, common))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.null = self.ids[order], self.null[order]
        norm = K1 * (1 - B + B * sizes / max(average, 1e-9))
        impact = tf * (K1 + 1) / (tf + norm[doc])
        doc = place[doc]
        by_term = np.argsort(term.astype(np.int64) * n + doc)
        tf, self.doc, self.impact = tf[by_term], doc[by_term], impact[by_term]
        del by_term, doc, impact, term
        self.norm = norm[order]
        self.start = np.concatenate(([0], np.cumsum(df)))
        self.block = BLOCK
        self.width = -(-n // (PANEL * BLOCK)) * PANEL * BLOCK
        frequent = np.flatnonzero(df > max(n * DENSE_SHARE, BLOCK))
        frequent = frequent[np.argsort(-df[frequent], kind="stable")][: DENSE_CELLS // max(self.width, 1)]
        self.row = np.full(len(self.terms), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.light = np.zeros((self.width, len(frequent)), np.float32)
        self.tf = np.zeros((len(frequent), n), np.min_scalar_type(int(tf.max(initial=0))))
        for row, t in enumerate(frequent.tolist()):
            some = slice(self.start[t], self.start[t + 1])
            self.light[self.doc[some], row] = self.impact[some]
            self.tf[row, self.doc[some]] = tf[some]
        self.maxima = self.light.reshape(self.width // BLOCK, BLOCK, len(frequent)).max(axis=1)

    def numbers(self, terms: pa.Array) -> np.ndarray:
        return np.asarray(pc.fill_null(pc.index_in(terms.cast(self.terms.type), value_set=self.terms), -1), dtype=np.int64)

    def best(self, of: np.ndarray, term: np.ndarray, weight: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, rounded score) of all documents that can be among the k best of some queries; only scores above zero.

        of: the query of each term, ascending, from 0 to the number of ``least``. Documents that stay under the query's ``least``
        may be left out. Single precision only chooses the documents: weights and impacts are not negative, so its error is a share of
        the score, under ``MARGIN``.
        """
        m, row = len(least), self.row[term]
        rare = row < 0
        known = self._rare_scores(of[rare], term[rare], weight[rare], m)
        of, row, weight = of[~rare], row[~rare], weight[~rare]
        used, column = np.unique(row, return_inverse=True)
        if 2 * len(used) > len(self.tf):
            used, column = slice(None), row
        light = np.zeros((m, len(self.tf[used])), np.float32)
        light[of, column] = weight
        bound = known.reshape(m, -1, self.block).max(axis=2) + light @ self.maxima[:, used].T
        bound = bound.reshape(m, -1, PANEL).max(axis=2) * (1 + MARGIN)
        floor = np.maximum((least - 2 * 10.0**-DECIMALS) * (1 - MARGIN), 0.4 * 10.0**-DECIMALS)
        ahead = np.zeros(bound.shape, bool)
        ahead[np.arange(m), bound.argmax(axis=1)] = True
        size, found = PANEL * self.block, []
        # The panel with the greatest bound comes first: its k-th best score tells which others are worth scoring.
        for now in (True, False):
            wanted = (ahead == now) & (bound >= floor[:, None])
            for panel in np.flatnonzero(wanted.any(axis=0)).tolist():
                queries, docs = np.flatnonzero(wanted[:, panel]), slice(panel * size, (panel + 1) * size)
                score = known[queries, docs] + (self.light[docs, used] @ light[queries].T).T
                if now and k <= size:
                    floor[queries] = np.maximum(floor[queries], np.partition(score, -k, axis=1)[:, -k] * (1 - MARGIN) ** 2)
                q, d = np.nonzero(score >= floor[queries, None])
                found.append((queries[q], d + panel * size, score[q, d]))
        q, d, score = map(np.concatenate, zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((-score, q))
        q, d, score = q[order], d[order], score[order]
        kth = np.searchsorted(q, np.arange(m)) + k - 1
        full = np.flatnonzero(kth < np.searchsorted(q, np.arange(m), "right"))
        floor[full] = np.maximum(floor[full], score[kth[full]] * (1 - MARGIN) ** 2)
        near = score >= floor[q]
        q, d = q[near], d[near]
        score = np.round(known[q, d] + self._frequent_scores(q, d, of, row, weight, m), DECIMALS)
        return q[score > 0], d[score > 0], score[score > 0]

    def _rare_scores(self, of: np.ndarray, term: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
        """What the terms give to each document, a row for each of ``m`` queries."""
        known = np.zeros((m, self.width))
        sizes = self.start[term + 1] - self.start[term]
        edges = np.searchsorted(of, np.arange(m + 1))
        for i, j in stretches(np.concatenate(([0], np.cumsum(sizes)))[edges[1:]], POSTINGS):
            some = slice(edges[i], edges[j])
            size = sizes[some]
            at = np.repeat(self.start[term[some]] - (np.cumsum(size) - size), size)
            at += np.arange(len(at))
            cell = np.repeat((of[some] - i) * self.width, size)
            cell += self.doc[at]
            given = self.impact[at]
            given *= np.repeat(weight[some], size)
            known[i:j] = np.bincount(cell, weights=given, minlength=(j - i) * self.width).reshape(j - i, self.width)
        return known

    def _frequent_scores(self, q: np.ndarray, d: np.ndarray, of: np.ndarray, row: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
        """What the frequent terms give to document d for query q, in double precision."""
        start = np.searchsorted(of, np.arange(m + 1))
        sizes = np.diff(start)[q]
        out = np.zeros(len(q))
        for i, j in stretches(np.cumsum(sizes), POSTINGS):
            some, doc = sizes[i:j], d[i:j]
            at = np.repeat(start[q[i:j]] - (np.cumsum(some) - some), some)
            at += np.arange(len(at))
            pair = np.repeat(np.arange(j - i), some)
            tf = self.tf[row[at], doc[pair]].astype(float)
            value = weight[at] * (tf * (K1 + 1) / (tf + self.norm[doc][pair]))
            out[i:j] = np.bincount(pair, weights=value, minlength=j - i)
        return out


class Asked:
    """The queries that a task answers, with the best documents found so far: a row for each query, zero where there is none."""

    def __init__(self, k: int):
        self.k = k
        self.parts: list[tuple] = []

    def add(self, batch: pa.RecordBatch) -> None:
        """Keeps numbers for the terms, and copies of the columns, so that the batch can go."""
        whole, weights = pa.array(np.arange(batch.num_rows)), batch.column("weights")
        coded = pc.list_flatten(pc.split_pattern(batch.column("text"), " ")).dictionary_encode()
        lengths = np.array(pc.list_value_length(weights))
        self.parts.append((batch.column("id").take(whole), batch.column("query_key").take(whole), coded, np.array(pc.list_flatten(weights)), lengths))

    def close(self) -> None:
        """All queries are there."""
        ids, keys, coded, weights, lengths = zip(*self.parts, strict=True)
        self.parts = []
        self.ids, self.keys = pa.concat_arrays(ids), pa.concat_arrays(keys)
        self.weight, self.start = np.concatenate(weights), np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
        del weights
        coded = pa.chunked_array(coded).unify_dictionaries()
        self.terms = coded.chunk(0).dictionary
        self.term = np.concatenate([np.asarray(c.indices) for c in coded.chunks])
        shape = (len(self.ids), self.k)
        self.score, self.doc, self.null = np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, bool)

    def answer(self, shard: Shard) -> None:
        """Adds a shard's documents to the best. Queries with about as many postings of rare terms are answered together."""
        number = shard.numbers(self.terms)
        for i, j in stretches(self.start[1:], TERMS):
            start = self.start[i : j + 1] - self.start[i]
            term = number[self.term[self.start[i] : self.start[j]]]
            sizes = np.where((term >= 0) & (shard.row[term] < 0), shard.start[term + 1] - shard.start[term], 0)
            postings = np.diff(np.concatenate(([0], np.cumsum(sizes)))[start])
            order = np.argsort(postings, kind="stable")
            for a, b in stretches(np.arange(1, j - i + 1) * shard.width, SCORES):
                some = order[a:b]
                count = np.diff(start)[some]
                of = np.repeat(np.arange(b - a), count)
                at = np.repeat(start[some] - (np.cumsum(count) - count), count) + np.arange(len(of))
                here = term[at] >= 0
                of, at = of[here], at[here]
                queries = some + i
                q, d, score = shard.best(of, term[at], self.weight[at + self.start[i]], self.score[queries, -1], self.k)
                self._add(queries[q], shard.ids[d], shard.null[d], score)

    def _add(self, of: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(of)
        row, rank = np.nonzero(self.score[touched])
        row = touched[row]
        of, score = np.concatenate((of, row)), np.concatenate((score, self.score[row, rank]))
        doc, null = np.concatenate((doc, self.doc[row, rank])), np.concatenate((null, self.null[row, rank]))
        order = np.lexsort((doc, null, -score, of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        of, rank, order = of[rank < self.k], rank[rank < self.k], order[rank < self.k]
        self.score[of, rank], self.doc[of, rank], self.null[of, rank] = score[order], doc[order], null[order]

    def found(self) -> pa.RecordBatch:
        of, rank = np.nonzero(self.score)
        at = pa.array(of)
        columns = [self.ids.take(at), self.keys.take(at), pa.array(self.doc[of, rank], mask=self.null[of, rank]), pa.array(self.score[of, rank])]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "query_key", "doc_id", "score"])


def slot_bests(rows: DataFrame, average: float, k: int, shard_bytes: int) -> DataFrame:
    """(query_id, query_key, doc_id, score): the k best of each task for each of its queries.

    rows: sorted by task and is_query, queries first.
    """

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, asked, ids, texts, size = None, None, [], [], 0
        for whole in batches:
            tasks, is_query = np.asarray(whole.column("task")), np.asarray(whole.column("is_query"))
            edges = group_bounds(tasks, is_query).tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                batch = whole.slice(a, b - a)
                if tasks[a] != task:
                    if ids:
                        asked.answer(Shard(ids, texts, average))
                        yield asked.found()
                    task, asked, ids, texts, size = tasks[a], None, [], [], 0
                if is_query[a]:
                    asked = asked or Asked(k)
                    asked.add(batch)
                    continue
                if not asked:
                    continue
                if asked.parts:
                    asked.close()
                for i, j in slices(batch.column("text"), shard_bytes):
                    part = batch.slice(i, j - i)
                    more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                    if ids and size + more > shard_bytes:
                        asked.answer(Shard(ids, texts, average))
                        ids, texts, size = [], [], 0
                    ids.append(part.column("id"))
                    texts.append(part.column("text"))
                    size += more
        if ids:
            asked.answer(Shard(ids, texts, average))
            yield asked.found()

    schema = "query_id long, query_key long, doc_id long, score double"
    return rows.mapInArrow(answered, schema)


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents for each query: query_id, rank, doc_id, score (BM25, six decimals).

    docs: doc_id, text; queries: query_id, text. Terms are runs of ASCII letters and digits and of other
    characters, A-Z lower-cased; a query's repeats count. Ties go to the smaller doc_id, null ids last. Only
    documents that share a term are listed, so null, empty and unknown queries have no rows. Equal query rows
    are one query; rows with one id and different texts are ranked apart. Repeated documents are all ranked.

    A task indexes ``shard_bytes`` of text at a time and holds about ``query_bytes`` of queries; where they are more,
    groups of queries are answered apart, and every group reads the documents.
    """
    stats = store(statistics(docs), "terms")
    whole = stats.filter("term is null").first()
    n_docs, n_words = (whole.df, whole.words) if whole else (0, 0)
    queries = queries.select("query_id", F.xxhash64("text").alias("query_key"), "text").distinct()
    weighted = store(weighted_queries(queries, stats, n_docs), "queries")
    size = weighted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // query_bytes))
    slots = max(SLOTS, docs.sparkSession.sparkContext.defaultParallelism)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))

    def dealt(n: int, *by: str) -> Column:
        return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")

    nothing = F.lit(None)
    corpus = docs.select(
        dealt(slots, "doc_id", "text").alias("slot"), every(groups).alias("group"),
        F.lit(0).alias("is_query"), F.col("doc_id").alias("id"), nothing.cast("long").alias("query_key"), "text",
        nothing.cast("array<double>").alias("weights"),
    )
    asked = weighted.select(
        every(slots).alias("slot"), dealt(groups, "query_id", "query_key").alias("group"),
        F.lit(1).alias("is_query"), F.col("query_id").alias("id"), "query_key", "text", "weights",
    )
    rows = corpus.unionByName(asked).select((F.col("group") * slots + F.col("slot")).alias("task"), "is_query", "id", "query_key", "text", "weights")
    rows = rows.repartitionById(slots * groups, "task").sortWithinPartitions("task", F.desc("is_query"))
    bests = slot_bests(rows, n_words / max(n_docs, 1), k, shard_bytes)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return bests.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
