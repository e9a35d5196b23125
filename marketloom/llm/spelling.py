"""Spelling variants: words one edit apart, found by a frontier that walks a trie level by level.

The trie is a table of edges. A state (word, position, node, edits) says that the first ``position`` signs of the word lead
to ``node`` with so many edits; every round joins all states with the edges of their nodes. An edit can only lie
where another word leaves the path of the word itself, and it has half of the word either before or behind it. So the
words are read forwards and backwards, in one trie each, and a walk begins at the node of its word's first half:
the crowded nodes near the root, where every word would try every letter, are never visited.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import store

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DROP_ONE_IN = 31
MORE_COMMON = 10
FORWARDS, BACKWARDS = ">", "<"
# Depths (after the sign of the direction) at which every path has a node, so that walks can begin there.
FIRST_DEPTH, LAST_DEPTH = LEAST_LENGTH // 2 + 1, 7
EDGES = "node string, label string, terminal boolean"
FLUSH = 20_000


def word_counts(docs: DataFrame, drop_one_in: int = DROP_ONE_IN, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: runs of letters with A-Z lower-cased, of so many code points and occurrences at least.

    Where the crc32 of ``<doc_id>:<run>`` is a multiple of ``drop_one_in``, one code point of the run is deleted. A null
    text has no runs; a null doc_id is written as nothing.
    """
    runs = docs.select("doc_id", F.explode(F.split("text", f"[^{LETTERS}]+")).alias("run")).filter(F.length("run") >= least_length)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length("run") == F.length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", upper, upper.lower()))
    runs = runs.select("doc_id", lowered.alias("run"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    runs = runs.select("run", F.crc32(key.cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % drop_one_in == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def common_length(a: str, b: str) -> int:
    size = min(len(a), len(b))
    for i in range(size):
        if a[i] != b[i]:
            return i
    return size


def trie_edges(words: Iterator[tuple[str, str | None, str | None, bool]]) -> Iterator[tuple[str, str, bool]]:
    """(node, label, whether node + label is a word) of the compressed trie of sorted words.

    ``words`` are (word, the word before the range of words it belongs to, the word behind that range, whether it is the
    first of its range). Nodes are prefixes. The path of the last word is held as a stack of depths with their
    terminal flags; edges are given out when the path is left. Prefixes that reach over the border of a range are nodes at every depth,
    in every range that has them, so ranges agree about the edges they share.
    """
    path: list[tuple[int, bool]] = []
    last, behind = "", None

    def leave(depth: int) -> Iterator[tuple[str, str, bool]]:
        """Edges below ``depth``, which becomes the end of the path."""
        while len(path) > 1 and path[-1][0] > depth:
            end, terminal = path.pop()
            start = max(path[-1][0], depth)
            yield last[:start], last[start:end], terminal
            if start > path[-1][0]:
                path.append((depth, False))

    def finish() -> Iterator[tuple[str, str, bool]]:
        if path:
            shared = common_length(last, behind) if behind is not None else 0
            flags = dict(path)
            for depth in range(FIRST_DEPTH, shared + 1):
                flags.setdefault(depth, False)
            path[:] = sorted(flags.items())
            yield from leave(path[0][0])

    for word, before, after, first in words:
        if first:
            yield from finish()
            path, behind = [], after
            keep = common_length(before, word) if before is not None else 0
        else:
            keep = common_length(last, word)
            if keep < FIRST_DEPTH:
                if path:
                    # Another trie begins: all of the last path is left.
                    yield from leave(path[0][0])
                path = []
            else:
                yield from leave(keep)
        depths = dict(path)
        top = max(depths, default=0)
        for depth in range(FIRST_DEPTH, max(LAST_DEPTH, keep if first else 0) + 1):
            if top < depth < len(word):
                depths.setdefault(depth, False)
        depths[len(word)] = True
        path = sorted(depths.items())
        last = word
    yield from finish()


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[str, str | None, str | None, bool]]:
        part = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "word", "before", "after")]
            for number, word, before, after in zip(*columns, strict=True):
                yield word, before, after, number != part
                part = number

    def table(out: list[tuple]) -> pa.RecordBatch:
        nodes, labels, ends = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(labels, pa.string()), pa.array(ends, pa.bool_())], names=["node", "label", "terminal"])

    out: list[tuple] = []
    for edge in trie_edges(rows()):
        out.append(edge)
        if len(out) >= FLUSH:
            yield table(out)
            out = []
    if out:
        yield table(out)


def edge_table(words: DataFrame) -> DataFrame:
    """One row an edge: node, its depth, label, whether the child is a word, the first letters that lead on from the child.

    The words are sorted into ranges; a task builds the edges of its ranges from neighbouring words alone. A node has at most
    one child a letter.
    """
    ranged = store(words.repartitionByRange("word").sortWithinPartitions("word").withColumn("part", F.spark_partition_id()), "ranges")
    ends = ranged.groupBy("part").agg(F.min("word").alias("low"), F.max("word").alias("high"))
    order = Window.orderBy("part")  # one row per range
    borders = ends.select("part", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    sorted_words = ranged.join(F.broadcast(borders), "part").repartition("part").sortWithinPartitions("part", "word")
    edges = sorted_words.select("part", "word", "before", "after").mapInArrow(_built, EDGES)
    edges = store(edges.groupBy("node", "label").agg(F.max("terminal").alias("terminal")), "edges")
    letters = edges.groupBy("node").agg(F.array_join(F.collect_set(F.left("label", F.lit(1))), "").alias("next"))
    child = edges.withColumn("child", F.concat("node", "label")).join(letters.withColumnRenamed("node", "child"), "child", "left")
    return store(child.select("node", F.length("node").alias("depth"), "label", "terminal", F.coalesce("next", F.lit("")).alias("next")), "nodes")


def _half(word: Column) -> Column:
    """The depth from which on edits are tried: the sign of the direction and half of the word."""
    return F.floor((F.length(word) - 1) / 2).cast("int") + 1


def _rest(word: Column, start: Column) -> Column:
    return F.substring(word, start + 1, F.length(word))


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge further. Those with ``found`` have ended at another word, with one edit."""
    pairs = states.filter("found IS NULL").drop("found").join(edges, "node")
    rest = _rest(F.col("word"), F.col("position"))
    pairs = pairs.withColumns({"rest": rest, "own": F.left(rest, F.lit(1)), "head": F.left("label", F.lit(1)), "size": F.length("label")})
    unedited, same = F.col("edits") == 0, F.col("own") == F.col("head")
    may_edit = unedited & (F.col("position") >= _half(F.col("word"))) & ~same
    pairs = pairs.filter(same | may_edit)
    tail = _rest(F.col("label"), F.lit(1))
    replaced = may_edit & (F.col("own") != "") & (F.col("head") > F.col("own")) & _rest(F.col("rest"), F.lit(1)).startswith(tail)
    ways = F.array(
        F.struct((same & F.col("rest").startswith(F.col("label"))).alias("goes"), F.col("size").alias("eaten"), F.col("edits").alias("spent")),
        F.struct(replaced.alias("goes"), F.col("size").alias("eaten"), F.lit(1).alias("spent")),
        F.struct((may_edit & F.col("rest").startswith(tail)).alias("goes"), (F.col("size") - 1).alias("eaten"), F.lit(1).alias("spent")),
    )
    moved = pairs.select("word", "position", "node", "label", "terminal", "next", F.inline(ways)).filter("goes")
    end, child = F.col("position") + F.col("eaten"), F.concat("node", "label")
    at_end = end == F.length("word")
    found = F.when((F.col("spent") == 1) & at_end & F.col("terminal"), child)
    onward = F.when(F.col("spent") == 0, F.col("next") != "").otherwise(~at_end & F.col("next").contains(F.substring("word", end + 1, F.lit(1))))
    return moved.select("word", end.alias("position"), child.alias("node"), F.col("spent").alias("edits"), found.alias("found"), onward.alias("onward")).filter(
        "found IS NOT NULL OR onward"
    ).drop("onward")


def near_words(words: DataFrame) -> DataFrame:
    """word and near: all ordered pairs of different words one inserted, deleted or replaced code point apart.

    ``words`` has the distinct words of at least seven code points. Sizes follow the number of words and of their near words;
    no bucket of words is compared with itself. A replaced letter is found at the smaller one, an inserted one at
    the shorter word, and given out both ways. The rounds end when no state is left, after as many as the longest
    common half path has branches.
    """
    signed = words.select(F.concat(F.lit(FORWARDS), "word").alias("word")).union(words.select(F.concat(F.lit(BACKWARDS), F.reverse("word"))))
    signed = store(signed, "signed")
    nodes = edge_table(signed)
    start = F.least(_half(F.col("word")), F.lit(LAST_DEPTH))
    states = signed.select("word", start.alias("position"), F.left("word", start).alias("node"), F.lit(0).alias("edits"), F.lit(None).cast("string").alias("found"))
    levels: list[DataFrame] = []
    while True:
        deeper = nodes.filter(F.col("depth") >= FIRST_DEPTH + len(levels))  # every round goes a letter deeper at least
        states = store(_step(states, deeper), f"level_{len(levels)}")
        levels.append(states.filter("found IS NOT NULL").select("word", "found"))
        if states.filter("found IS NULL").isEmpty():
            break
    pairs = levels[0]
    for level in levels[1:]:
        pairs = pairs.union(level)

    def plain(name: str) -> Column:
        text = F.substring(name, 2, 1 << 30)
        return F.when(F.left(name, F.lit(1)) == BACKWARDS, F.reverse(text)).otherwise(text)

    pairs = pairs.select(plain("word").alias("word"), plain("found").alias("near"))
    both = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.distinct().select(F.inline(both))


def variant_groups(counts: DataFrame, more_common: int = MORE_COMMON) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``counts`` (word, n).

    form: the commonest near word (ties: the first in code-point order) if it is ``more_common`` times as common, else null; root: the last
    form of a word's forms. Every form is that much commoner than its word, so a chain of forms grows with the logarithm of the largest
    count, and its length halves every round. An empty table gives no rows.
    """
    counts = store(counts, "counts")
    near = near_words(counts.select("word"))
    common = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(common, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    whole = counts.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    is_form = F.col("form_n") >= more_common * F.col("n")
    formed = whole.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    formed = store(formed, "forms")
    steps = store(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = steps.join(further, "root", "left")
        steps = store(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("on")), "steps")
        if steps.filter("on").isEmpty():
            break
        steps = steps.drop("on")
    roots = steps.select("word", "root")
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variant groups of the words of whole texts; nulls, repeated rows and long texts count as in ``word_counts``."""
    return variant_groups(word_counts(docs))
