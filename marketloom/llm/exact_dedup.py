"""Exact duplicates by deterministic block naming.

Each normalised text is cut into fixed-size blocks. The distinct blocks are sorted and numbered; then the
distinct pairs of adjacent names are numbered in turn, and so on until every document has one name. A
name stands for exactly one sequence of blocks, so equal identities mean equal texts: no hash decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import BLANK_CLASS, store

BLOCK_CHARS = 4096
NO_RIGHT = -1


def normalised(text: Column) -> Column:
    """Runs of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS + "+", " ")


def _blocks(text: Column, size: int) -> Column:
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(parts) == 0, F.array(F.lit(""))).otherwise(parts)


def _named(df: DataFrame, keys: list[str], label: str, keep: list[str]) -> DataFrame:
    """The distinct rows of ``keys``, sorted within their partitions and numbered."""
    distinct = df.select(*keys).distinct().sortWithinPartitions(*keys)
    return store(distinct.withColumn("name", F.monotonically_increasing_id()).select(*keep, "name"), label)


def _block_names(texts: DataFrame, rows: DataFrame, hash_bits: int) -> DataFrame:
    """(row, pos, name) of every block.

    Names belong to block contents. Blocks find their name by a short hash, so that contents cross the
    network once; contents that share a hash with another content are named and joined by content.
    """
    blocks = texts.select("row_key", F.posexplode("blocks").alias("pos", "block"))
    blocks = blocks.select("row_key", "pos", "block", _short(F.col("block"), hash_bits).alias("h"))
    names = _named(blocks, ["h", "block"], "block_names", ["h"])
    found = rows.select("row", F.posexplode("hashes").alias("pos", "h"))
    clashes = names.groupBy("h").count().filter("count > 1").select("h")
    if clashes.isEmpty():
        return found.join(names, "h").select("row", "pos", "name")
    clashes = store(clashes, "clashes")
    alone = found.join(names.join(clashes, "h", "left_anti"), "h").select("row", "pos", "name")
    crowded = blocks.join(clashes, "h", "left_semi")
    contents = _named(crowded, ["h", "block"], "clash_names", ["h", "block"]).withColumn("name", -2 - F.col("name"))
    by_text = crowded.join(contents, ["h", "block"]).select("row_key", "pos", "name").distinct()
    keys = rows.select("row", F.struct("doc_id", "text_sha256").alias("row_key"))
    return alone.unionByName(
        keys.join(by_text, keys.row_key.eqNullSafe(by_text.row_key)).select("row", "pos", "name")
    )


def _short(block: Column, bits: int) -> Column:
    h = F.xxhash64(block)
    return h if bits >= 64 else h.bitwiseAND(F.lit((1 << bits) - 1))


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after blank runs become one space; null counts as empty, and
    empty texts are equal to each other. The row with the smallest doc_id of a group stays (null ids come
    last; among rows that share the smallest id, one stays). An empty table gives an empty result; other
    columns of ``docs`` are ignored. ``hash_bits`` below 64 is for tests of clashing hashes.
    """
    text = normalised(F.col("text"))
    texts = docs.select("doc_id", text.alias("norm"))
    texts = texts.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), _blocks(F.col("norm"), block_chars).alias("blocks"))
    hashes = F.transform("blocks", lambda b: _short(b, hash_bits))
    rows = store(
        texts.select("doc_id", "text_sha256", hashes.alias("hashes")).withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    texts = texts.select(F.struct("doc_id", "text_sha256").alias("row_key"), "blocks")
    current = _block_names(texts, rows, hash_bits)
    sizes = rows.select("row", F.size("hashes").alias("n"))
    current = current.join(sizes, "row")
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 0
    done: list[DataFrame] = []
    level = 0
    while True:
        if longest > 1:
            current = store(current, f"names_{level}")
        done.append(current.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        pairs = (
            current.filter("n > 1")
            .groupBy("row", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_RIGHT)).alias("r"),
                F.expr("(first(n) + 1) div 2").cast("int").alias("n"),
            )
        )
        pairs = store(pairs, f"pairs_{level}")
        names = _named(pairs, ["l", "r"], f"pair_names_{level}", ["l", "r"])
        current = pairs.join(names, ["l", "r"]).select("row", "pos", "name", "n")
        longest = (longest + 1) // 2
        level += 1
    identities = done[0]
    for part in done[1:]:
        identities = identities.unionByName(part)
    members = store(rows.drop("hashes").join(identities, "row"), "identities")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    groups = members.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    return members.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
