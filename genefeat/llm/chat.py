"""Chat formatting (5): drop logged conversations that are a prefix of a longer one, then render the rest.

Turns of a conversation are ordered by (turn, role, text) and numbered from 1; the hash of a prefix is the running sum
of hashes of (number, role, text), two sums of 64 bits each. Sums can be taken in any order and over parts, so a
conversation with very many turns is numbered and summed range by range: rows are dealt by range of (conversation,
turn, role, text), each range is numbered on its own, and a range's offset is the count and sum of those before it.
A conversation whose whole hash is the prefix hash of a longer conversation is a snapshot of it and leaves: more
conversations then have that prefix than end with it. Of equal conversations the smallest id stays.

All of this moves hashes of texts; texts themselves go along only where turns share number and role, whose order they
decide, and at the end where the turns that stay are rendered. Rendering gives `<|role|>` blocks, in parts of `part_turns`
turns, so no row grows with the conversation's length.

Defined results: rows that repeat in full are one turn; turns with a null conv_id are rendered as one conversation,
which stays, has one copy and drops no other; null turns come first; null roles and texts render as empty and differ
from empty ones in the hash; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, save

KEYS = ["ck", "tk", "rk", "a", "b"]  # conversation, turn and role as texts that are never null, and the text's hashes
NO_ID = "-"


def _told(column: str) -> Column:
    """A text that tells null and empty apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(NO_ID))


def keyed(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    picked = conversations.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return picked.select("*", _told("conv").alias("ck"), _told("turn").alias("tk"), _told("role").alias("rk"), F.xxhash64(_told("text")).alias("a"), F.xxhash64(F.lit(1), _told("text"), F.lit(2)).alias("b"))


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """(conv, KEYS, number, h1, h2) of keyed() rows: a row for each turn with the hash of the prefix that it ends."""
    turns = save(rows.groupBy(*KEYS).agg(*(F.first(c).alias(c) for c in ("conv", "turn", "role"))))
    several = turns.groupBy("ck", "tk", "rk").count().filter("count > 1").select("ck", "tk", "rk")
    if several.isEmpty():
        turns = turns.withColumn("tie", F.lit(None).cast("string"))
    else:
        texts = rows.join(several, ["ck", "tk", "rk"], "left_semi").groupBy(*KEYS).agg(F.first("text").alias("tie"))
        turns = turns.join(texts, KEYS, "left")
    order = ["turn", "role", "tie", "a", "b"]
    dealt = save(turns.repartitionByRange(partitions(rows.sparkSession), "ck", *order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("ck", "range").orderBy(*order)
    so_far = Window.partitionBy("ck").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("ck", "range").count().select("ck", "range", F.coalesce(F.sum("count").over(so_far), F.lit(0)).alias("n_before"))
    numbered = dealt.withColumn("own", F.row_number().over(inside)).join(before, ["ck", "range"]).withColumn("number", F.col("own") + F.col("n_before"))
    hashed = save(numbered.select("conv", *KEYS, "range", "number", F.xxhash64("number", "rk", "a", "b").cast("decimal(20,0)").alias("x1"), F.xxhash64(F.lit(1), "b", "rk", "a", "number").cast("decimal(20,0)").alias("x2")))
    running = Window.partitionBy("ck", "range").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    offsets = hashed.groupBy("ck", "range").agg(F.sum("x1").alias("t1"), F.sum("x2").alias("t2")).select("ck", "range", *(F.coalesce(F.sum(f"t{i}").over(so_far), F.lit(0)).alias(f"o{i}") for i in (1, 2)))
    joined = hashed.withColumns({"s1": F.sum("x1").over(running), "s2": F.sum("x2").over(running)}).join(offsets, ["ck", "range"])
    return joined.select("conv", *KEYS, "number", *((F.col(f"s{i}") + F.col(f"o{i}")).cast("decimal(38,0)").alias(f"h{i}") for i in (1, 2)))


def maximal(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns of the conversations that stay, a row (conv, ck, n_turns, n_copies) for each of these)."""
    turns = save(prefix_hashes(rows))
    hashes = ["number", "h1", "h2"]
    whole = turns.groupBy("ck").agg(F.min("conv").alias("conv"), F.max(F.struct(*hashes)).alias("w")).select("ck", "conv", "w.*")
    known = F.col("ck") != NO_ID
    ends = whole.filter(known).groupBy(*hashes).agg(F.min_by("ck", "conv").alias("ck"), F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    held = turns.filter(known).groupBy(*hashes).agg(F.count("*").alias("n"))
    columns = "conv", "ck", F.col("number").alias("n_turns"), "n_copies"
    kept = ends.join(held, hashes).filter("n = n_copies").select(*columns)
    kept = save(kept.unionByName(whole.filter(~known).withColumn("n_copies", F.lit(1).cast("bigint")).select(*columns)))
    return turns.join(kept.select("ck"), "ck", "left_semi"), kept


def render(turns: DataFrame, rows: DataFrame, part_turns: int = 256) -> DataFrame:
    """(ck, part, rendered) of turns, with the texts of rows."""
    texts = rows.groupBy(*KEYS).agg(F.first("role").alias("role"), F.first("text").alias("text"))
    block = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    told = texts.join(turns.select(*KEYS, "number"), KEYS).select("ck", F.floor((F.col("number") - 1) / part_turns).alias("part"), F.struct("number", block.alias("block")).alias("x"))
    return told.groupBy("ck", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["block"]), "").alias("rendered"))


def format_chats(conversations: DataFrame, part_turns: int = 256, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conversation id, part, n_turns, n_copies, rendered): the maximal conversations, rendered."""
    rows = keyed(conversations, id_col, turn_col, role_col, text_col)
    turns, kept = maximal(rows)
    return render(turns, rows, part_turns).join(kept, "ck").select(F.col("conv").alias(id_col), "part", F.col("n_turns").cast("bigint").alias("n_turns"), "n_copies", "rendered")
