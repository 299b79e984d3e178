"""Conversation prefix trie (12): each distinct beginning of conversations once, with totals over its subtree.

Turns are numbered and prefixes hashed as in chat.py, by running sums over ranges of rows, so one conversation may hold
any share of them. A node is a prefix; its smallest member and its depth name it, as a conversation has one prefix of each
depth. The hash of the prefix before, which names the parent, is the running sum without the last turn.

Totals over subtrees come from parallel tree contraction. In turn, a join round rakes all leaves (their totals are added
to their parents, after partial sums) and then compresses all chains of nodes with a single child left: pointers double
until each node of a chain knows the sum down to what ends it, and the chain is cut out. Each pass leaves every inner node
with two children at least, so passes are logarithmic in the number of nodes, whatever the depth. Then the compressed
nodes are expanded again, in reverse order: a node's total is its own sum and the total of what ended its chain.

A parent with very many children, or the end of a very long chain, is a hot key of a join: keys with more than a
thousandth of the rows are at most a thousand and are broadcast, the others shuffle.

Defined results: turns with a null conversation id belong to none and add nothing; null turns come first and equal ones
by role, then text; a null role or text is empty; rows that repeat are turns each on its own; an empty table has no nodes.
Other columns are not looked at. Turns are compared by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_saved, partitions, save

_HOT = 1000
_IDS = 1000  # of a text of joined ids
NODE = ["depth", "h1", "h2"]
TOTALS = ["n_leaves", "saved_tokens"]


def hot_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """big joined with small, whose keys are unique: the keys that over 1/_HOT of big's rows have, _HOT at most, go to
    big, so none of them is one task."""
    counts = save(big.groupBy(*keys).count().filter(F.col("count") > 1))
    limit = big.count() // _HOT
    hot = F.broadcast(counts.filter(F.col("count") > limit).select(*keys))
    other = big.join(hot, keys, "left_anti")
    often = big.join(hot, keys, "left_semi").join(F.broadcast(small.join(hot, keys, "left_semi")), keys, how)
    return other.join(small, keys, how).unionByName(often)


def _by_ranges(rows: DataFrame, conv: str, order: list[Column | str]) -> DataFrame:
    """rows with `range`, sorted ranges of (conv, order) that are partitions each."""
    return save(rows.repartitionByRange(partitions(rows.sparkSession), conv, *order).withColumn("range", F.spark_partition_id()))


def _so_far(conv: str) -> Window:
    return Window.partitionBy(conv).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)


def numbered_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, number from 1, a, b, bytes): the turns in order, as hashes and the size of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # Where conversation, turn and role are equal, texts decide and move along; elsewhere their hashes do alone.
    keys = ["conv", "turn_key", "role"]
    rows = rows.withColumn("turn_key", F.coalesce(F.col("turn").cast("string"), F.lit("-")))
    ties = save(rows.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit(True).alias("tied")))
    hashed = rows.select("turn", *keys, "text", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"), F.octet_length("text").cast("bigint").alias("bytes"))
    if ties.isEmpty():
        hashed = hashed.drop("text").withColumn("tie", F.lit(None).cast("string"))
    else:
        hashed = hot_join(hashed, ties, keys, "left").withColumn("tie", F.when(F.col("tied"), F.col("text"))).drop("text", "tied")
    order = ["turn", "role", "tie"]
    dealt = _by_ranges(hashed.drop("turn_key"), "conv", order)
    before = dealt.groupBy("conv", "range").count().select("conv", "range", F.coalesce(F.sum("count").over(_so_far("conv")), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order))
    out = save(dealt.withColumn("own", own).join(before, ["conv", "range"]).select("conv", (F.col("own") + F.col("before")).alias("number"), "a", "b", "bytes"))
    drop_saved(ties, dealt)
    return out


def shared_starts(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(convs, turns) where each conversation c begins with the first h turns of conversation c - c % group in place of
    its own first h, h = crc32(c) % most. convs: (conv), all of turns; turns as numbered_turns()."""
    convs = save(turns.groupBy("conv").agg(F.max("number").alias("n")))
    h = (F.crc32(F.col("conv").cast("string")) % most).cast("bigint")
    planned = convs.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), h.alias("h"))
    heads = turns.filter(F.col("number") < most).withColumnRenamed("conv", "base")
    first = heads.join(planned, "base").filter("number <= h").select("conv", "number", "a", "b", "bytes")
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    offsets = planned.join(sizes, "base", "left").select("conv", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("have"))
    rest = hot_join(turns, offsets, ["conv"]).filter("number > h").select("conv", (F.col("number") - F.col("h") + F.col("have")).alias("number"), "a", "b", "bytes")
    return convs.select("conv"), save(first.unionByName(rest))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, h1, h2, p1, p2, bytes): a row for each turn with the hashes of the prefix that it ends, of the one
    before, and the size of its text."""
    hashed = turns.select("conv", "number", "bytes", F.xxhash64("number", "a", "b").cast("decimal(20,0)").alias("x1"), F.xxhash64(F.lit(1), "b", "a", "number").cast("decimal(20,0)").alias("x2"))
    dealt = _by_ranges(hashed, "conv", ["number"])
    offsets = dealt.groupBy("conv", "range").agg(F.sum("x1").alias("t1"), F.sum("x2").alias("t2")).select("conv", "range", *(F.coalesce(F.sum(f"t{i}").over(_so_far("conv")), F.lit(0)).alias(f"o{i}") for i in (1, 2)))
    running = Window.partitionBy("conv", "range").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    joined = dealt.withColumns({"s1": F.sum("x1").over(running), "s2": F.sum("x2").over(running)}).join(offsets, ["conv", "range"])
    h = [(F.col(f"s{i}") + F.col(f"o{i}")).cast("decimal(38,0)") for i in (1, 2)]
    before = [(x - F.col(f"x{i}")).cast("decimal(38,0)") for i, x in enumerate(h, 1)]
    out = save(joined.select("conv", F.col("number").cast("bigint").alias("depth"), h[0].alias("h1"), h[1].alias("h2"), before[0].alias("p1"), before[1].alias("p2"), "bytes"))
    drop_saved(dealt)
    return out


def trie_nodes(convs: DataFrame, found: DataFrame) -> DataFrame:
    """(depth, h1, h2, conv_id, n_convs, bytes, parent_conv_id, n_children): a row for each node."""
    zero = lambda name: F.lit(0).cast("decimal(38,0)").alias(name)
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(F.lit(0).cast("bigint").alias("depth"), zero("h1"), zero("h2"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("bytes"), *(F.lit(None).cast("decimal(38,0)").alias(x) for x in ("p1", "p2")))
    below = found.groupBy(*NODE).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    nodes = save(root.unionByName(below))
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")]
    children = nodes.filter("depth > 0").select(*parent).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    counted = save(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    inner = counted.filter("n_children > 0").select(*NODE, F.col("conv_id").alias("parent_conv_id"))
    child = counted.filter("depth > 0").select(*parent, *(F.col(c).alias(f"own_{c}") for c in NODE), "conv_id", "n_convs", "bytes", "n_children")
    named = hot_join(child, inner, NODE).select(*(F.col(f"own_{c}").alias(c) for c in NODE), "conv_id", "n_convs", "bytes", "parent_conv_id", "n_children")
    top = counted.filter("depth = 0").select(*NODE, "conv_id", "n_convs", "bytes", F.lit(None).cast("bigint").alias("parent_conv_id"), "n_children")
    out = save(named.unionByName(top))
    drop_saved(nodes, counted)
    return out


def _chains(active: DataFrame) -> DataFrame | None:
    """(id, parent, next, open, totals): the nodes of active with a single child, with sums down to `next`, the first node
    below that has none or several. Pointers double: a step joins those that still point into their chain."""
    child = F.min(F.struct("id", (F.col("n_open") == 1).alias("open"))).alias("child")
    only = active.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(child)
    now = save(active.filter("n_open = 1").join(only, "id").select("id", "parent", F.col("child.id").alias("next"), F.col("child.open").alias("open"), *TOTALS))
    if now.isEmpty():
        return None
    while not (inside := now.filter("open")).isEmpty():
        below = now.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("open").alias("further"), *(F.col(t).alias(f"{t}_below") for t in TOTALS))
        told = inside.join(below, "next").select("id", "parent", F.col("after").alias("next"), F.col("further").alias("open"), *((F.col(t) + F.col(f"{t}_below")).alias(t) for t in TOTALS))
        before, now = now, save(now.filter("not open").unionByName(told))
        drop_saved(before)
    return now


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """nodes: (id, parent, n_children, totals of its own). (id, totals over its subtree)."""
    active = save(nodes.select("id", "parent", F.col("n_children").alias("n_open"), *TOTALS))
    raked, compressed = [nodes.limit(0).select("id", *TOTALS)], []
    while not active.isEmpty():
        leaves = active.filter("n_open = 0")
        raked.append(save(leaves.select("id", *TOTALS)))
        given = leaves.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("gone"), *(F.sum(t).alias(f"{t}_given") for t in TOTALS))
        rest = active.filter("n_open > 0").join(given, "id", "left")
        rest = save(rest.select("id", "parent", (F.col("n_open") - F.coalesce("gone", F.lit(0))).alias("n_open"), *((F.col(t) + F.coalesce(f"{t}_given", F.lit(0))).alias(t) for t in TOTALS)))
        drop_saved(active)
        chains = _chains(rest)
        if chains is None:
            active = rest
            continue
        compressed.append(chains)
        # What a chain's nodes have of their own goes to its parent at once; what ends it becomes that parent's child.
        tops = save(chains.groupBy(F.col("next").alias("id")).agg(F.min_by(F.struct("parent", *TOTALS), "id.depth").alias("top")))
        given = tops.filter("top.parent is not null").groupBy(F.col("top.parent").alias("id")).agg(*(F.sum(f"top.{t}").alias(f"{t}_given") for t in TOTALS))
        ends = rest.filter("n_open <> 1").join(given, "id", "left").join(tops, "id", "left")
        parent = F.when(F.col("top").isNotNull(), F.col("top.parent")).otherwise(F.col("parent"))
        active = save(ends.select("id", parent.alias("parent"), "n_open", *((F.col(t) + F.coalesce(f"{t}_given", F.lit(0))).alias(t) for t in TOTALS)))
        drop_saved(rest, tops)
    known = reduce(DataFrame.unionByName, raked)
    for chains in reversed(compressed):
        below = known.select(F.col("id").alias("next"), *(F.col(t).alias(f"{t}_below") for t in TOTALS))
        told = hot_join(chains.select("id", "next", *TOTALS), below, ["next"])
        known = known.unionByName(save(told.select("id", *((F.col(t) + F.col(f"{t}_below")).alias(t) for t in TOTALS))))
    return known


def _join_ids(batches):
    """Sorted rows (depth, h1, h2, conv) to (depth, h1, h2, conv, ids): ids that follow each other as one text."""
    node, first, ids = None, None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*node, first, ",".join(map(str, ids))), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=[*NODE, "conv", "ids"])

    for b in batches:
        for *at, conv in zip(*(b.column(c).to_pylist() for c in (*NODE, "conv")), strict=True):
            if ids and (at != node or len(ids) >= _IDS):
                yield out()
                ids = []
            if not ids:
                node, first = at, conv
            ids.append(conv)
    if ids:
        yield out()


def _digest(batches):
    """Sorted rows of _join_ids() to (depth, h1, h2, ends_sha256): a node's texts go through the hash one after another."""
    node, sha = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*node, sha.hexdigest()), (pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=[*NODE, "ends_sha256"])

    for b in batches:
        for *at, ids in zip(*(b.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if at != node:
                if node is not None:
                    yield out()
                node, sha = at, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
    if node is not None:
        yield out()


def end_digests(convs: DataFrame, found: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of the nodes that end a conversation."""
    whole = found.groupBy("conv").agg(F.max(F.struct(*NODE)).alias("w")).select("conv", "w.*")
    ends = convs.join(whole, "conv", "left").select(F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), *(F.coalesce(x, F.lit(0)).cast("string").alias(x) for x in ("h1", "h2")), "conv")
    n = partitions(convs.sparkSession)
    shape = "depth bigint, h1 string, h2 string"
    dealt = ends.repartitionByRange(n, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    texts = dealt.mapInArrow(_join_ids, f"{shape}, conv bigint, ids string")
    digests = texts.repartition(n, *NODE).sortWithinPartitions(*NODE, "conv").mapInArrow(_digest, f"{shape}, ends_sha256 string")
    return digests.select("depth", *(F.col(x).cast("decimal(38,0)").alias(x) for x in ("h1", "h2")), "ends_sha256")


def conversation_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", share: bool = False) -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. share: conversations are rebuilt by shared_starts() first."""
    turns = numbered_turns(conversations, id_col, turn_col, role_col, text_col)
    if share:
        convs, turns = shared_starts(turns)
    else:
        convs = turns.select("conv").distinct()
    found = prefixes(turns)
    nodes = trie_nodes(convs, found)
    name = lambda conv, depth: F.struct(F.col(conv).alias("conv_id"), depth.cast("bigint").alias("depth"))
    own = nodes.select(name("conv_id", F.col("depth")).alias("id"), F.when(F.col("parent_conv_id").isNotNull(), name("parent_conv_id", F.col("depth") - 1)).alias("parent"), "n_children", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(own).select("id.*", *TOTALS)
    joined = nodes.join(totals, ["conv_id", "depth"]).join(end_digests(convs, found), NODE, "left")
    none = hashlib.sha256().hexdigest()
    out = save(joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *TOTALS, F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
    drop_saved(turns, found, nodes)
    return out
