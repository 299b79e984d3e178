"""N-gram Jaccard join (7): blocked products of the document by n-gram incidence matrix, bounded by set sizes.

A document is the set of its distinct word shingles. Two documents link when den * |both| >= num * |either|, 4/5 here.
The link graph's components are wanted, not its pairs, so no group of copies is ever written out as pairs.

1. Documents of equal sets are one class (its smallest id stands for it); from here on only classes count.
2. The incidence matrix is dealt into blocks by range of n-gram hash, and each block is multiplied with itself as far
   as a bound needs: how many of a class's n-grams any other class has. A partner of a set of n has at least ceil(4n/5) of its
   n-grams; of the 2*floor(n/5)+1 smallest hashes of each, at least floor(ceil(4n/5)/5)+1 are in both. Classes below
   this bound have no partner. The rest go through the same product with all their n-grams and the bound ceil(4n/5).
   A map task counts what it has twice itself and sends such an n-gram once, so a passage that a third of all
   documents share is one entry a task.
3. Partners must share one of their floor(n/5)+1 smallest hashes. Of each such n-gram's classes, those that are not yet
   known to be connected are compared by whole sets: in two rounds with one of them (the smallest; the first by hash of
   the id, so that hashes draw the same few),
   then all that are left in different components, by products of blocks of classes that accumulate the overlap
   counts and let only links out. The rounds leave the last step little where groups are large; it makes the result
   exact in every case.

Defined results: a null or empty text has no shingles and links with nothing (component: its own id); a row without an
id is returned and not linked; rows that repeat are one class. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import Hashes, binary_list, hold, in_place, mix, partitions, save, save_bucketed, shingles

_FLUSH = 1_000_000  # entries that a map task gathers before it sends them
_BLOCK = 3_000_000  # entries of a block on average


def identity(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for a set."""
    with np.errstate(over="ignore"):
        return int(s.sum(dtype=np.uint64).astype(np.int64)), int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64))


def set_table(docs: DataFrame, id_col: str, text_col: str, k: int, keep) -> DataFrame:
    """(id, __part, n, c1, c2, hashes): a row for each row of docs, a table of hold(). hashes: keep(n) smallest of the
    set's hashes, sorted, as bytes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            texts, ids, part = binary_list(batch.column("text")), batch.column("id"), batch.column("__part")
            for lo in range(0, len(texts), 500):
                sets = [shingles(t.lower().split() if t else [], hashes, k) for t in texts[lo : lo + 500]]
                both = [identity(s) for s in sets]
                columns = [ids.slice(lo, 500), part.slice(lo, 500), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in both], pa.int64()), pa.array([x for _, x in both], pa.int64())]
                columns.append(pa.array([s[: keep(len(s))].tobytes() for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "__part", "n", "c1", "c2", "hashes"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "__part")
    return picked.mapInArrow(make, f"id {kind}, __part int, n bigint, c1 bigint, c2 bigint, hashes binary")


def _pack(sets: list[np.ndarray], classes: list[int], blocks: int) -> pa.RecordBatch:
    """Entries of some sets as one row for each block: class table, places in it and hashes; hashes that two of these
    sets have, once each; and how many hashes of each class were counted here for that reason."""
    order = np.unique(np.array(classes, dtype=np.int64), return_index=True)[1]  # copies among these count once
    table = np.array(classes, dtype=np.int64)[order]
    sets = [sets[i] for i in order]
    place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h = np.concatenate(sets)
    by = np.argsort(h, kind="stable")
    h, place = h[by], place[by]
    first = np.ones(len(h), dtype=bool)
    first[1:] = h[1:] != h[:-1]
    starts = np.flatnonzero(first)
    many = np.diff(np.append(starts, len(h))) > 1
    shared = many[np.cumsum(first) - 1]
    pre = np.bincount(place[shared], minlength=len(sets)).astype(np.int32)
    hot, single, single_place = h[starts[many]], h[~shared], place[~shared]
    edges = np.array([(b << 64) // blocks for b in range(1, blocks)], dtype=np.uint64)
    hot_cut, cut = [np.concatenate([[0], np.searchsorted(x, edges, "left"), [len(x)]]) for x in (hot, single)]
    rows = []
    for b in range(blocks):
        a, z, ha, hz = cut[b], cut[b + 1], hot_cut[b], hot_cut[b + 1]
        if a < z or ha < hz or b == 0:
            used, local = np.unique(single_place[a:z], return_inverse=True)
            told = (table.tobytes(), pre.tobytes()) if b == 0 else (b"", b"")
            rows.append((b, table[used].tobytes(), local.astype(np.int32 if len(used) > 65535 else np.uint16).tobytes(), single[a:z].tobytes(), hot[ha:hz].tobytes(), *told))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 6, strict=True)], ["block", "classes", "places", "hashes", "hot", "pre_classes", "pre"])


def _count_block(table: pa.Table) -> pa.Table:
    """Of one block, packed by range of class: how many of a class's hashes another class has too, and what map tasks
    counted (`pre`, -1 where that is not told)."""
    classes, hashes, hot, pre = [], [], [], []
    for c, p, h, x, pc, pn in zip(*(table.column(n).to_pylist() for n in ("classes", "places", "hashes", "hot", "pre_classes", "pre")), strict=True):
        own, found = np.frombuffer(c, np.int64), np.frombuffer(h, np.uint64)
        classes.append(own[np.frombuffer(p, np.int32 if len(own) > 65535 else np.uint16)])
        hashes.append(found)
        hot.append(np.frombuffer(x, np.uint64))
        if pc:
            pre.append((np.frombuffer(pc, np.int64), np.frombuffer(pn, np.int32)))
    c, h = np.concatenate(classes), np.concatenate(hashes)
    by = np.lexsort((c, h))
    c, h = c[by], h[by]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    c, h = c[new], h[new]
    same = h[1:] == h[:-1]
    shared = np.zeros(len(h), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    shared |= np.isin(h, np.unique(np.concatenate(hot)))
    found, n = np.unique(c[shared], return_counts=True)
    pc, pn = (np.concatenate(x) for x in zip(*pre, strict=True)) if pre else (np.empty(0, np.int64), np.empty(0, np.int32))
    ranges = max(1, _span(table))
    c, n, pre = np.concatenate([found, pc]), np.concatenate([n, np.zeros(len(pc), np.int64)]), np.concatenate([np.full(len(found), -1), pn])
    by = np.argsort(c, kind="stable")
    c, n, pre = c[by], n[by].astype(np.int32), pre[by].astype(np.int32)
    cut = np.searchsorted(c, [-(1 << 63) + (r << 64) // ranges for r in range(ranges)] + [(1 << 63) - 1], "left")
    cut[-1] = len(c)
    some = [r for r in range(ranges) if cut[r] < cut[r + 1]]
    return pa.table({"range": pa.array(some, pa.int32()), **{name: pa.array([x[cut[r] : cut[r + 1]].tobytes() for r in some], pa.binary()) for name, x in (("c", c), ("n", n), ("pre", pre))}})


def _span(table: pa.Table) -> int:
    """How many ranges of classes there are: the same number for all blocks of a job."""
    return table.column("ranges")[0].as_py()


def _add_counts(table: pa.Table) -> pa.Table:
    """(c1, shared) of one range. An entry that is single in some task is in the sum; one that every task counted itself
    is in every task's count."""
    c, n, pre = (np.concatenate([np.frombuffer(x, t) for x in table.column(k).to_pylist()]) for k, t in (("c", np.int64), ("n", np.int32), ("pre", np.int32)))
    found, place = np.unique(c, return_inverse=True)
    least = np.full(len(found), np.iinfo(np.int32).max)
    told = pre >= 0
    np.minimum.at(least, place[told], pre[told])
    least[least == np.iinfo(np.int32).max] = 0
    return pa.table({"c1": pa.array(found), "shared": pa.array(np.bincount(place, weights=n, minlength=len(found)).astype(np.int64) + least)})


_ROW = "block int, classes binary, places binary, hashes binary, hot binary, pre_classes binary, pre binary"


def shared_counts(rows: DataFrame) -> DataFrame:
    """(c1, shared): an upper bound of how many of each class's entries some other class has, exact but for classes
    whose copies are in several tasks. From packed rows."""
    ranges = partitions(rows.sparkSession)
    counted = rows.withColumn("ranges", F.lit(ranges)).groupBy("block").applyInArrow(_count_block, "range int, c binary, n binary, pre binary")
    return counted.groupBy("range").applyInArrow(_add_counts, "c1 bigint, shared bigint")


def packed(frame: DataFrame, blocks: int, sets_of) -> DataFrame:
    """Packed rows of what sets_of(batch) yields: (set, class)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, sets, classes, size = {}, [], [], 0
        for batch in batches:
            for s, c in sets_of(batch, state):
                if len(s):
                    sets.append(s)
                    classes.append(c)
                    size += len(s)
                if size >= _FLUSH:
                    yield _pack(sets, classes, blocks)
                    sets, classes, size = [], [], 0
        if sets:
            yield _pack(sets, classes, blocks)

    return frame.mapInArrow(pack, _ROW)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (a, b), those whose whole sets are similar enough."""
    own = sets.select("id", "hashes")
    joined = pairs.join(own.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a").join(own.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * n >= num * (len(x) + len(y) - n))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(overlap, f"a {kind}, b {kind}")


def entries(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(h, id, n): the prefix of each set, n - ceil(n*num/den) + 1 smallest hashes, a row each."""
    kind = sets.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                made = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("hashes")]
                made = [s[: len(s) - -(-len(s) * num // den) + 1] for s in made]
                take = pa.array(np.repeat(np.arange(len(made)), [len(s) for s in made]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made)), part.column("id").take(take), part.column("n").take(take)], ["h", "id", "n"])

    return sets.select("id", "n", "hashes").mapInArrow(cut, f"h bigint, id {kind}, n bigint")


def product(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of every set of a with every set of b: incidence of a times that of b, over the hashes in both."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    sides = []
    both = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    for sets in (a, b):
        h, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.searchsorted(both, h)
        inside = (column < len(both)) & (both[np.minimum(column, len(both) - 1)] == h) if len(both) else np.zeros(len(h), bool)
        by = np.argsort(column[inside], kind="stable")
        column, row = column[inside][by], row[inside][by]
        sides.append((row, np.searchsorted(column, np.arange(len(both) + 1))))
    (ra, ca), (rb, cb) = sides
    na, nb = np.diff(ca), np.diff(cb)
    dense = np.flatnonzero(na * nb > 64)
    for lo in range(0, len(dense), 2048):  # columns that many sets have: as dense slabs
        some = dense[lo : lo + 2048]
        slabs = []
        for rows, starts, counts, size in ((ra, ca, na, len(a)), (rb, cb, nb, len(b))):
            slab = np.zeros((size, len(some)), dtype=np.float32)
            at = np.concatenate([rows[starts[c] : starts[c + 1]] for c in some])
            slab[at, np.repeat(np.arange(len(some)), counts[some])] = 1
            slabs.append(slab)
        out += slabs[0] @ slabs[1].T
    light = np.flatnonzero((na * nb <= 64) & (na * nb > 0))
    for lo in range(0, len(light), 50_000):  # the others: pair by pair
        some = light[lo : lo + 50_000]
        each = na[some] * nb[some]
        column = np.repeat(some, each)
        k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        np.add.at(out, (ra[ca[column] + k // nb[column]], rb[cb[column] + k % nb[column]]), 1)
    return out


def _open_products(table: pa.Table, linked_of) -> tuple[np.ndarray, np.ndarray]:
    """Places in table of the pairs of different labels for which linked_of(overlap counts, sizes, sizes) holds."""
    side = np.array(table.column("side").to_pylist())
    labels = np.unique(table.column("label").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes").combine_chunks()]
    rows, columns = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if table.column("b1")[0] == table.column("b2")[0]:
        columns = rows
    if not len(rows) or not len(columns):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = np.array(table.column("n").to_pylist())
    linked = linked_of(product([sets[i] for i in rows], [sets[i] for i in columns]), n[rows][:, None], n[columns][None])
    linked &= labels[rows][:, None] != labels[columns][None]
    x, y = np.nonzero(linked)
    return rows[x], columns[y]


def _block_links(num: int, den: int, kind: pa.DataType):
    def links(table: pa.Table) -> pa.Table:
        x, y = _open_products(table, lambda shared, n, m: den * shared >= num * (n + m - shared))
        ids = table.column("id").combine_chunks()
        return pa.table({"a": ids.take(pa.array(x)).cast(kind), "b": ids.take(pa.array(y)).cast(kind)})

    return links


def _block_screen(num: int, den: int):
    """The rows whose first hashes have enough in common with those of some row of another label."""

    def ahead(n):
        return 1 + (n - -(-n * num // den)) // 2

    def screen(table: pa.Table) -> pa.Table:
        x, y = _open_products(table, lambda shared, n, m: shared >= np.minimum(ahead(n), ahead(m)))
        return table.select(["id", "n", "label", "b1", "b2", "side"]).take(pa.array(np.unique(np.concatenate([x, y]))))

    return screen


def product_links(open_: DataFrame, sets: DataFrame, num: int, den: int, block: int = 800) -> DataFrame:
    """Links (a, b) between classes of different labels that share a prefix hash. open_: (h, id, n, label).

    A class's home is the most common of its open hashes, so classes with much in common are at home together. The
    classes of a home are dealt into blocks of about `block`, those of a large label apart. A class goes to the product of
    its block with another one if they share a hash there, with some class of another label and a size in reach. Of
    s = floor(n/5) hashes that a partner may lack, the first s + 1 + floor(s/2) of both have 1 + floor(s/2) of the smaller
    set in common, so these are multiplied first; classes with no such partner there need not send their whole sets.
    Only links leave the second product."""
    from pyspark.sql.types import LongType

    common = open_.groupBy("h").agg(F.count("*").alias("df"))
    homes = open_.join(common, "h").groupBy("id", "n", "label").agg(F.max(F.struct("df", "h")).alias("m")).select("id", "n", "label", F.col("m.h").alias("home"))
    large = homes.groupBy("home", "label").count().select("home", "label", F.when(F.col("count") * 2 >= block, F.col("label")).alias("own"))
    homes = homes.join(large, ["home", "label"])
    sizes = homes.groupBy("home", "own").agg(F.ceil(F.count("*") / block).alias("parts"))
    same = (F.col("m.home") == F.col("s.home")) & F.col("m.own").eqNullSafe(F.col("s.own"))
    part = F.pmod(F.xxhash64("m.id"), F.col("s.parts"))
    dealt = save(homes.alias("m").join(sizes.alias("s"), same).select("m.id", F.xxhash64("m.home", "m.own", part).alias("block")))
    placed = save(open_.join(dealt, "id"))
    there = placed.groupBy("h", "block").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.min("n").alias("n1"), F.max("n").alias("n2")).withColumnRenamed("block", "other")
    reach = (F.col("n2") * den >= F.col("n") * num) & (F.col("n1") * num <= F.col("n") * den)
    sent = placed.join(there, "h").filter(((F.col("l1") != F.col("label")) | (F.col("l2") != F.col("label"))) & reach)
    sent = sent.select("id", "label", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side")).distinct()
    heads = sets.withColumn("s", F.expr(f"n - int(ceil(n * {num} / {den}))")).select("id", "n", F.expr("substring(hashes, 1, int(8 * (s + 1 + s div 2)))").alias("hashes"))
    shape = ", ".join(f"{c} {sent.schema[c].dataType.simpleString() if c != 'n' else 'bigint'}" for c in ("id", "n", "label", "b1", "b2", "side"))
    sent = save(sent.join(heads, "id").groupBy("b1", "b2").applyInArrow(_block_screen(num, den), shape))
    rows = sent.join(sets.select("id", "hashes"), "id")
    kind = sets.schema["id"].dataType
    arrow = pa.int64() if isinstance(kind, LongType) else pa.int32() if kind.simpleString() == "int" else pa.string()
    return rows.groupBy("b1", "b2").applyInArrow(_block_links(num, den, arrow), f"a {kind.simpleString()}, b {kind.simpleString()}")


def link_components(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, label) of the classes that have a link."""
    found = save(entries(sets, num, den))
    fits = F.least("n", "n2") * den >= F.greatest("n", "n2") * num
    kind = sets.schema["id"].dataType.simpleString()
    links = labels = None
    for step in ("smallest", "drawn", "all"):
        told = found.withColumn("label", F.col("id"))
        if labels is not None:
            told = found.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        drawn = F.col("id") if step == "smallest" else F.xxhash64("id")
        several = told.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(F.struct("id", "n", "label"), drawn).alias("c")).filter("low <> high")
        if step == "all":
            new = product_links(save(told.join(several.select("h"), "h", "left_semi")), sets, num, den)
        else:
            centred = told.join(several.select("h", F.col("c.id").alias("b"), F.col("c.n").alias("n2"), F.col("c.label").alias("label2")), "h")
            pairs = centred.filter("label <> label2").filter(fits)
            new = verified(pairs.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct(), sets, num, den)
        links = save(new) if links is None else links.unionByName(save(new))
        labels = save(connected_components(links))
    return labels.select(F.col("node").cast(kind).alias("node"), F.col("label").cast(kind).alias("label"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """A row for each row of docs: id, n_shingles, component_id (the smallest id that links reach), class_id (the
    smallest id of equal sets)."""
    return held_components(hold(docs.select(id_col, text_col)), id_col, text_col, k, num, den).drop("__part")


def held_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """As jaccard_components() of a table of hold(), with the column __part. Texts stay where they are: what is asked of
    them later goes to their partition."""
    spark = docs.sparkSession
    spare = lambda n: n - -(-n * num // den)
    rows = save(set_table(docs, id_col, text_col, k, lambda n: 2 * spare(n) + 1))
    classes = save(rows.filter("n > 0 and id is not null").groupBy("c1", "c2", "n").agg(F.min(F.struct("id", "__part")).alias("m")).select("c1", "c2", "n", F.col("m.id").alias("rep"), F.col("m.__part").alias("__part")))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = lambda n: max(partitions(spark), -(-n // _BLOCK))

    def sets_of(batch, state):
        for x, c in zip(batch.column("hashes"), batch.column("c1").to_pylist(), strict=True):
            yield np.frombuffer(x.as_buffer(), np.uint64), c

    least = F.ceil(F.col("n") * num / den)
    counts = shared_counts(packed(rows.filter("n > 0 and id is not null").select("hashes", "c1"), blocks(total // 2), sets_of))
    likely = save(classes.join(counts, "c1").filter(F.col("shared") >= F.floor((least - F.ceil(least * num / den))) + 1).select("rep", "__part", "c1", "c2"))
    asked = likely.select(F.col("rep").alias("id"), "__part").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "__part").join(asked.hint("shuffle_hash"), ["__part", "id"], "left_semi")
    # Rows that share an id may have other texts, and rows may repeat.
    sets = set_table(texts, "id", "text", k, lambda n: n).dropDuplicates(["id", "c1", "c2"])
    with in_place(spark):
        sets = save(sets.join(likely.select(F.col("rep").alias("id"), "c1", "c2"), ["id", "c1", "c2"], "left_semi"))
    kept = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = shared_counts(packed(sets.select("hashes", "c1"), blocks(kept), sets_of))
    sets = sets.join(counts, "c1").filter(F.col("shared") >= least).select("id", "n", "hashes")
    sets = save_bucketed(sets.repartition(2 * partitions(spark), "id"), "id")  # several joins on id, no later move
    labels = link_components(sets, num, den)
    named = classes.drop("__part").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("c1", "c2", "n", "rep", F.coalesce("label", "rep").alias("label"))
    joined = rows.drop("hashes").join(named, ["c1", "c2", "n"], "left")
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    return joined.select(F.col("id").alias(id_col), "__part", F.col("n").alias("n_shingles"), F.when(linked, F.col("label")).otherwise(F.col("id")).alias("component_id"), F.when(linked, F.col("rep")).otherwise(F.col("id")).alias("class_id"))
