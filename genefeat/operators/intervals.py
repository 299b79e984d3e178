"""Overlap of closed intervals [start, end] on (seq_region[, strand]): joins, anti-joins and clusters.

Joins go through bins of several widths. An interval belongs to the narrowest width at which it spans few bins and is
listed in the one or two bins it touches at each wider one; a pair meets at the wider of its two widths, in the first
bin that both touch. So every key of the join is an equality, long features cost a few rows, and no pair repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEVELS = 8


def overlaps(a_start, a_end, b_start, b_end) -> Column:
    return (a_start <= b_end) & (a_end >= b_start)


def overlap_length(a_start, a_end, b_start, b_end) -> Column:
    return F.greatest(F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1, F.lit(0))


def _own_level(start: str, end: str, width: int) -> Column:
    """The narrowest width at which the interval spans few bins."""
    own = F.when(F.lit(False), 0)
    for k in range(_LEVELS - 1):
        own = own.when(F.col(end) - F.col(start) < 8 * width * 8**k, k)
    return own.otherwise(_LEVELS - 1)


def _binned(df: DataFrame, side: str, keys: list[str], start: str, end: str, width: int, met: Column) -> DataFrame:
    """Rows as a struct column named by side, with level, bin and own level. met: the own levels that the other side has;
    a row is listed at its own level if one of these is no wider, and at the wider ones among them."""
    told = df.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*[df[c] for c in df.columns]).alias(side), F.col(start).alias(f"__{side}_s"), F.col(end).alias(f"__{side}_e"), _own_level(start, end, width).alias("__own"))
    told = told.filter(F.col(f"__{side}_s") <= F.col(f"__{side}_e"))
    own, level = F.col("__own"), F.col("__level")
    at = told.withColumns({"__met": met, "__level": F.explode(F.array(*map(F.lit, range(_LEVELS))))})
    at = at.filter(((level == own) & (F.array_min("__met") <= own)) | ((level > own) & F.array_contains("__met", level)))
    w = F.lit(width).cast("bigint") * F.pow(F.lit(8), F.col("__level")).cast("bigint")
    bins = F.sequence(F.floor(F.col(f"__{side}_s") / w), F.floor(F.col(f"__{side}_e") / w))
    return at.select(*(f"__{k}" for k in keys), side, f"__{side}_s", f"__{side}_e", own.alias(f"__{side}_own"), "__level", F.explode(bins).alias("__bin"))


def _levels(df: DataFrame, start: str, end: str, width: int) -> Column:
    """The own levels that occur, eight at most, as a subquery."""
    return df.filter(F.col(start) <= F.col(end)).agg(F.collect_set(_own_level(start, end, width)).alias("levels")).scalar()


def overlap_pairs(left: DataFrame, right: DataFrame, stranded: bool = True, width: int = 1000, contained: bool = False, start: str = "start", end: str = "end", region: str = "seq_region", strand: str = "strand") -> DataFrame:
    """(l, r): each pair of overlapping rows once, as structs; contained: those where r lies inside l. Rows with start
    past end, or a null key, pair with nothing."""
    keys = [region, strand] if stranded else [region]
    a = _binned(left, "l", keys, start, end, width, _levels(right, start, end, width))
    b = _binned(right, "r", keys, start, end, width, _levels(left, start, end, width))
    joined = a.join(b, [*(f"__{k}" for k in keys), "__level", "__bin"])
    w = F.lit(width) * F.pow(F.lit(8), F.col("__level")).cast("bigint")
    once = (F.col("__level") == F.greatest("__l_own", "__r_own")) & (F.col("__bin") == F.floor(F.greatest("__l_s", "__r_s") / w))
    hit = (F.col("__l_s") <= F.col("__r_s")) & (F.col("__l_e") >= F.col("__r_e")) if contained else overlaps(F.col("__l_s"), F.col("__l_e"), F.col("__r_s"), F.col("__r_e"))
    return joined.filter(once & hit).select("l", "r")


def overlap_join(left: DataFrame, right: DataFrame, stranded: bool = True, how: str = "inner", key: str | None = None, **options) -> DataFrame:
    """how: inner, the pairs (l, r); semi or anti, the rows of left with or without a partner, by their unique `key`."""
    pairs = overlap_pairs(left, right, stranded, **options)
    if how == "inner":
        return pairs
    return left.join(pairs.select(F.col("l")[key].alias(key)).distinct(), key, "left_semi" if how == "semi" else "left_anti")


def containment_join(outer: DataFrame, inner: DataFrame, stranded: bool = False, **options) -> DataFrame:
    return overlap_pairs(outer, inner, stranded, contained=True, **options)


def cluster_by_span(features: DataFrame, stranded: bool = True, piece: int = 1_000_000, start: str = "start", end: str = "end", region: str = "seq_region", strand: str = "strand") -> DataFrame:
    """features with cluster_start: rows that a chain of overlaps connects share it (with region and strand).

    A row opens a cluster if it starts past every end before it. Regions are worked through in pieces; what comes
    before a piece is one row for each piece, so a region of any size has many tasks."""
    keys = [region, strand] if stranded else [region]
    cut = features.withColumn("__piece", F.floor(F.col(start) / piece))
    by_piece = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "__piece").orderBy(start, end)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b: [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "__piece"]]
    ends = cut.groupBy(*keys, "__piece").agg(F.max(end).alias("e")).select(*keys, "__piece", F.max("e").over(by_piece).alias("__before"))

    def with_carry(df, carry):
        on = None
        for c in same(df, carry):
            on = c if on is None else on & c
        return df.alias("a").join(carry.alias("b"), on).select("a.*", *(f"b.{c}" for c in carry.columns if c not in [*keys, "__piece"]))

    opened = with_carry(cut, ends).withColumn("__end", F.greatest(F.max(end).over(before), F.col("__before")))
    opened = opened.withColumn("__open", F.when(F.col("__end").isNull() | (F.col(start) > F.col("__end")), F.col(start)))
    opens = opened.groupBy(*keys, "__piece").agg(F.max("__open").alias("o")).select(*keys, "__piece", F.max("o").over(by_piece).alias("__last"))
    so_far = within.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # equal rows together: the first window may have had them in another order
    return with_carry(opened, opens).withColumn("cluster_start", F.coalesce(F.max("__open").over(so_far), F.col("__last"))).select(*features.columns, "cluster_start")


def drop_lncrna_overlapping_coding(features: DataFrame, stranded: bool = True, key: str = "transcript_id", coding: Column | None = None) -> DataFrame:
    """Rows that code, and the others that overlap none of them (same strand, or any). Complete, whatever the order."""
    coding = F.col("biotype") == "protein_coding" if coding is None else coding
    codes = features.filter(coding)
    other = features.filter(~F.coalesce(coding, F.lit(False)))
    return codes.unionByName(overlap_join(other, codes, stranded, "anti", key))
