"""Choice among overlapping hits, without writing out which of them overlap.

Regions are worked through in pieces. Spark sorts a piece's hits from best to worst and streams them through a task that holds
only disjoint spans: those of kept hits and those of hits not decided yet. So n hits on one spot cost a sort of n rows, not
n^2 pairs, and no group is ever held in memory. A hit over several pieces is asked about in each; what these leave open is
asked again in pieces eight times as wide, so a region of 250 Mb needs four rounds at most, whatever chains there are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tables import save

_PLACE = ["seq_region", "strand", "start", "end"]
_GONE, _OPEN, _FREE, _KEPT = range(4)  # the least of a hit's states in several pieces is its state


class _Spans:
    """Disjoint closed intervals in order; what is added is merged with what it overlaps."""

    def __init__(self):
        self.starts, self.ends = [], []

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, end) - 1
        return i >= 0 and self.ends[i] >= start

    def add(self, start: int, end: int) -> None:
        i, j = bisect_left(self.ends, start), bisect_right(self.starts, end)
        if i < j:
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [start], [end]


def _scan(greedy: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds each hit's state; hits come from best to worst, a piece of a region after the other. Greedy: gone if it overlaps
    a kept one; open if it overlaps one that isn't decided; else kept, or free to be kept as far as this piece goes. Not
    greedy: gone if it overlaps any better one."""

    def states(batches):
        here, kept, rest = None, _Spans(), _Spans()
        for batch in batches:
            told = []
            for region, strand, piece, start, end, crosses, settled in zip(*(batch.column(c).to_pylist() for c in ("seq_region", "strand", "__piece", "start", "end", "__crosses", "__settled")), strict=True):
                if here != (region, strand, piece):
                    here, kept, rest = (region, strand, piece), _Spans(), _Spans()
                if settled:
                    state = _KEPT
                elif kept.meets(start, end):
                    state = _GONE
                elif rest.meets(start, end):
                    state = _OPEN if greedy else _GONE
                else:
                    state = _FREE if crosses or not greedy else _KEPT
                if state == _KEPT:
                    kept.add(start, end)
                elif state != _GONE or not greedy:
                    rest.add(start, end)
                told.append(state)
            yield batch.append_column("__state", pa.array(told, pa.int32()))

    return states


def _round(hits: DataFrame, piece: int, greedy: bool) -> DataFrame:
    """hits with the state that all pieces together give; those that were settled before are left out."""
    first, last = F.floor(F.col("start") / piece), F.floor(F.col("end") / piece)
    asked = hits.select("*", (first != last).alias("__crosses"), F.explode(F.sequence(first, last)).alias("__piece"))
    at = ["seq_region", "strand", "__piece"]
    dealt = asked.repartition(*at).sortWithinPartitions(*at, "__order", "start", "end")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields)
    told = save(dealt.mapInArrow(_scan(greedy), f"{fields}, __state int").filter("not __settled"))
    whole = told.filter("not __crosses").select(*hits.columns, "__state")
    return whole.unionByName(told.filter("__crosses").groupBy(*hits.columns).agg(F.min("__state").alias("__state")))


def resolve_overlaps(hits: DataFrame, mode: str = "beaten", score: str = "score", name: str = "accession", piece: int = 1_000_000) -> DataFrame:
    """Hits (seq_region, strand, start, end, score, name) that no better overlapping hit beats (higher score, then
    smaller name, start, end). mode="greedy": from the best on, each that overlaps no kept one; of rows that are equal in all
    of these but differ in other columns it keeps one.

    Rows that repeat are one. start past end is turned round. Rows without region, strand or place overlap nothing and stay. A
    null score is the best, a null name comes before others. Extra columns are kept, whatever their names, but for
    __order, __piece, __crosses, __settled and __state."""
    if mode not in ("beaten", "greedy"):
        raise ValueError(f"unknown mode {mode}")
    greedy = mode == "greedy"
    tidy = hits.withColumns({"start": F.least("start", "end"), "end": F.greatest("start", "end")}).distinct()
    placed = reduce(lambda a, c: a & F.col(c).isNotNull(), _PLACE, F.lit(True))
    order = F.struct((-F.col(score)).alias("s"), F.col(name).alias("n"))
    # Of hits on the same place only the best can stay: each is gone if that one is, and gone if that one stays.
    best = tidy.filter(placed).groupBy(*_PLACE).agg(F.min(order).alias("__order"))
    stay, todo = [], best.withColumn("__settled", F.lit(False))
    while True:
        told = save(_round(todo, piece, greedy))
        stay.append(told.filter(F.col("__state") >= _FREE).select(*_PLACE, "__order"))
        undecided = told.filter(F.col("__state") == _OPEN).drop("__state")
        if undecided.isEmpty():
            break
        # A hit within its piece has sent away all that it overlaps; one over several has not been heard of in all of them.
        over = F.floor(F.col("start") / piece) != F.floor(F.col("end") / piece)
        settled = told.filter((F.col("__state") == _FREE) & over).drop("__state").withColumn("__settled", F.lit(True))
        todo, piece = undecided.unionByName(settled), piece * 8
    chosen = save(reduce(DataFrame.unionByName, stay))
    found = tidy.filter(placed).withColumn("__order", order)
    same = reduce(lambda a, c: a & found[c].eqNullSafe(chosen[c]), [*_PLACE, "__order"], F.lit(True))
    found = found.join(chosen, same, "left_semi")
    if greedy:
        one = Window.partitionBy(*_PLACE).orderBy(F.xxhash64(*tidy.columns))
        found = found.withColumn("__state", F.row_number().over(one)).filter("__state = 1")
    return found.select(tidy.columns).unionByName(tidy.filter(~placed))
