"""Open reading frames over chunked sequences: a region of any length, no row longer than a chunk.

A chunk tells, for each strand and frame, the ORFs that lie between two of its own stops, and a summary: its first stop,
the first ATG before that, and the first ATG after its last stop. An ORF that ends at a chunk's first stop begins with
the first ATG since the last stop of the chunks before, which the summaries in order of the chunks decide. On the other
strand the same is said of positions that count down.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import STOPS
from ..functions.tables import save

_CODE = np.full(256, 64, np.int64)
for _letters, _value in ((b"Aa", 0), (b"Cc", 1), (b"Gg", 2), (b"Tt", 3)):
    _CODE[list(_letters)] = _value


def _codon(bases: str, reverse: bool) -> int:
    if reverse:
        bases = bases[::-1].translate(str.maketrans("ACGT", "TGCA"))
    a, b, c = (_CODE[ord(x)] for x in bases)
    return int(a * 16 + b * 4 + c)


def _table(values: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(64 * 21 + 1, bool)  # other letters than ACGT count 64 each
    out[list(values)] = True
    return out


#: By strand, which values of codons are stops, and the value of ATG, both read along the + strand.
_WANTED = {s: (_table(tuple(_codon(x, s == "-") for x in STOPS)), _codon("ATG", s == "-")) for s in "+-"}


def _in_frame(stops: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
    """(firsts, lasts) of the ORFs between two of the stops, and [first stop, first ATG before it, first ATG after the last]."""
    after = np.append(starts, np.iinfo(np.int64).max)[np.searchsorted(starts, stops)]  # the first ATG past each stop
    inside = after[:-1] < stops[1:]
    head = int(starts[0]) if len(starts) and starts[0] < stops[0] else None
    tail = int(after[-1]) if len(starts) and starts[-1] > stops[-1] else None
    return after[:-1][inside], stops[1:][inside], [int(stops[0]), head, tail]


def _scan(min_length: int):
    """Rows (region, start, seq, ahead: the two bases after) to ORFs (first, last) of min_length and summaries (first_stop,
    head, tail). Positions are those of codons' first bases from 0, on - of their last ones, negative: both count along the
    strand's direction."""

    def scan(batches):
        names = ["region", "strand", "frame", "place", "first", "last", "first_stop", "head", "tail"]
        for b in batches:
            regions = b.column("region")
            at: list[int] = []  # the row that each result is of
            rows: list[tuple] = []
            for i, (start, seq, ahead) in enumerate(zip(*(b.column(c).to_pylist() for c in ("start", "seq", "ahead")), strict=True)):
                codes = _CODE[np.frombuffer(((seq or "") + (ahead or "")).encode("ascii", "replace"), np.uint8)]
                values = codes[:-2] * 16 + codes[1:-1] * 4 + codes[2:]
                low, n = start - 1, len(rows)
                for strand, (is_stop, start_value) in _WANTED.items():
                    stops, starts = np.flatnonzero(is_stop[values]) + low, np.flatnonzero(values == start_value) + low
                    if strand == "-":
                        stops, starts = -(stops[::-1] + 2), -(starts[::-1] + 2)
                    stop_frames, start_frames = stops % 3, starts % 3
                    for frame in range(3):
                        s, a = stops[stop_frames == frame], starts[start_frames == frame]
                        if not len(s):
                            if len(a):
                                rows.append((strand, frame, low, None, None, None, None, int(a[0])))
                            continue
                        first, last, summary = _in_frame(s, a)
                        rows.append((strand, frame, low, None, None, *summary))
                        long = last - first + 3 >= min_length
                        rows.extend((strand, frame, low, x, z, None, None, None) for x, z in zip(first[long].tolist(), last[long].tolist(), strict=True))
                at.extend([i] * (len(rows) - n))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([regions.take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return scan


def chunk_orfs(chunks: DataFrame, min_length: int = 600, region: str = "seq_region") -> DataFrame:
    """(region, strand, frame, start, end): from each stop's first ATG since the stop before to the stop, at least
    min_length bases; 1-based along the strand, whose frames count from its own first base. chunks: as chunk_genome()
    makes them; other letters than ACGT make a codon that is neither."""
    kind = chunks.schema[region].dataType.simpleString()
    told = chunks.select(F.col(region).alias("region"), "start", "end", "seq")
    size = F.col("end") - F.col("start") + 1
    # The two bases after a chunk are those of the chunk that starts past its end (of two chunks, where one has one base).
    heads = told.select("region", "start", size.alias("n"), F.substring("seq", 1, 2).alias("two"))
    by_place = Window.partitionBy("region").orderBy("start")
    nexts = heads.select("region", "start", F.concat(F.coalesce(F.lead("two").over(by_place), F.lit("")), F.coalesce(F.lead("two", 2).over(by_place), F.lit(""))).alias("ahead"))
    scanned = told.select("region", "start", "seq").join(nexts, ["region", "start"]).select("region", "start", "seq", F.substring("ahead", 1, 2).alias("ahead"))
    found = save(scanned.mapInArrow(_scan(min_length), f"region {kind}, strand string, frame int, place bigint, first bigint, last bigint, first_stop bigint, head bigint, tail bigint"))
    keys = ["region", "strand", "frame"]
    order = F.when(F.col("strand") == "+", F.col("place")).otherwise(-F.col("place"))
    ends = F.col("first_stop").isNotNull()
    summaries = found.filter("first is null").withColumn("group", F.sum(ends.cast("bigint")).over(Window.partitionBy(*keys).orderBy(order)))
    # A group is a chunk with a stop and those after it up to the next: what it passes on is its first ATG since the stop.
    groups = summaries.groupBy(*keys, "group").agg(F.min("tail").alias("out"), F.max("first_stop").alias("last"), F.max(F.when(ends, F.col("head"))).alias("head"))
    carried = groups.withColumn("first", F.least(F.lag("out").over(Window.partitionBy(*keys).orderBy("group")), "head"))
    both = found.filter("first is not null").select(*keys, "first", "last").unionByName(carried.filter("last is not null and first is not null").select(*keys, "first", "last"))
    lengths = told.groupBy("region").agg(F.max("end").alias("length"))
    placed = both.filter(F.col("last") - F.col("first") + 3 >= min_length).join(lengths, "region")
    along = lambda x: F.when(F.col("strand") == "+", x + 1).otherwise(F.col("length") + x)
    start: Column = along(F.col("first"))
    return placed.select(F.col("region").alias(region), "strand", ((start - 1) % 3).alias("frame"), start.alias("start"), (along(F.col("last")) + 2).alias("end"))
