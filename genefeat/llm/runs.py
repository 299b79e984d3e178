"""Periodic run detection (11): stretches of words that repeat themselves, at every period.

Periods are taken by octave, from s = 2^k up to 2s. For each octave a document is exploded into overlapping tiles whose
size follows s; each is solved on its own, without knowing its neighbours. In a tile every multiple c of s is a
boundary. What a Z-function of the boundary says, how far the words from c on agree with those q further on, is worked
out for all q of the octave at once: hashes of the 2s words at c and at c+q decide where it is 2s or more, and from the
first and last boundary of such a stretch the exact end on either side is found by halving steps. A run of at least
four periods holds such a boundary, also where a tile's edge cuts it, as tiles overlap by 8s words. So a tile costs a
few passes over its words, whatever their repeats. A tile's words are not shuffled (they would be some twenty times the
text); its fragments are, by document and period, and fragments that overlap by a period or more are stitched. A
stretch found at several periods has the smallest; that one is a run if it is long enough.

Texts stay in a table bucketed by the partition that wrote them, and a document's runs go to them.

Defined results: a null text has no words, no run and the digest of the empty string; rows that repeat are documents each
on its own; a null seed plants nothing. Words are compared by 64-bit hashes, blocks of words by hashes of these. Other
columns are not looked at. One document's words are held by one task, tiles of others besides up to a fixed number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Hashes, drop_saved, hold, in_place, mix, save, word_slices

_M1 = np.uint64(0x9E3779B97F4A7C15)
_BATCH = 400_000  # words whose tiles are solved together
_OVERLAP, _LEAST_TILE = 8, 32  # in units of s


def planted_tail(seed: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) where a seed plants a periodic tail in n words: word i >= a is read as word a + (i - a) % p."""
    if seed is None or seed % 10 or not n:
        return None
    g = seed // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def read_order(seed: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place, or None where all stand at their own."""
    if (tail := planted_tail(seed, n)) is None:
        return None
    a, p = tail
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def word_hashes(text: bytes | None, seed: int | None, hashes: Hashes) -> np.ndarray:
    parts = [hashes.of(words) for words in word_slices(text, lower=False)]
    out = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    order = read_order(seed, len(out))
    return out if order is None else out[order]


def tiles(words: np.ndarray, s: int, tile_words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first word, words) of the tiles of a document for the octave of s."""
    size = max(tile_words, _LEAST_TILE * s)
    at = 0
    while True:
        yield at, words[at : at + size]
        if at + size >= len(words):
            return
        at += size - _OVERLAP * s


def solve(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, start, stop) of the maximal stretches of tiles with a period of octave k, of those that are at least
    3s words and a period long. Tiles are laid end to end with a word of its own after each."""
    s = 1 << k
    sizes = np.array([len(x) + 1 for x in parts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    marks = mix(np.arange(1, len(parts) + 1, dtype=np.uint64) * _M1)
    flat = np.concatenate([x for part, mark in zip(parts, marks, strict=True) for x in (part, [mark])]).astype(np.uint64)
    levels = [flat]
    for j in range(k + 1):
        h, step = levels[-1], 1 << j
        levels.append(mix(mix(h[: max(0, len(h) - step)] * _M1 + np.uint64(j)) + h[step:]))
    blocks = levels[k + 1]  # of 2s words
    if len(blocks) <= s:
        return (np.empty(0, np.int64),) * 4
    at = np.flatnonzero(blocks[s:] == np.repeat(blocks[::s], s)[: len(blocks) - s]) + s
    bound = (at // s - 1) * s
    period = at - bound
    order = np.lexsort((bound, period))
    bound, period = bound[order], period[order]
    if not len(bound):
        return (np.empty(0, np.int64),) * 4
    opens = np.concatenate([[True], (period[1:] != period[:-1]) | (bound[1:] != bound[:-1] + s)])
    first = bound[opens]
    last = bound[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(bound) - 1]])]
    q = period[opens]
    start, stop = first, last + 2 * s
    for j in range(k - 1, -1, -1):
        h, step = levels[j], 1 << j
        i = start - step
        fits = np.flatnonzero(i >= 0)
        start = start.copy()
        start[fits[h[i[fits]] == h[i[fits] + q[fits]]]] -= step
        fits = np.flatnonzero(stop + q < len(h))
        stop = stop.copy()
        stop[fits[h[stop[fits]] == h[stop[fits] + q[fits]]]] += step
    stop = stop + q
    tile = np.searchsorted(starts, start, "right") - 1
    own = stop <= starts[tile] + sizes[tile] - 1  # else the words agree with those of another tile
    tile, q, start, stop = tile[own], q[own], start[own], stop[own]
    return tile, q, start - starts[tile], stop - starts[tile]


def _find(tile_words: int, min_length: int, min_exponent: int):
    """Rows (__part, row, text, seed) to fragments (__part, row, period, start, stop)."""

    def fragments(held: list[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        k = 0
        while True:
            s = 1 << k
            long = [(p, r, w) for p, r, w in held if len(w) >= max(min_length, min_exponent * s)]
            if not long:
                return
            cut = [(p, r, at, len(w), x) for p, r, w in long for at, x in tiles(w, s, tile_words)]
            size = 0
            group: list = []
            for one in [*cut, None]:
                if group and (one is None or size + len(one[4]) > 2 * _BATCH):
                    tile, q, start, stop = solve([x[4] for x in group], k)
                    parts, rows, at, n = (np.array([x[i] for x in group], np.int64) for i in range(4))
                    start, stop = start + at[tile], stop + at[tile]
                    ends = at + np.array([len(x[4]) for x in group], np.int64)
                    cut_off = ((start == at[tile]) & (start > 0)) | ((stop == ends[tile]) & (stop < n[tile]))
                    kept = cut_off | (stop - start >= np.maximum(min_length, min_exponent * q))
                    if kept.any():
                        yield pa.RecordBatch.from_arrays([pa.array(parts[tile][kept].astype(np.int32)), pa.array(rows[tile][kept]), pa.array(q[kept]), pa.array(start[kept]), pa.array(stop[kept])], names=["__part", "row", "period", "start", "stop"])
                    group, size = [], 0
                if one is not None:
                    group.append(one)
                    size += len(one[4])
            k += 1

    def find(batches):
        hashes, held, n = Hashes(), [], 0
        for b in batches:
            for p, r, text, seed in zip(b.column("__part").to_pylist(), b.column("row").to_pylist(), b.column("text").cast(pa.large_binary()), b.column("seed").to_pylist(), strict=True):
                words = word_hashes(text.as_py(), seed, hashes)
                if len(words) >= min_length:
                    held.append((p, r, words))
                    n += len(words)
                if n >= _BATCH:
                    yield from fragments(held)
                    held, n = [], 0
        yield from fragments(held)

    return find


def stitched(fragments: DataFrame, min_length: int, min_exponent: int) -> DataFrame:
    """(__part, row, runs): fragments of one document and period that overlap by a period or more are one stretch; a
    stretch counts once, with its smallest period. runs is sorted by start, then period."""
    keys = ["__part", "row", "period"]
    by_start = Window.partitionBy(*keys).orderBy("start", "stop")
    before = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.withColumn("opens", F.when(before.isNull() | (F.col("start") + F.col("period") > before), 1).otherwise(0))
    islands = opened.withColumn("island", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    least = whole.groupBy("__part", "row", "start", "stop").agg(F.min("period").alias("period"))
    length = F.col("stop") - F.col("start")
    runs = least.filter(length >= F.greatest(F.lit(min_length), min_exponent * F.col("period")))
    return runs.groupBy("__part", "row").agg(F.array_sort(F.collect_list(F.struct("start", "period", length.alias("length")))).alias("runs"))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of runs (start, period, length) in order the first with the greatest length / period."""
    best = None
    for run in runs:
        if best is None or run[2] * best[1] > best[2] * run[1]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    deep = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        deep[start + period] += 1
        deep[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(deep)[:-1] == 0)]


def _report(with_text: bool):
    def report(batches):
        names = ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", *["collapsed"] * with_text]
        for b in batches:
            out: list[list] = [[] for _ in names[1:]]
            for text, seed, found in zip(b.column("text").cast(pa.large_binary()), b.column("seed").to_pylist(), b.column("runs"), strict=True):
                words = (text.as_py() or b"").split()
                if (order := read_order(seed, len(words))) is not None:
                    words = [words[i] for i in order]
                runs = [(x["start"], x["period"], x["length"]) for x in found.as_py() or []]
                best = strongest(runs)
                told = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
                left = b" ".join(collapse(words, runs))
                values = [len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4), hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), *[left.decode("utf-8", "replace")] * with_text]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * (2 + with_text)
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=names)

    return report


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed_col: str | None = None, min_length: int = 6, min_exponent: int = 4, tile_words: int = 65_536, with_text: bool = False) -> DataFrame:
    """A row for each row of docs: id, n_runs; start, length, period and exponent_milli of the run with the greatest
    length / period; runs_sha256; collapsed_sha256 of the words that are left when each run keeps its first period (and
    with_text these, collapsed). A run has at least min_length words and min_exponent (four or more) periods. seed_col: a
    number that plants a periodic tail, see planted_tail()."""
    if min_exponent < 4 or min_length < 4:
        raise ValueError("runs have four words and four periods or more")
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    seed = F.lit(None) if seed_col is None else F.col(seed_col)
    held = hold(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), seed.cast("bigint").alias("seed"), F.monotonically_increasing_id().alias("row")))
    found = held.select("__part", "row", "text", "seed").mapInArrow(_find(tile_words, min_length, min_exponent), "__part int, row bigint, period bigint, start bigint, stop bigint")
    runs = save(stitched(found, min_length, min_exponent))
    shape = f"id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string" + ", collapsed string" * with_text
    with in_place(spark):
        joined = held.join(runs.hint("shuffle_hash"), ["__part", "row"], "left").select("id", "text", "seed", "runs")
        out = save(joined.mapInArrow(_report(with_text), shape))
    drop_saved(held, runs)
    return out.withColumnRenamed("id", id_col)
