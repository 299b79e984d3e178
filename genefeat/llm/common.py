"""What the corpus operators share: words, 64-bit hashes, shingles, packed arrays, saved tables."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import drop_saved, partitions, save, save_bucketed, shared_dir  # noqa: F401

#: Words are runs of anything but these characters (Java and RE2 syntax alike).
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def lower_ascii(col):
    return F.translate(col, UPPER, LOWER)


def binary_list(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each string, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


def unused(name: str, columns: list[str]) -> str:
    """A column name like `name` that is none of columns."""
    while name in columns:
        name = f"_{name}"
    return name


def word_slices(text: bytes | None, size: int = 4 << 20, lower: bool = True) -> Iterator[list[bytes]]:
    """The text's words, with A-Z in lower case, some at a time, so that a very long text is never a list as a whole."""
    at, n = 0, len(text or b"")
    while at < n:
        end = at + size
        if end < n:  # back to a space, or on to one where a word is longer than a slice
            space = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if space < 0:
                end = min((x for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (x := text.find(c, end)) >= 0), default=n)
            else:
                end = space + 1
        yield (text[at:end].lower() if lower else text[at:end]).split()
        at = end


def release(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished jobs when the driver collects garbage; a long loop asks for it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Hashes(dict):
    """word -> 64-bit hash; forgets all when it holds `most` words, so its memory is bounded."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def ordered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order, sorted values) of unsigned numbers. Each number's high bits are sorted with its place as the low
    ones, which is several times faster than an argsort; where those bits were too few, it is one."""
    h = h.astype(np.uint64, copy=False)
    n = len(h)
    spread = int(h.max() - h.min()) if n else 0
    if not spread:
        return np.arange(n), h
    low = np.uint64((1 << (n - 1).bit_length()) - 1)
    packed = ((h - h.min()) << np.uint64(64 - spread.bit_length())) & ~low
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    by = (packed & low).astype(np.int64)
    found = h[by]
    if (found[1:] < found[:-1]).any():
        by = np.argsort(h, kind="stable")
        found = h[by]
    return by, found


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers, and each one's place among them."""
    by, found = ordered(h)
    new = np.ones(len(h), bool)
    new[1:] = found[1:] != found[:-1]
    place = np.empty(len(h), np.int64)
    place[by] = np.cumsum(new) - 1
    return found[new], place


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of k values of h, in order."""
    n = len(h) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = mix(out * _M1 + h[j : j + n])
    return out


def shingles(words: list[bytes], hashes: Hashes, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of fewer words, the whole sequence as one; of none, none."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(windows(hashes.of(words), min(k, len(words))))


def blocks_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """How many blocks a set of rows is dealt into so that each block stays under a fixed size on average."""
    return max(partitions(spark), -(-rows // rows_each))


def hold(docs: DataFrame) -> DataFrame:
    """docs as a table with a column __part, the partition that wrote the row, bucketed by it: no row moves to write
    it (a task writes one file), and none moves in a join on __part and other keys under in_place()."""
    return save_bucketed(docs.withColumn("__part", F.spark_partition_id()), "__part")


@contextmanager
def in_place(spark: SparkSession):
    """Within it, a table bucketed by one of several join keys stays where it is and the other side comes to it."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
