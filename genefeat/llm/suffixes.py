"""Suffix-array dedup (8): every byte that a repeated string of `size` bytes covers goes, but where it occurs first.

Of the distributed difference-cover algorithm this keeps the sampling and the names; it puts no suffixes in order. As only
prefixes of `size` (100) bytes matter, equality takes the place of order throughout:

1. Suffixes at positions of a difference cover modulo 57 are sampled: for any two suffixes of equal prefixes, some shift
   under 57 takes both to a sampled position, and 44 of the 100 bytes follow there. The hashes of these 44-byte tuples
   are dealt by range and grouped; a suffix whose tuple occurs once is decided and needs no more. (With triples modulo 3
   two thirds of all suffixes would be moved at every level; with 57 an eighth is, once.)
2. There is no recursion on names. Near tuples that repeat, runs of suffixes between two anchors (positions chosen by the
   bytes there) are named by a hash of the whole string that decides all of them: if such a string occurs earlier, so
   does each suffix's prefix in the run.
3. There is no merge of remaining suffixes. Those near repeated names are named by a hash of their own 100 bytes.
4. There is no comparison of adjacent prefixes. Of each group of equal hashes all but the first in (document, start) order
   are repeats.

Strings are compared by 64-bit hashes, polynomials modulo 2^64, for which strings of a kilobyte and more that have the same
hash can be made on purpose; text does not have them by chance (step 1 by 32 bits within a block, where a false repeat only adds suffixes to
step 3). Texts are packed into chunks of about `chunk_bytes`, in a table bucketed by chunk: only keys travel and one
bit for each comes back. A key that a chunk has many times is sent once, so a passage that a third of all documents
share is one entry a chunk.

Defined results: null and empty texts have no bytes; rows that repeat, or share an id, count as documents in the order
read; a null id comes before all others. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import save_bucketed
from .common import binary_list, distinct, mix, ordered, partitions, save

PERIOD = 57
#: Every difference modulo 57 is one of two of these.
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
_BASE = 0xD6E8FEB86659FD93 | 3
_TABLE = np.random.default_rng(57).integers(0, 2**64, 256, dtype=np.uint64)
_BLOCK = 3_000_000  # entries of a block on average
_ANCHOR = np.uint64(31)  # an anchor in 32 positions


def pack(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """A row for each chunk: ids, lens, bytes of all its texts one after the other, n_bytes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            all_ids = pa.concat_arrays(ids)
            lens = np.array([len(t) for t in texts], np.int64)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids), pa.array([lens.tobytes()], pa.binary()), pa.array([b"".join(texts)], pa.binary()), pa.array([int(lens.sum())])], ["chunk", "ids", "lens", "bytes", "n_bytes"])

        for batch in batches:
            column = batch.column("id")
            for i, text in enumerate(binary_list(batch.column("text"))):
                ids.append(column.slice(i, 1))
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= chunk_bytes or len(texts) >= 60_000:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield row()

    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(make, f"chunk bigint, ids array<{kind}>, lens binary, bytes binary, n_bytes bigint")
    return save_bucketed(made, "chunk")


def _offsets(n: int) -> np.ndarray:
    """Sampled offsets of a document of n bytes or fewer, and some beyond."""
    return (np.arange(n // PERIOD + 1)[:, None] * PERIOD + np.array(COVER)).ravel()


_made: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 or more powers of the base and of its inverse, the same for each chunk of a worker."""
    if len(_made[0]) <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            powers = np.full(n + 1, base, np.uint64)
            powers[0] = 1
            _made[i] = np.multiply.accumulate(powers, out=powers)
    return _made[0], _made[1]


class Chunk:
    """A chunk's bytes, with the bits that came back in fields r1..r3 of its row."""

    def __init__(self, row: dict, size: int):
        self.row, self.size = row, size
        self.b = np.frombuffer(row["bytes"], np.uint8)
        self.lens = np.frombuffer(row["lens"], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        n = len(self.b)
        powers, self.inverse = _powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.b] * powers[:n], out=self.sums[1:])
        #: How many bytes of its document each position has left.
        self.left = np.repeat(self.starts + self.lens, self.lens) - np.arange(n)

    def hash(self, at: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[at + length] - self.sums[at]) * self.inverse[at])

    def tuples(self):
        """Sampled positions, their tuples' distinct hashes, and each position's place there."""
        length = self.size - PERIOD + 1
        offsets = _offsets(int(self.lens.max(initial=0)))
        counts = np.searchsorted(offsets, self.lens - length, "right")
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(self.starts, counts) + offsets[inside]
        keys, place = distinct(self.hash(at, length))
        return at, keys, place

    def step1(self):
        _, keys, place = self.tuples()
        return keys, [keys.astype(np.uint32), np.minimum(np.bincount(place, minlength=len(keys)), 2).astype(np.uint8)], None

    def near(self) -> np.ndarray:
        """Windows (suffixes with a whole prefix) near a repeated name."""
        at, keys, place = self.tuples()
        repeated = _bits(self.row["r1"])[place]
        cover = np.zeros(len(self.b) + 1, np.int32)
        np.add.at(cover, np.maximum(at[repeated] - PERIOD + 1, 0), 1)
        np.add.at(cover, at[repeated] + 1, -1)
        return (np.cumsum(cover[:-1]) > 0) & (self.left >= self.size)

    def runs(self):
        """Runs (first, last window) between anchors, all of whose windows are near a repeated name; their first
        occurrences' distinct hashes here, and each run's place there."""
        near = self.near()
        inside = np.flatnonzero(near)
        anchors = inside[(self.hash(inside, 16) & _ANCHOR) == 0]
        a, z = anchors[:-1], anchors[1:]
        missing = np.cumsum(~near)
        whole = missing[a] == missing[z]
        a, z = a[whole], z[whole]
        return near, a, z, *self.firsts(self.hash(a, z - a + self.size), a)

    def firsts(self, keys: np.ndarray, at: np.ndarray):
        """Distinct keys, the first position that has each (in order of id, then as read), and each position's place."""
        by, sorted_keys = ordered(keys)
        there = at[by]
        new = np.ones(len(by), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        starts = np.flatnonzero(new)
        rank = self.rank()
        first = there[starts]  # where documents lie in order of id, as positions ascend
        if len(starts) and (rank[1:] < rank[:-1]).any():
            order = np.repeat((rank << 36) - self.starts, self.lens)[there] + there
            least = np.minimum.reduceat(order, starts)
            first = there[np.flatnonzero(order == np.repeat(least, np.diff(np.append(starts, len(by)))))]
        place = np.empty(len(by), np.int64)
        place[by] = np.cumsum(new) - 1
        return sorted_keys[new], first, place

    def rank(self) -> np.ndarray:
        """Of each document in the order of ids; the order of reading decides between equal ones. Documents of a
        chunk without bytes have no positions, so ranks of the others are what counts."""
        ids = [(x is not None, x if x is not None else 0) for x in self.row["ids"]]
        out = np.empty(len(ids), np.int64)
        out[sorted(range(len(ids)), key=lambda i: ids[i])] = np.arange(len(ids))
        return out

    def step2(self):
        _, _, _, keys, first, _ = self.runs()
        return keys, [keys], first

    def windows(self):
        """Windows not yet known to be repeats, and those that are."""
        near, a, z, _, first, place = self.runs()
        earlier = _bits(self.row["r2"])[place] | (a != first[place])
        cover = np.zeros(len(self.b) + 1, np.int32)
        np.add.at(cover, a[earlier], 1)
        np.add.at(cover, z[earlier] + 1, -1)
        known = np.cumsum(cover[:-1]) > 0
        at = np.flatnonzero(near & ~known)
        return known, at, *self.firsts(self.hash(at, self.size), at)

    def step3(self):
        _, _, keys, first, _ = self.windows()
        return keys, [keys], first

    def removed(self) -> np.ndarray:
        repeat, at, _, first, place = self.windows()
        repeat[at] = _bits(self.row["r3"])[place] | (at != first[place])
        last = np.maximum.accumulate(np.where(repeat, np.arange(len(repeat)), -self.size))
        return np.arange(len(repeat)) - last < self.size

    def order(self, at: np.ndarray):
        """(ids of the documents there, each position's document among them, its offset)."""
        doc = np.searchsorted(self.starts, at, "right") - 1
        used, local = np.unique(doc, return_inverse=True)
        return [self.row["ids"][i] for i in used], local.astype(np.uint16), (at - self.starts[doc]), used


def _bits(parts: list[dict] | None) -> np.ndarray:
    found = [np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["n"]) for x in parts or []]
    return np.concatenate(found).astype(bool) if found else np.empty(0, bool)


def _decide(table: pa.Table) -> pa.Table:
    """A bit for each entry of a block: step 1, whether its key occurs elsewhere; later, whether it does earlier."""
    rows = table.to_pylist()
    sizes = [r["n"] for r in rows]
    if rows[0]["ids"] is None:
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint32) for r in rows])
        counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows])
        _, name = distinct(keys)
        bits = (np.bincount(name, weights=counts) > 1)[name]
    else:
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        # Documents in order of id, and as read (chunk, place in it) where ids are equal.
        told = [[(x is not None, x if x is not None else 0, r["chunk"], int(u)) for x, u in zip(r["ids"], np.frombuffer(r["reads"], np.int64), strict=True)] for r in rows]
        ranks = {x: i for i, x in enumerate(sorted({x for xs in told for x in xs}))}
        doc = np.concatenate([np.array([ranks[x] for x in xs], np.int64)[np.frombuffer(r["docs"], np.uint16)] for r, xs in zip(rows, told, strict=True)])
        at = np.concatenate([np.frombuffer(r["at"], np.int64 if r["wide"] else np.uint32) for r in rows]).astype(np.int64)
        by, sorted_keys = ordered(keys)
        order = ((doc << 36) | at)[by]
        new = np.ones(len(keys), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        starts = np.flatnonzero(new)
        least = np.minimum.reduceat(order, starts)
        bits = np.empty(len(keys), bool)
        bits[by] = order != np.repeat(least, np.diff(np.append(starts, len(by))))
    cuts = np.cumsum([0, *sizes])
    return pa.table({"chunk": table.column("chunk"), "block": table.column("block"), "n": pa.array(sizes, pa.int32()), "bits": pa.array([np.packbits(bits[a:z]).tobytes() for a, z in zip(cuts, cuts[1:], strict=False)], pa.binary())})


def _bitten(chunks: DataFrame, entries: int, step, size: int, id_kind: str) -> DataFrame:
    """(chunk, r): for the keys that step(Chunk) gives, a bit for each in their order, by block."""
    blocks = max(partitions(chunks.sparkSession), -(-entries // _BLOCK))
    edges = np.array([(b << 64) // blocks for b in range(1, blocks)], dtype=np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0], size)
                keys, arrays, first = step(chunk)
                cut = np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]])
                ids = batch.column("ids").slice(i, 1).flatten()
                for b in range(blocks):
                    a, z = cut[b], cut[b + 1]
                    if a == z:
                        continue
                    told = {"chunk": chunk.row["chunk"], "block": b, "n": int(z - a), "keys": arrays[0][a:z].tobytes(), "counts": b"", "ids": None, "reads": b"", "docs": b"", "at": b"", "wide": False}
                    if first is None:
                        told["counts"] = arrays[1][a:z].tobytes()
                    else:
                        _, local, at, used = chunk.order(first[a:z])
                        wide = bool(at.max(initial=0) >= 2**32)
                        told |= {"ids": ids.take(pa.array(used)).to_pylist(), "reads": used.astype(np.int64).tobytes(), "docs": local.tobytes(), "at": at.astype(np.int64 if wide else np.uint32).tobytes(), "wide": wide}
                    schema = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(ids.type)), ("reads", pa.binary()), ("docs", pa.binary()), ("at", pa.binary()), ("wide", pa.bool_())])
                    yield pa.RecordBatch.from_pylist([told], schema)

    row = f"chunk bigint, block int, n int, keys binary, counts binary, ids array<{id_kind}>, reads binary, docs binary, at binary, wide boolean"
    decided = chunks.mapInArrow(deal, row).groupBy("block").applyInArrow(_decide, "chunk bigint, block int, n int, bits binary")
    return save(decided.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("block", "n", "bits"))).alias("r")))


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 100, chunk_bytes: int = 4 << 20, with_text: bool = False) -> DataFrame:
    """A row for each row of docs: id, n_bytes, n_removed, n_spans (maximal runs of removed bytes), kept_sha256.
    with_text: kept_bytes besides, what stays of the text."""
    if size < PERIOD + 16:
        raise ValueError(f"size must be {PERIOD + 16} or more")
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = pack(docs, id_col, text_col, chunk_bytes)
    total = int(chunks.agg(F.sum("n_bytes")).first()[0] or 0)
    known = chunks
    for i, (step, share) in enumerate(((Chunk.step1, len(COVER) / PERIOD), (Chunk.step2, 1 / 64), (Chunk.step3, 1 / 8)), 1):
        found = _bitten(known, int(total * share), step, size, kind)
        known = known.join(found.withColumnRenamed("r", f"r{i}").hint("shuffle_hash"), "chunk", "left")
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_bytes"] * with_text]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0], size)
                gone, rows = chunk.removed(), []
                for a, n in zip(chunk.starts, chunk.lens, strict=True):
                    own = gone[a : a + n]
                    removed = int(np.count_nonzero(own))
                    spans = int(np.count_nonzero(own[1:] & ~own[:-1])) + int(n > 0 and own[0]) if removed else 0
                    kept = chunk.b[a : a + n][~own].tobytes() if removed else chunk.b[a : a + n].tobytes()
                    rows.append((int(n), removed, spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
                columns = list(zip(*rows, strict=True))
                types = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_text
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    judged = known.mapInArrow(judge, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_bytes binary" * with_text)
    return judged.withColumnRenamed("id", id_col)
