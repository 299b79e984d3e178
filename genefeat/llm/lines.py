"""Line dedup (13): lines that many documents have are dropped.

A line's key is the line without white space at its ends and with A-Z in lower case. Two Bloom filters tell which keys
can be repeats at all: one holds the hashes seen once, the other those met when the first already had them. Filters are
cut into slices of the hash range, one task each, so that none grows with the corpus and none is broadcast; what goes to
a slice is a document partition's distinct hashes, never a line. Only lines whose hash the second filter has are
suspected, and only these shuffle: as SHA-256 digests, counted by partition first, for the exact number of documents and
the first document. What is confirmed goes back to the partitions that asked. Texts stay in a table bucketed by the
partition that wrote them; nothing moves them.

Defined results: a null or empty text is one empty line; a line of white space alone has the empty key, which is under
any `min_chars` of 1 or more and stays; rows that repeat are documents each on its own, also with equal or null ids;
a line that occurs twice in one document counts once; of equal smallest ids the row that comes first is the first one
(null ids come before others). Other columns are not looked at. A text is held whole by one task, some lists of its
lines besides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, in_place, mix, partitions, save, save_bucketed

_SLICE = 1_000_000  # hashes of a slice, on average
_CELLS, _PROBES = 16, 3  # of a Bloom filter for each hash
_FLUSH = 1_000_000
_DIGEST = 32


def line_keys(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """A text's lines and their keys. bytes.strip() and lower() know ASCII alone."""
    lines = text.split(b"\n")
    return lines, [x.strip().lower() for x in lines]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def _packed(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in rows], pa.binary())


def held_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text, __part, row, hashes) in a table bucketed by __part: each row's distinct hashes of keys, packed."""

    def add(batches):
        for b in batches:
            found = []
            for text in _texts(b.column("text")):
                keys = {k for k in line_keys(text)[1] if _long_enough(k, min_chars)}
                found.append(np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))))
            yield pa.RecordBatch.from_arrays([*b.columns, _packed(found)], names=[*b.schema.names, "hashes"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("row"))
    kind = docs.schema[id_col].dataType.simpleString()
    return save_bucketed(picked.mapInArrow(add, f"id {kind}, text string, __part int, row bigint, hashes binary"), "__part")


def _deal(slices: int):
    """Rows (__part, hashes) to (slice, __part, once, again): distinct hashes by slice, and those of several rows."""

    def cut(part, rows):
        found, counts = np.unique(np.concatenate(rows), return_counts=True)
        place = ((found >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
        names, starts = np.unique(place, return_index=True)
        ends = [*starts[1:], len(found)]
        again = counts > 1
        cuts = [(found[a:z], found[a:z][again[a:z]]) for a, z in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array([part] * len(names), pa.int32()), _packed([x for x, _ in cuts]), _packed([x for _, x in cuts])], names=["slice", "__part", "once", "again"])

    def deal(batches):
        part, rows, n = None, [], 0
        for b in batches:
            for p, x in zip(b.column("__part").to_pylist(), b.column("hashes"), strict=True):
                if n and (p != part or n >= _FLUSH):
                    yield cut(part, rows)
                    rows, n = [], 0
                part = p
                rows.append(np.frombuffer(x.as_buffer(), np.uint64).copy())
                n += len(rows[-1])
        if n:
            yield cut(part, rows)

    return deal


def _cells(h: np.ndarray, size: int) -> np.ndarray:
    out = np.empty((_PROBES, len(h)), np.int64)
    for i in range(_PROBES):
        out[i] = (mix(h + np.uint64(i)) & np.uint64(size - 1)).astype(np.int64)
    return out


def _suspect(table: pa.Table) -> pa.Table:
    """A slice's rows: the hashes that go through the filter for twice seen ones, by partition."""
    unpack = lambda name: [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column(name)]
    once_rows, again_rows = unpack("once"), unpack("again")
    size = 1 << max(10, (_CELLS * sum(map(len, once_rows)) - 1).bit_length())
    once, twice = np.zeros(size, bool), np.zeros(size, bool)
    for own, again in zip(once_rows, again_rows, strict=True):
        at = _cells(own, size)
        met = once[at].all(axis=0)
        twice[at[:, met]] = True
        twice[_cells(again, size)] = True
        once[at] = True
    found = [own[twice[_cells(own, size)].all(axis=0)] for own in once_rows]
    kept = [i for i, x in enumerate(found) if len(x)]
    return pa.table({"__part": table.column("__part").combine_chunks().take(pa.array(kept, pa.int64())), "hashes": _packed([found[i] for i in kept])})


def suspected(held: DataFrame) -> DataFrame:
    """(__part, hashes): by partition the hashes that more than one document can have. No repeat is missing."""
    spark = held.sparkSession
    n = held.agg(F.coalesce(F.sum(F.octet_length("hashes")), F.lit(0))).first()[0] // 8
    slices = max(partitions(spark), -(-n // _SLICE))
    dealt = held.select("__part", "hashes").mapInArrow(_deal(slices), "slice bigint, __part int, once binary, again binary")
    return save(dealt.groupBy("slice").applyInArrow(_suspect, "__part int, hashes binary"))


def _within(column: pa.ChunkedArray, known: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(row, hashes) of the rows of packed hashes that have some of known: all rows are looked up at once."""
    rows = [np.frombuffer(x.as_buffer(), known.dtype) for x in column]
    if not len(known) or not rows:
        return []
    whole = np.concatenate(rows)
    met = np.isin(whole, known)
    ends = np.cumsum([len(x) for x in rows])
    found = np.split(whole[met], np.concatenate([[0], np.cumsum(met)])[ends[:-1]])
    return [(i, x) for i, x in enumerate(found) if len(x)]


def _rows_of(table: pa.Table, found: list[tuple[int, np.ndarray]]) -> dict[str, pa.Array]:
    at = pa.array([i for i, _ in found], pa.int64())
    return {name: table.column(name).take(at) for name in ("__part", "row")}


def _shared(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of a partition's rows those with suspected hashes, and these."""
    asked = [np.frombuffer(x.as_buffer(), np.uint64) for x in right.column("hashes")]
    found = _within(left.column("hashes"), np.concatenate(asked) if asked else np.empty(0, np.uint64))
    return pa.table(_rows_of(left, found) | {"asked": _packed([x for _, x in found])})


def _count(batches):
    """Rows (id, text, __part, row, asked) to (__part, hash, digest, n, first): by partition and key the number of rows."""
    part, found = None, {}
    kind = None

    def out():
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(keys), pa.int32()), pa.array([h for h, _ in keys], pa.int64()), pa.array([d for _, d in keys], pa.binary()), pa.array([found[k][0] for k in keys], pa.int64()), pa.array([found[k][1][1] for k in keys], kind), pa.array([found[k][1][2] for k in keys], pa.int64())],
            names=["__part", "hash", "digest", "n", "id", "row"],
        )

    for b in batches:
        kind = b.schema.field("id").type
        for i, p, r, text, x in zip(b.column("id").to_pylist(), b.column("__part").to_pylist(), b.column("row").to_pylist(), _texts(b.column("text")), b.column("asked"), strict=True):
            if found and (p != part or len(found) >= 200_000):
                yield out()
                found = {}
            part = p
            asked = set(np.frombuffer(x.as_buffer(), np.int64).tolist())
            for k in set(line_keys(text)[1]):
                h = xxhash.xxh3_64_intdigest(k)
                h -= (h >> 63) << 64
                if h in asked:
                    key, me = (h, hashlib.sha256(k).digest()), (i is not None, i, r)
                    n, first = found.get(key, (0, me))
                    found[key] = (n + 1, min(first, me, key=lambda m: (m[0], m[1] if m[0] else 0, m[2])))
    if found:
        yield out()


def _told(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each row of a partition the confirmed digests of its hashes; a byte after each: 1 where the row is the first."""
    by_hash: dict[int, list[tuple[bytes, int]]] = {}
    for h, d, r in zip(right.column("hash").to_pylist(), right.column("digest").to_pylist(), right.column("first").to_pylist(), strict=True):
        by_hash.setdefault(h, []).append((d, r))
    firsts, found = left.column("row").to_pylist(), _within(left.column("hashes"), np.fromiter(by_hash, np.int64, len(by_hash)))
    told = [b"".join(d + bytes([first == firsts[i]]) for h in own.tolist() for d, first in by_hash[h]) for i, own in found]
    return pa.table(_rows_of(left, found) | {"confirmed": pa.array(told, pa.binary())})


def _drop(keep_first: bool, with_text: bool):
    def drop(batches):
        for b in batches:
            n_lines, n_dropped, shas, kept_texts = [], [], [], []
            for text, told in zip(_texts(b.column("text")), b.column("confirmed").to_pylist(), strict=True):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if told:
                    step = _DIGEST + 1
                    confirmed = {told[i : i + _DIGEST]: told[i + _DIGEST] for i in range(0, len(told), step)}
                    kept = []
                    for line, key in zip(lines, line_keys(text)[1], strict=True):
                        if key and (d := hashlib.sha256(key).digest()) in confirmed:
                            if not (keep_first and confirmed[d]):
                                continue
                            confirmed[d] = 0
                        kept.append(line)
                    lines, text = kept, b"\n".join(kept)
                n_dropped.append(n_lines[-1] - len(lines))
                shas.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept_texts.append(text.decode("utf-8", "replace"))
            columns = [b.column("id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string())]
            names = ["id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept_texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return drop


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, with_text: bool = False) -> DataFrame:
    """A row for each row of docs: id, n_lines (before), n_dropped, kept_sha256 (of the remaining lines joined by LF) and,
    with_text, kept_text. Lines go whose key, of at least min_chars code points, at least min_docs (two or more) documents
    have; keep_first leaves the first such line of the document with the smallest id."""
    if min_docs < 2 or min_chars < 1:
        raise ValueError("min_docs is 2 or more and min_chars 1 or more")
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    held = held_lines(docs, id_col, text_col, min_chars)
    doubtful = suspected(held)
    own = held.select("__part", "row", "hashes")
    with in_place(spark):
        asked = save(own.groupBy("__part").cogroup(doubtful.groupBy("__part")).applyInArrow(_shared, "__part int, row bigint, asked binary"))
        texts = held.select("id", "text", "__part", "row").join(asked.hint("shuffle_hash"), ["__part", "row"])
        seen = save(texts.select("id", "text", "__part", "row", "asked").mapInArrow(_count, f"__part int, hash bigint, digest binary, n bigint, id {kind}, row bigint"))
        first = F.min(F.struct(F.col("id"), F.col("row")))
        confirmed = seen.groupBy("digest").agg(F.sum("n").alias("n_docs"), first.alias("first")).filter(F.col("n_docs") >= min_docs).select("digest", F.col("first.row").alias("first"))
        back = seen.select("__part", "hash", "digest").join(confirmed, "digest")
        told = save(own.groupBy("__part").cogroup(back.groupBy("__part")).applyInArrow(_told, "__part int, row bigint, confirmed binary"))
        left = held.select("id", "text", "__part", "row").join(told.hint("shuffle_hash"), ["__part", "row"], "left")
        shape = f"id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string" + ", kept_text string" * with_text
        out = save(left.select("id", "text", "confirmed").mapInArrow(_drop(keep_first, with_text), shape))
    drop_saved(held, doubtful, asked, seen, told)
    return out.withColumnRenamed("id", id_col)
