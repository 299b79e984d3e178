"""FASTA straight to chunks: no row is longer than a chunk, however long a chromosome is.

Each file block is read where it lies, in one pass: its lines become segments (what one record has in one block), cut
into pieces of up to a chunk. What a segment lacks, its record and the bases before it, follows from the blocks before
it in the file: a row for each block that says which record is open at its end and how many bases of it the block has.
Sums of these, in order of the blocks, place every piece; pieces go to (record, chunk) in the one shuffle of bases.

Defined results: a record's name is its header's first token; white space and carriage returns within sequences are left
out; records without bases have no chunk; records that share a name keep their own chunks, each from 1; bases before the
first header of a file belong to no record and are rejects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tables import save

_SEGMENT = "path string, block bigint, segment bigint, header string, at bigint, seq string"


def _segments(chunk: int):
    """Rows (path, block, value) in order of the lines to pieces (path, block, segment, header, at, seq): segment 0 is what
    goes on from the block before and has no header; at is the number of the segment's bases before the piece."""

    def cut(batches):
        state = None  # (path, block)
        segment, at, held = 0, 0, b""
        header: str | None = None
        out: list[tuple] = []

        def put(seq: bytes):
            nonlocal at
            out.append((*state, segment, header, at, seq.decode()))
            at += len(seq)

        def rest():
            nonlocal held
            if held or header is not None:  # a record without bases is told as well: it ends the one before
                put(held)
            held = b""

        def flush():
            columns = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "block", "segment", "header", "at", "seq"])

        for b in batches:
            paths, blocks = b.column("path"), b.column("block").to_numpy(zero_copy_only=False)
            lines = b.column("value").cast(pa.large_string())
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data = lines.buffers()[2]
            codes = pc.dictionary_encode(paths).indices.to_numpy(zero_copy_only=False)
            heads = set(np.flatnonzero(pc.starts_with(lines, ">").to_numpy(zero_copy_only=False)).tolist())
            turns = set((np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist()) | {0}
            stops = sorted(heads | turns | {len(lines)})
            for i, z in zip(stops, stops[1:], strict=False):
                if i in turns and (new := (paths[i].as_py(), int(blocks[i]))) != state:
                    if state is not None:
                        rest()
                    state, segment, at, header = new, 0, 0, None
                if i in heads:
                    rest()
                    segment, at, header = segment + 1, 0, lines[i].as_py()
                    i += 1
                if i < z:
                    held += data[offsets[i] : offsets[z]].to_pybytes().translate(None, b" \t\r\n\v\f")
                    whole = len(held) // chunk * chunk
                    for j in range(0, whole, chunk):
                        put(held[j : j + chunk])
                    held = held[whole:]
            if out:
                yield flush()
        if state is not None:
            rest()
        if out:
            yield flush()

    return cut


def read_fasta_chunks(spark: SparkSession, path: str | list[str], chunk: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """((seq_region, start, end, seq), rejects (path, line)): each record in chunks of `chunk` bases, as chunk_genome()
    makes them of whole sequences."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = save(raw.mapInArrow(_segments(chunk), _SEGMENT))
    sizes = F.sum(F.length("seq")).alias("n")
    # The record open at a block's end: its last one with a header, or else the one that came in.
    segments = pieces.groupBy("path", "block", "segment").agg(F.max("header").alias("header"), sizes)
    ends = segments.groupBy("path", "block").agg(F.max(F.struct("segment", "header", "n")).alias("e"))
    so_far = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = ends.withColumn("opens", F.when(F.col("e.segment") > 0, F.col("block")))
    origin = opened.withColumn("origin", F.max("opens").over(so_far))
    names = opened.filter("opens is not null").select("path", F.col("block").alias("origin"), F.col("e.segment").alias("of"), F.col("e.header").alias("name"), F.col("e.n").alias("first"))
    by_origin = Window.partitionBy("path", "origin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.when(F.col("e.segment") == 0, F.col("e.n")).otherwise(0)).over(by_origin), F.lit(0))
    carried = origin.select("path", "block", "origin", inside.alias("before")).join(names, ["path", "origin"], "left")
    carried = carried.select("path", "block", F.lit(0).cast("bigint").alias("segment"), F.struct("origin", "of").alias("record"), "name", (F.col("before") + F.coalesce("first", F.lit(0))).alias("before"))
    joined = pieces.filter("seq <> ''").join(carried, ["path", "block", "segment"], "left")
    own = F.col("segment") > 0
    record = F.when(own, F.struct(F.col("block").alias("origin"), F.col("segment").alias("of"))).otherwise(F.col("record"))
    placed = joined.select("path", record.alias("record"), F.when(own, F.col("header")).otherwise(F.col("name")).alias("name"), (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "seq")
    known = placed.filter("name is not null").withColumn("seq_region", F.regexp_extract("name", r"^>?\s*(\S+)", 1))
    first = F.floor(F.col("at") / chunk)
    # A piece is a chunk at most, so it touches two chunks at most.
    left = F.least(F.length("seq").cast("bigint"), (first + 1) * chunk - F.col("at"))
    halves = F.array(F.struct(first.alias("k"), F.col("at").alias("at"), F.substring("seq", F.lit(1), left.cast("int")).alias("seq")), F.struct((first + 1).alias("k"), (F.col("at") + left).alias("at"), F.substring("seq", (left + 1).cast("int"), F.length("seq")).alias("seq")))
    dealt = known.select("path", "record", "seq_region", F.explode(F.filter(halves, lambda x: x["seq"] != "")).alias("x"))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x.at", "x.seq"))), lambda x: x["seq"]), "").alias("seq")
    chunks = dealt.groupBy("path", "record", "seq_region", "x.k").agg(texts)
    out = chunks.select("seq_region", (F.col("k") * chunk + 1).alias("start"), (F.col("k") * chunk + F.length("seq")).alias("end"), "seq")
    return out, placed.filter("name is null").select("path", F.col("seq").alias("line"))


def chunk_lengths(chunks: DataFrame, min_length: int = 0) -> DataFrame:
    """(seq_region, length) of regions longer than min_length, as region_lengths() tells of whole sequences."""
    return chunks.groupBy("seq_region").agg(F.max("end").alias("length")).filter(F.col("length") > min_length)
