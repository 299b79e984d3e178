"""A genome told as a layout: what is read of it is what it would be written out, and nothing of it is written."""

import glob

import pytest
from pyspark.sql import functions as F

from genefeat.functions.tables import shared_dir
from genefeat.operators import models, slices
from genefeat.plans import queries


def test_layout_is_its_chunks(spark):
    bases = spark.createDataFrame([(0, "ACGTA"), (1, "CCGGT"), (2, "TTTNN")], "k bigint, seq string")
    g = slices.Layout(bases, spark.createDataFrame([("a", 1), ("b", 2)], "seq_region string, r bigint"), 4, 3, 5)
    whole = {"a": "ACGTACCGGTTTTNNACGTA", "b": "CCGGTTTTNNACGTACCGGT"}
    chunks = g.chunks()
    assert {(r.seq_region, r.start): r.seq for r in chunks.collect()} == {(n, i + 1): s[i : i + 5] for n, s in whole.items() for i in range(0, 20, 5)}
    rows = [(f"{n}{s}{a}.{b}", n, s, a, b) for n in "abc" for s in "+-" for a, b in ((1, 20), (4, 7), (5, 5), (6, 16), (18, 30), (21, 22), (9, 8))]
    wanted = spark.createDataFrame(rows, "id string, seq_region string, strand string, start bigint, end bigint")
    told = lambda df: sorted(map(tuple, df.collect()))
    got = told(slices.get_sequence(g, wanted))
    assert got == told(slices.get_sequence(chunks, wanted, chunk=5)) and dict(got)["a+6.16"] == "CCGGTTTTNNA"
    t = spark.createDataFrame([(1, "a", "-", [(2, 6), (9, 12)]), (2, "b", "+", [(3, 3), (5, 19)])], f"transcript_id bigint, seq_region string, strand string, exons {models.EXONS}")
    assert told(slices.transcript_sequences(g, t)) == told(slices.transcript_sequences(chunks, t, chunk=5)) == [(1, "AAACGTACG"), (2, "GTTTTNNACGTACCGG")]
    empty = slices.Layout(bases.limit(0), g.regions.limit(0), 0, 0, 5)
    assert slices.get_sequence(empty, wanted).collect() == []


def test_positions_within_the_row(spark):
    t = spark.createDataFrame([(s, "r", s, [(11, 13), (20, 20), (31, 40)]) for s in "+-"], f"transcript_id string, seq_region string, strand string, exons {models.EXONS}")
    asked = t.select("transcript_id", "strand", "exons", F.explode(F.sequence(F.lit(0), F.lit(16))).alias("position"))
    got = {(r.transcript_id, r.position): r.g for r in asked.withColumn("g", models.genomic_position(F.col("position"), F.col("exons"), F.col("strand"))).collect() if r.g is not None}
    want = {(r.transcript_id, r.position): r.genomic for r in models.sequence_to_genomic(models.numbered_exons(t), asked.select("transcript_id", "position")).collect()}
    assert got == want and len(got) == 28


@pytest.mark.parametrize("name", ["cds_sequences", "transcript_sequences", "compute_translations", "clean_transcripts", "three_prime_trim_at_signal", "utr_orf_search", "select_best_protein", "select_best_transcriptomic"])
def test_no_genome_is_written(spark, tmp_path, name):
    """The models end near 1 Mb, so the regions have some 1,000 pieces each; the tables that the query saves have few rows."""
    d, shared = str(tmp_path), shared_dir(spark).removeprefix("file://")
    spark.createDataFrame([(i, "acgtacca" * 300) for i in range(2)], "doc_id bigint, text string").coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(o, n, 5, 50.0) for o in (126, 127, 253) for n in range(1, 5)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(126, 1), (127, 40), (253, 70)], "o_orderkey bigint, o_custkey bigint").coalesce(1).write.parquet(f"{d}/orders.parquet")
    before = set(glob.glob(f"{shared}/*"))
    queries.QUERIES[name](spark, d).collect()
    sizes = [spark.read.parquet(p).count() for p in set(glob.glob(f"{shared}/*")) - before if glob.glob(f"{p}/*.parquet")]
    assert sizes and max(sizes) < 100
