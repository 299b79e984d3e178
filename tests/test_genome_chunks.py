"""FASTA over file blocks, and ORFs over chunks, against the same read and searched as whole sequences."""

import random

import pytest
from pyspark.sql import functions as F

from genefeat.functions import sequence as sq
from genefeat.operators import slices
from genefeat.operators.orfs import chunk_orfs
from genefeat.sources import fasta, tools


def seq(n, letters="ACGT"):
    return "".join(random.choice(letters) for _ in range(n))


def wrapped(records, width, ending="\n"):
    return "".join(f">{name}{ending}" + "".join(s[i : i + width] + ending for i in range(0, len(s), width)) for name, s in records)


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize(("chunk", "width", "ending"), [(100, 60, "\n"), (64, 64, "\r\n"), (1000, 7, "\n"), (50, 100_000, "\n")])
def test_chunks_over_file_blocks(spark, tmp_path, small_blocks, chunk, width, ending):
    random.seed(chunk)
    one = [("a told", seq(3000)), ("b", ""), ("c", seq(1)), ("d x", seq(chunk)), ("e", seq(chunk * 2 + 1, "acgtN")), ("f", seq(2500)), ("g", "")]
    two = [("h", seq(5000)), ("i", seq(99))]
    (tmp_path / "one.fa").write_bytes(wrapped(one, width, ending).encode())
    (tmp_path / "two.fa").write_bytes(("ACGT\n" + wrapped(two, width, ending)).encode())
    chunks, rejects = fasta.read_fasta_chunks(spark, str(tmp_path), chunk)
    want = {(n.split()[0], i + 1, min(i + chunk, len(s)), s[i : i + chunk]) for n, s in one + two for i in range(0, len(s), chunk)}
    assert {tuple(r) for r in chunks.collect()} == want and chunks.count() == len(want)
    assert [r.line for r in rejects.collect()] == ["ACGT"]
    assert {tuple(r) for r in fasta.chunk_lengths(chunks, 99).collect()} == {(n.split()[0], len(s)) for n, s in one + two if len(s) > 99}
    whole = slices.chunk_genome(tools.read_fasta(spark, str(tmp_path / "one.fa")), chunk)
    assert {tuple(r) for r in whole.collect()} == {x for x in want if x[0] in "abcdefg"}


def test_records_that_share_a_name_and_nothing(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">r\nAAAAA\n>r\nCCC\n")
    chunks, _ = fasta.read_fasta_chunks(spark, str(tmp_path), 4)
    assert sorted((r.start, r.seq) for r in chunks.collect()) == [(1, "AAAA"), (1, "CCC"), (5, "A")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "y.fa").write_text("")
    chunks, rejects = fasta.read_fasta_chunks(spark, str(tmp_path / "empty"), 4)
    assert chunks.count() == 0 and rejects.count() == 0


def plain_orfs(s, least):
    out = set()
    for strand, t in (("+", s.upper()), ("-", s.upper()[::-1].translate(str.maketrans("ACGT", "TGCA")))):
        for frame in range(3):
            first = None
            for i in range(frame, len(t) - 2, 3):
                if t[i : i + 3] == "ATG" and first is None:
                    first = i
                elif t[i : i + 3] in ("TAA", "TAG", "TGA"):
                    if first is not None and i + 3 - first >= least:
                        out.add((strand, frame, first + 1, i + 3))
                    first = None
    return out


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50, 1000])
def test_orfs_over_chunks_are_those_of_whole_sequences(spark, chunk):
    random.seed(chunk)
    n = 400 if chunk < 7 else 3000
    records = [("a", seq(n)), ("b", seq(n, "ATG")), ("c", "ATG" + "GCC" * 100 + "TAA" + seq(5)), ("d", "AT"), ("e", seq(n, "acgtN")), ("f", "CCC" * 300), ("g", "")]
    df = spark.createDataFrame(records, "name string, seq string")
    got = chunk_orfs(slices.chunk_genome(df, chunk), 9)
    assert {tuple(r) for r in got.collect()} == {(name, *x) for name, s in records for x in plain_orfs(s, 9)}


def test_orfs_of_a_long_contig(spark, tmp_path):
    """Five million bases, in lines of 60 and blocks of 1 MB; the longest ORF runs over twenty chunks."""
    random.seed(1)
    part = seq(100_000)
    long = "ATG" + "GCC" * 70_000 + "TAA"
    text = part * 20 + long + part * 28
    (tmp_path / "x.fa").write_text(wrapped([("chr1", text)], 60))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    try:
        chunks, _ = fasta.read_fasta_chunks(spark, str(tmp_path), 10_000)
        longest = chunks.agg(F.max(F.length("seq")), F.sum(F.length("seq"))).first()
        found = {tuple(r)[1:] for r in chunk_orfs(chunks, 600).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tuple(longest) == (10_000, len(text))
    assert found == plain_orfs(text, 600) and any(end - start + 1 >= len(long) for _, _, start, end in found)


def test_orfs_by_expression_agree(spark):
    random.seed(9)
    s = seq(900)
    df = spark.createDataFrame([(s,)], "seq string")
    found = {(f, o.start, o.end) for f in range(3) for o in df.select(sq.orfs_in_frame(F.col("seq"), f).alias("o")).first().o}
    assert found == {x[1:] for x in plain_orfs(s, 0) if x[0] == "+"}
