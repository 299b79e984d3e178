import pytest
from pyspark.sql import functions as F

from genefeat.operators import filters, reads, slices


@pytest.mark.parametrize("length,expected", [(999, []), (1000, [(1, 1000)]), (5000, [(1, 5000)]), (5001, [(1, 5000)]), (9800, [(1, 5000), (4501, 9500)]), (12000, [(1, 5000), (4501, 9500), (9001, 12000)])])
def test_slices(spark, length, expected):
    r = spark.createDataFrame([("r", length)], "seq_region string, length bigint")
    assert sorted((x.start, x.end) for x in slices.make_slices(r, 5000, 500, 1000).collect()) == expected


def test_numbers_are_one_sequence(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 37) % 101)
    got = slices.numbered(df, [F.col("k"), F.col("id")]).orderBy("number").collect()
    assert [r.number for r in got] == list(range(1, 1001))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)
    assert slices.numbered(df.limit(0), [F.col("k")]).count() == 0


def test_sequences_over_chunks(spark):
    genome = spark.createDataFrame([("r1 told", "ACGTTGCATTGACCA")], "name string, seq string")
    chunks = slices.chunk_genome(genome, 4)
    wanted = spark.createDataFrame([("a", "r1", "+", 3, 11), ("b", "r1", "-", 4, 5), ("c", "r1", "+", 1, 15)], "id string, seq_region string, strand string, start bigint, end bigint")
    assert {r.id: r.seq for r in slices.get_sequence(chunks, wanted, chunk=4).collect()} == {"a": "GTTGCATTG", "b": "AA", "c": "ACGTTGCATTGACCA"}


def test_status(spark):
    a = spark.range(5)
    assert slices.check_min_rows({"a": a.limit(0)}).first().status == "empty"
    assert slices.check_min_rows({"a": a}, 5).first().status == "too_few"
    assert slices.check_min_rows({"a": a, "b": a}, 5).first().status == "ok"


def test_repeat_types(spark):
    df = spark.createDataFrame([("tRNA",), ("LINE/L1",), ("xx",)], "c string")
    assert [r.t for r in df.select(filters.repeat_class_type("c").alias("t")).collect()] == ["RNA repeats", "Type I Transposons/LINE", "Unknown"]
    assert [r.t for r in df.select(filters.repeat_class_type("c", rna_at_end=False).alias("t")).collect()] == ["Unknown", "Type I Transposons/LINE", "Unknown"]


@pytest.mark.parametrize("limit,fraction,method,n", [(10, 0.5, 0, 10), (80, 0.5, 0, 50), (80, 0.5, 1, 50), (10, 0.5, 1, 50), (None, 0.3, None, 30), (10, 0.5, None, 10), (500, None, 1, 100), (7, None, None, 7), (7, None, 0, 7), (None, 0.025, 1, 2), (None, 0.0, 1, 0)])
def test_sample_sizes(spark, limit, fraction, method, n):
    r = spark.range(100).select(F.col("id").alias("read_no"), F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
    got = reads.subsample_reads(r, limit, fraction, method).collect()
    assert len(got) == 2 * n
    assert {x.read_no for x in got if x.mate == 1} == {x.read_no for x in got if x.mate == 2}


def test_sample_of_equal_and_negative_keys(spark):
    """Ties of keys go by read number; the kth key is found whatever its bits."""
    with pytest.raises(ValueError):
        reads.sample_size(10, 5, 0.5, 2)
    r = spark.range(3000).select(F.col("id").alias("read_no"), F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
    for key in (F.col("read_no") % 3 - 1, F.lit(5), -F.col("read_no") * 3_000_000_000_000_000, F.col("read_no") * (1 << 51) - (1 << 62)):
        keys = {x.read_no: x.k for x in r.select("read_no", key.cast("bigint").alias("k")).collect()}
        for n in (1, 1000, 1001, 2999):
            got = reads.subsample_reads(r, n, key=key).collect()
            assert len(got) == 2 * n and {x.read_no for x in got} == set(sorted(keys, key=lambda i: (keys[i], i))[:n])
    plan = reads.subsample_reads(r, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert reads.subsample_reads(r.drop("mate"), 10).count() == 20
