import random

import pytest
from pyspark.sql import functions as F

from genefeat.operators import clusters, evidence, joining, models

SCHEMA = "transcript_id string, gene_id string, seq_region string, strand string, start bigint, end bigint, exons array<struct<start:bigint,end:bigint>>, cds_start bigint, cds_end bigint, source string, biotype string"


def tx(spark, *rows):
    """(id, strand, exons, cds) or (id, strand, exons, cds, gene)."""
    return spark.createDataFrame([(r[0], r[4] if len(r) > 4 else r[0], "r1", r[1], r[2][0][0], r[2][-1][1], r[2], *(r[3] or (None, None)), "x", "protein_coding" if r[3] else "lncRNA") for r in rows], SCHEMA)


def exons(df):
    return {r.transcript_id: [tuple(x) for x in r.exons] for r in df.collect()}


def mirrored(found, size=100_000):
    return [(size - b, size - a) for a, b in reversed(found)]


def test_merge_and_drop(spark):
    t = tx(spark, ("a", "+", [(1, 100), (150, 200), (300, 400)], None), ("b", "+", [(1, 100), (90, 200)], None), ("c", "-", [(5, 9)], None))
    assert exons(models.merge_short_introns(t))["a"] == [(1, 200), (300, 400)]
    assert set(exons(models.drop_overlapping_exons(t))) == {"a", "c"}


@pytest.mark.parametrize("strand", "+-")
def test_three_prime_trim_on_both_strands(spark, strand):
    turn = (lambda x: x) if strand == "+" else mirrored
    found = turn([(1, 1000), (2000, 2200), (5000, 5400), (9000, 9900)])
    cds = turn([(100, 2100)])[0]
    got = exons(models.trim_three_prime(tx(spark, ("a", strand, found, cds))))["a"]
    assert turn(got) == [(1, 1000), (2000, 2200), (5000, 5400)]
    near = turn([(1, 1000), (1100, 1400)])
    got = exons(models.trim_three_prime(tx(spark, ("a", strand, near, turn([(100, 900)])[0]))))["a"]
    assert turn(got) == [(1, 1000)]  # the gap is under 250
    long = turn([(1, 3000)])
    got = exons(models.trim_three_prime(tx(spark, ("a", strand, long, turn([(100, 900)])[0]))))["a"]
    assert turn(got) == [(1, 1899)]


@pytest.mark.parametrize("strand", "+-")
def test_five_prime_trim_on_both_strands(spark, strand):
    turn = (lambda x: x) if strand == "+" else mirrored
    cut = lambda found, cds: turn(exons(models.trim_five_prime(tx(spark, ("a", strand, turn(found), turn([cds])[0]))))["a"])
    assert cut([(1, 90), (500, 1000)], (600, 900)) == [(500, 1000)]  # a short exon of UTR alone
    assert cut([(1, 400), (500, 1000)], (600, 900)) == [(202, 400), (500, 1000)]
    assert cut([(1, 400), (500, 1000)], (780, 900)) == [(500, 1000)]  # under 50 would be left
    assert cut([(1, 1000)], (800, 900)) == [(501, 1000)]


def test_no_cds_is_left_alone(spark):
    t = tx(spark, ("a", "+", [(1, 5000)], None))
    assert exons(models.trim_five_prime(models.trim_three_prime(t)))["a"] == [(1, 5000)]


def test_translation_coords_round_trip(spark):
    t = tx(spark, ("a", "+", [(1, 100), (200, 300)], (10, 250)), ("b", "-", [(1, 100), (200, 300)], (10, 250)))
    coords = models.translation_coords(F.col("exons"), F.col("strand"), F.col("cds_start"), F.col("cds_end"))
    got = {r.transcript_id: r.c for r in t.select("transcript_id", models.format_translation_coords(coords).alias("c")).collect()}
    assert got == {"a": "1:100:10:200:300:51", "b": "200:300:51:1:100:91"}
    ok = spark.createDataFrame([("1:100:10:200:300:51", [(1, 100), (200, 300)]), ("1:99:10:200:300:51", [(1, 100), (200, 300)]), ("x", [(1, 2)])], "c string, exons array<struct<start:bigint,end:bigint>>")
    assert [r.x is not None for r in ok.select(models.parse_translation_coords(F.col("c"), F.col("exons")).alias("x")).collect()] == [True, False, False]


def test_canonical_order(spark):
    t = tx(spark, ("a", "+", [(1, 5000)], None, "g"), ("b", "+", [(1, 900)], (1, 300), "g"), ("c", "+", [(1, 800)], (1, 300), "g"), ("d", "+", [(1, 900)], (1, 300), "g"))
    assert [tuple(r) for r in models.canonical_transcripts(t).collect()] == [("g", "b")]


def test_second_transcript_of_a_gene_is_an_error(spark):
    t = tx(spark, ("a", "+", [(1, 5000)], None, "g"), ("b", "+", [(1, 900)], None, "g")).withColumn("cluster", F.lit(1))
    with pytest.raises(Exception, match="more than one transcript"):
        models.select_canonical_gene(t).collect()


def test_integrity(spark):
    x = spark.createDataFrame([("a", "r1", "+", 1, 5), ("a", "r2", "-", 9, 7), ("b", "r1", "+", 4, 4)], "transcript_id string, seq_region string, strand string, start int, end int")
    got = {(r.transcript_id, r.violation) for r in models.check_model_integrity(x).collect()}
    assert got == {("a", "mixed_strand"), ("a", "mixed_region"), ("a", "exon_start_after_end"), ("b", "empty_span")}


def test_coding_exon_clusters(spark):
    t = tx(spark, ("a", "+", [(1, 100), (200, 300)], (1, 300)), ("b", "+", [(250, 400)], (250, 400)), ("c", "+", [(390, 500)], (395, 500)), ("d", "-", [(1, 500)], (1, 500)), ("e", "+", [(110, 190)], (110, 190)), ("f", "+", [(1, 900)], None))
    got = {r.transcript_id: (r.cluster, r.cluster_size) for r in clusters.cluster_by_coding_exon(t).collect()}
    assert got == {"a": ("a", 3), "b": ("a", 3), "c": ("a", 3), "d": ("d", 1), "e": ("e", 1), "f": ("f", 1)}


def test_single_exon_chain_is_no_sub_chain(spark):
    t = tx(spark, ("a", "+", [(1, 100), (200, 300), (400, 900)], (1, 900)), ("b", "+", [(1, 100), (200, 300)], (1, 300)), ("c", "+", [(1, 90)], (1, 90)))
    named = t.withColumn("cluster", F.lit("a"))
    assert {r.transcript_id: r.is_good for r in evidence.drop_sub_chains(named).collect()} == {"a": True, "b": False, "c": False}
    alone = evidence.drop_sub_chains(named.filter("transcript_id <> 'a'"), fraction=0.1)
    assert {r.transcript_id: r.is_good for r in alone.collect()} == {"b": True, "c": True}


def test_joins(spark):
    t = tx(spark, ("a", "+", [(100, 200), (300, 400)], None), ("b", "+", [(50, 60), (90, 150)], None), ("c", "-", [(900, 950)], None))
    got = {tuple(map(tuple, r.exons)) for r in joining.join_transcripts(t).collect()}
    assert got == {((50, 60), (90, 200), (300, 400))}
    assert joining.join_transcripts(t.filter("transcript_id = 'c'")).count() == 0


def test_read_through_keeps_the_canonical_one(spark):
    small = [(10 * i + 1, 10 * i + 5) for i in range(1, 8)]
    t = tx(spark, ("a", "+", [(1, 5), *small, (100, 200)], (1, 200), "g"), ("b", "+", [(1, 5), (100, 200)], (1, 200), "g"))
    t = models.gene_biotypes(t)
    assert set(exons(clusters.remove_readthroughs(t))) == {"a"}
    assert set(exons(clusters.remove_readthroughs(t.filter("transcript_id = 'b'")))) == {"b"}


@pytest.mark.parametrize("mode,single,expected", [(None, False, ["protein_coding", "lncRNA", None]), ("relaxed", True, ["protein_coding", None, None]), ("moderate", True, [None, None, None])])
def test_coding_calls(spark, mode, single, expected):
    rows = [("x", single, True, 0.85, True, 0.85, 120, None, 900), ("x", single, False, 0.1, False, 0.1, 120, None, 900), ("x", single, False, 0.1, False, 0.1, 120, None, 100)]
    df = spark.createDataFrame(rows, "source string, single_cds_exon boolean, rnasamba_coding boolean, rnasamba_prob double, cpc2_coding boolean, cpc2_prob double, peptide_length int, evalue double, transcript_length int")
    assert [r.c for r in df.select(evidence.coding_call(mode).alias("c")).collect()] == expected


def test_two_hits(spark):
    a = spark.createDataFrame([("t",), ("u",)], "transcript_id string")
    hits = spark.createDataFrame([("t", 0.1), ("t", 0.01)], "transcript_id string, evalue double")
    assert {r.transcript_id: r.evalue for r in evidence.combine_evidence(a, a, hits).collect()} == {"t": 0.01, "u": None}
    assert {r.transcript_id: r.evalue for r in evidence.combine_evidence(a, a, hits, single_hit_only=True).collect()} == {"t": None, "u": None}


def test_gene_order_is_that_of_whole_regions(spark):
    """Pieces of any size give the places of one sort, with ties, nulls and regions that share ids."""
    rng = random.Random(5)
    rows = [(f"g{i}", rng.choice(["1", "2", None]), rng.choice(["+", "-", None]), rng.choice([None, *range(1, 90)])) for i in range(300)]
    genes = spark.createDataFrame(rows, "gene_id string, seq_region string, strand string, start bigint")
    wanted, places = {}, {}
    for g, region, strand, start in sorted(rows, key=lambda r: (r[2] == "-", -1 if r[3] is None else r[3], r[0])):
        places[region] = wanted[g] = places.get(region, 0) + 1
    for piece in (1, 7, 1000):
        got = models.gene_order(genes, piece)
        assert {r.gene_id: r.place for r in got.collect()} == wanted and got.columns == [*genes.columns, "place"]
    assert models.gene_order(genes.filter("false")).count() == 0


def test_canonical_transcripts_carry_their_own_columns(spark):
    t = tx(spark, ("a", "+", [(1, 90)], None, "g"), ("b", "+", [(1, 30), (51, 120)], (1, 60), "g"), ("c", "-", [(5, 9)], None, "h"))
    got = models.canonical_transcripts(t, carry=[F.size("exons").alias("n"), F.col("cds_start").isNotNull().alias("codes")])
    assert {tuple(r) for r in got.collect()} == {("g", "b", 2, True), ("h", "c", 1, False)}
