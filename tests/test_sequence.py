from pyspark.sql import functions as F

from genefeat.functions import sequence as sq


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int'}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def test_reverse_complement_keeps_case_and_inverts_itself(spark):
    assert one(spark, sq.reverse_complement("s"), s="AacgtN") == "NacgtT"
    assert one(spark, sq.reverse_complement(sq.reverse_complement("s")), s="gattacaNNACGT") == "gattacaNNACGT"
    assert one(spark, sq.reverse_complement("s"), s=None) is None


def test_all_codons_and_odd_ones(spark):
    seq = "".join(sq.CODONS)
    assert one(spark, sq.translate_codons("s"), s=seq) == "".join(sq.CODONS.values())
    assert one(spark, sq.amino_acids("s"), s="ATGNNNTAAAT") == "MX*"
    assert one(spark, sq.amino_acids("s"), s="") == ""


def test_bad_length_is_an_error(spark):
    import pytest

    with pytest.raises(Exception, match="not a multiple of 3"):
        one(spark, sq.translate_codons("s"), s="ATGA")


def test_orfs_take_the_first_start_since_the_last_stop(spark):
    seq = "CC" + "ATGAAAATGCCCTAA" + "ATGTTT"  # frame 2; the last start has no stop
    found = one(spark, sq.orfs_in_frame(F.col("s"), 2), s=seq)
    assert [(x.start, x.end) for x in found] == [(3, 17)]
    assert one(spark, sq.orfs_in_frame(F.col("s"), 0), s="") == []


def test_translation_without_start_wins_only_where_much_longer(spark):
    short_met = "ATGAAATAA" + "GCC" * 60
    got = one(spark, sq.best_translation("s", 2), s=short_met)
    assert (got.met, len(got.aa)) == (False, 62)  # another frame is open from end to end
    got = one(spark, sq.best_translation("s", 2), s="ATG" + "AAA" * 20 + "TAA" + "GCC" * 5)
    assert (got.met, got.start, got.end) == (True, 1, 66)
    assert one(spark, sq.best_translation("s", 50), s="ATGTAA") is None


def test_cut_sites(spark):
    tail = "AATAAA" + "G" * 14 + "CA" + "G" * 40
    assert one(spark, sq.pas_cut_site("s", 0), s="TT" + tail) == 8 + 16
    assert one(spark, sq.pas_cut_site("s", 0), s="AATAAA" + "G" * 60) == 36
    assert one(spark, sq.pas_cut_site("s", 8), s="TT" + tail) is None  # the signal is before the coding end
    assert one(spark, sq.pas_cut_site("s", 5), s="G" * 1200) == 1005
    assert one(spark, sq.pas_cut_site("s", 0), s="AATAAA" + "G" * 20) is None  # past the end


def test_splice_sites_and_cds(spark):
    assert one(spark, sq.is_canonical_splice("s"), s="gtccccag")
    assert not one(spark, sq.is_canonical_splice("s"), s="GTCCCCAC")
    assert one(spark, sq.valid_cds("s", 9), s="ATGCCCTAG")
    assert not one(spark, sq.valid_cds("s", 10), s="ATGCCCTAG")
