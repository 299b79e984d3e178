"""Ingest jobs: partitions, rejects, reruns, changed files, broken runs; Augustus over file blocks."""

import os

import pytest

from genefeat.sources import ingest, tools


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def rows(spark, out):
    return sorted((r.seq_region, r.start, r.end) for r in ingest.read_features(spark, out, "red").collect())


def rejects(spark, out):
    return sorted(r.line for r in ingest.read_rejects(spark, out, "red").collect())


def test_only_new_files_are_read(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.rpt", ">1:9-19\n>01:9-29\nodd\n")
    put(src, "b c.rpt", ">2:1-2\n")
    run = lambda: ingest.ingest(spark, tools.read_red, str(src), out, "red")
    assert run() == 2 and run() == 0
    assert rows(spark, out) == [("01", 10, 30), ("1", 10, 20), ("2", 2, 3)] and rejects(spark, out) == ["odd"]
    assert sorted(x.name for x in (tmp_path / "out/features/analysis=red").iterdir() if x.is_dir()) == ["seq_region=01", "seq_region=1", "seq_region=2"]
    put(src, "empty.rpt", "")
    put(src, "d.rpt", "strange\n>3:0-1\n")
    assert run() == 1 and run() == 0  # an empty file has nothing to read
    assert rows(spark, out) == [("01", 10, 30), ("1", 10, 20), ("2", 2, 3), ("3", 1, 2)] and rejects(spark, out) == ["odd", "strange"]
    put(src, "a.rpt", ">1:9-99\n")
    assert run() == 1
    assert rows(spark, out) == [("1", 10, 100), ("2", 2, 3), ("3", 1, 2)] and rejects(spark, out) == ["strange"]
    os.utime(src / "d.rpt", (1, 1))
    assert run() == 1 and len(rows(spark, out)) == 3 and rejects(spark, out) == ["strange"]
    plan = ingest.read_features(spark, out, "red").filter("seq_region = '2'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(seq_region" in plan


def test_a_run_that_breaks_off_leaves_nothing(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.rpt", ">1:9-19\nodd\n")
    good, bad = tools.read_red(spark, str(src))
    ingest.write_features(good, bad, out, "red", "00000000-broken")  # no entry in the manifest
    assert rows(spark, out) == [] and rejects(spark, out) == []
    assert ingest.ingest(spark, tools.read_red, str(src), out, "red") == 1
    assert rows(spark, out) == [("1", 10, 20)] and rejects(spark, out) == ["odd"]


@pytest.mark.parametrize("size", ["60", "500", "128m"])
def test_augustus_over_file_blocks(spark, tmp_path, size):
    """Ids, exon numbers and rejects are the same however a file is cut."""
    line = "1\tAUGUSTUS\t{}\t{}\t{}\t.\t+\t.\tx\n"
    text, want = "# start\n", []
    for g in range(1, 12):
        text += line.format("transcript", g, g + 50) + "".join(line.format("exon", g + k, g + k + 5) for k in range(g % 3 + 1)) + "1\tother\texon\t1\t2\t.\t+\t.\tx\n"
        text += (line.format("exon", "bad", g) if g == 5 else "") + f"# end gene g{g}\n"
        want += [("transcript", g, g + 50, f"aug1.{g}", None), *(("exon", g + k, g + k + 5, f"aug1.{g}", k + 1) for k in range(g % 3 + 1))]
    text += line.format("exon", 900, 901)
    put(tmp_path / "in", "x.gff", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found, bad = tools.read_augustus(spark, str(tmp_path / "in"))
        assert sorted(((r.feature_type, r.start, r.end, r.gene_id, r.exon_number) for r in found.collect()), key=str) == sorted(want, key=str)
        assert sorted(r.line.split("\t")[3] for r in bad.collect()) == ["900", "bad"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
