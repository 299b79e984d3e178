"""Runs over more regions than there should be folders."""

from genefeat.sources import ingest, tools

from .test_ingest import put, rejects, rows


def test_many_regions_are_no_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "MOST_FOLDERS", 3)
    src, out = tmp_path / "in", str(tmp_path / "out")
    run = lambda: ingest.ingest(spark, tools.read_red, str(src), out, "red")
    put(src, "a.rpt", ">01:9-19\n>1:1-2\nodd\n")
    assert run() == 1
    put(src, "b.rpt", "".join(f">0{i}:{i}-{i + 9}\n" for i in range(40)) + "strange\n")
    assert run() == 1 and run() == 0
    want = [("01", 10, 20), ("1", 2, 3), *((f"0{i}", i + 1, i + 10) for i in range(40))]
    assert rows(spark, out) == sorted(want) and rejects(spark, out) == ["odd", "strange"]
    assert sorted(x.name for x in (tmp_path / "out/features/analysis=red").iterdir() if x.is_dir()) == ["seq_region=01", "seq_region=1"]
    assert not [x for x in (tmp_path / "out/features_by_file/analysis=red").iterdir() if x.is_dir()]
    found = ingest.read_features(spark, out, "red").filter("seq_region = '07'")
    assert [(r.seq_region, r.start) for r in found.collect()] == [("07", 8)]
    assert "EqualTo(seq_region,07)" in found._jdf.queryExecution().toString()
    put(src, "b.rpt", ">2:0-1\n")  # changed: its earlier rows count no more
    assert run() == 1 and rows(spark, out) == [("01", 10, 20), ("1", 2, 3), ("2", 1, 2)] and rejects(spark, out) == ["odd"]


def test_manifests_without_columns(spark, tmp_path):
    """Runs of before the manifest told the columns are read as they were."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.rpt", ">1:9-19\nodd\n")
    assert ingest.ingest(spark, tools.read_red, str(src), out, "red") == 1
    at = f"{out}/manifest/analysis=red"
    old = spark.read.parquet(at).select("path", "size", "modified", "batch").collect()
    spark.createDataFrame(old).coalesce(1).write.mode("overwrite").parquet(at)
    assert rows(spark, out) == [("1", 10, 20)] and rejects(spark, out) == ["odd"]
    assert ingest.ingest(spark, tools.read_red, str(src), out, "red") == 0
