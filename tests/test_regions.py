"""Region indexes: which files a reader of some regions opens, and that nothing is lost where an index is old or missing."""

import os

from genefeat.sources import regions, tools


def line(region, start):
    return f"{region}\tx\texon\t{start}\t{start + 5}\t.\t+\t.\tgene_id \"g\";\n"


def told(spark, path, asked):
    rows, rejects = tools.read_gtf(spark, path, regions=asked)
    return sorted((r.seq_region, r.start) for r in rows.collect()), sorted(r.line for r in rejects.collect())


def names(spark, path, asked):
    return [os.path.basename(f) for f in regions.region_files(spark, path, asked)]


def test_only_files_of_the_regions_are_opened(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a b.gtf").write_text("#a\n" + line("1", 1) + line("2", 2))
    (path / "b.gtf").write_text(line("2", 3) + line("3", 4).replace("\n", "\r\n"))
    (path / "c.gtf").write_text(line("4", 5) + "odd\n")
    (path / "d.gtf").write_text("# nothing\n\n")
    (path / "e.gtf").write_text("")
    where, every = str(path), {("1", 1), ("2", 2), ("2", 3), ("3", 4), ("4", 5)}
    assert names(spark, where, ["2"]) == ["a b.gtf", "b.gtf", "c.gtf", "d.gtf"]  # no index yet
    before = {r: told(spark, where, [r]) for r in ("1", "2", "3", "4", "5")}
    regions.write_region_index(spark, where)
    assert names(spark, where, ["2"]) == ["a b.gtf", "b.gtf", "c.gtf"]
    assert names(spark, where, ["3", "5"]) == ["b.gtf", "c.gtf"]
    for r, was in before.items():
        assert told(spark, where, [r]) == was == (sorted(x for x in every if x[0] == r), ["odd"])
    assert told(spark, where, ["1", "3"])[0] == [("1", 1), ("3", 4)]
    plan = tools.read_gtf(spark, where, regions=["1"])[0].inputFiles()
    assert sorted(os.path.basename(f) for f in plan) == ["a%20b.gtf", "c.gtf"]
    assert len(tools.read_gtf(spark, where)[0].collect()) == 5  # the index is not data

    (path / "b.gtf").write_text(line("1", 30) + line("1", 40))  # changed, and a new one
    (path / "f.gtf").write_text(line("1", 50))
    assert told(spark, where, ["1"])[0] == [("1", 1), ("1", 30), ("1", 40), ("1", 50)]
    assert names(spark, where, ["4"]) == ["b.gtf", "c.gtf", "f.gtf"]
    regions.write_region_index(spark, where)
    assert names(spark, where, ["4"]) == ["c.gtf"]
    (path / "c.gtf").unlink()
    assert names(spark, where, ["9"]) == [] and told(spark, where, ["9"]) == ([], [])


def test_index_elsewhere(spark, tmp_path):
    path, index = tmp_path / "in", str(tmp_path / "index")
    path.mkdir()
    (path / "a.gtf").write_text(line("1", 1))
    (path / "b.gtf").write_text(line("2", 2))
    regions.write_region_index(spark, str(path), index)
    assert tools.read_gtf(spark, str(path), regions=["2"], index=index)[0].inputFiles()[0].endswith("b.gtf")
    assert sorted(p.name for p in path.iterdir()) == ["a.gtf", "b.gtf"]
