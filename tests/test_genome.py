"""The genome that the sequence queries read has every base of every document."""

from genefeat.plans import fixtures, queries


def write(spark, path, texts):
    spark.createDataFrame([(i * 200, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 5, 10.0), (2, 1, 9, 3.0)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, 1), (2, 40)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{path}/orders.parquet")


def test_genome_has_all_contigs(spark, tmp_path):
    d = str(tmp_path)
    write(spark, d, ["acgt" * 700, "", "ttga" * 13000, None, "g" * 10, "cat" * 401])  # ids share a residue of 200
    contigs = {r.doc_id: r.seq or "" for r in fixtures.contigs(spark, d).collect()}
    stream = "".join(contigs[k] for k in sorted(contigs))
    rows = sorted((int(r.seq_region[1:]), r.start, r.end, r.seq) for r in queries.genome(spark, d).collect())
    assert all(end - start + 1 == len(seq) == 1000 for _, start, end, seq in rows)
    assert len({r[0] for r in rows}) == 2 and len({r[:2] for r in rows}) == len(rows)
    assert "".join(r[3] for r in rows)[: len(stream)] == stream
