import gzip

from genefeat.sinks import export
from genefeat.sources import tools


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_gtf(spark, tmp_path):
    path = put(tmp_path, "a.gtf", '# c\nr1\ts\texon\t1\t9\t.\t-\t0\tgene_id "g; 1"; flag; n "2";\nr1\ts\texon\t1\t9\t.\t.\t.\tgene_id "h";\nr1\tbad\texon\t1\t9\nr1\ts\texon\tx\t9\t.\t+\t.\ta "b";\n')
    rows, rejects = tools.read_gtf(spark, path)
    got = rows.collect()
    assert [(r.start, r.strand) for r in got] == [(1, "-"), (1, "+")]
    assert got[0].attributes == {"gene_id": "g; 1", "flag": "1", "n": "2"}
    assert rejects.count() == 2
    assert tools.read_gtf(spark, path, strand_policy="fail")[0].count() == 1


def test_fasta_and_fastq(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">r1 told\nACG\nT\n>r2\nGG\n")
    assert sorted(map(tuple, tools.read_fasta(spark, path).collect())) == [("r1 told", "ACGT"), ("r2", "GG")]
    with gzip.open(tmp_path / "s_1.fastq.gz", "wt") as f:
        f.write("@a\nAC\n+\nII\n@b\nGT\n+\nJJ\n")
    got = tools.read_fastq(spark, str(tmp_path / "s_1.fastq.gz")).orderBy("read_no").collect()
    assert [tuple(r) for r in got] == [("s", 1, 0, "@a", "AC", "II"), ("s", 1, 1, "@b", "GT", "JJ")]
    put(tmp_path, "s_2.fastq", "@c\nTT\n+\nKK\n")
    mates = tools.pair_mates(tools.read_fastq(spark, [str(tmp_path / "s_1.fastq.gz"), str(tmp_path / "s_2.fastq")])).orderBy("read_no")
    assert [(r.sample, r.header1, r.header2) for r in mates.collect()] == [("s", "@a", "@c"), ("s", "@b", None)]


def test_repeat_tools(spark, tmp_path):
    rm = put(tmp_path, "r.out", "   SW perc\n  300 1.0 0.0 0.0 r1 11 20 (5) + AluY SINE/Alu 1 10 (3) 1 *\n  300 1.0 0.0 0.0 r1 11 20 (5) C L1 LINE/L1 (3) 10 2 2\n 12 13\n")
    rows, rejects = tools.read_repeatmasker(spark, rm)
    assert [(r.strand, r.repeat_start, r.repeat_end, r.repeat_type) for r in rows.collect()] == [("+", 1, 10, "Type I Transposons/SINE"), ("-", 2, 10, "Type I Transposons/LINE")]
    assert rejects.count() == 1
    dust = put(tmp_path, "r1.dust", ">r1\n9 - 19\n")
    assert [(r.start, r.end) for r in tools.read_dust(spark, dust, "r1")[0].collect()] == [(10, 20)]
    red = put(tmp_path, "r.rpt", ">r1:9-19\nodd\n")
    rows, rejects = tools.read_red(spark, red)
    assert [(r.seq_region, r.start, r.end) for r in rows.collect()] == [("r1", 10, 20)] and rejects.count() == 1
    trf = put(tmp_path, "t.dat", "1 30 3 10.0 3 90 0 60 25 25 25 25 2.0 ACG ACGACG\n1 30 3 1.0 3 90 0 60 25 25 25 25 2.0 ACG ACGACG\n")
    assert tools.read_trf(spark, trf, "r1")[0].count() == 1 and tools.read_trf(spark, trf, "r1", filtered=False)[0].count() == 2


def test_simple_features_and_rna(spark, tmp_path):
    ep = put(tmp_path, "e.txt", "r1 x y 10 20 0.9 -\nr1 x y 10 20 0.9 +\n")
    assert [(r.start, r.end) for r in tools.read_eponine(spark, ep)[0].collect()] == [(9, 19), (10, 20)]
    cpg = put(tmp_path, "c.txt", "r1 1 500 9 0 0 60 inf\nr1 1 500 9 0 0 60 0.7\n")
    assert [r.oe for r in tools.read_cpg(spark, cpg)[0].collect()] == [0.7]
    trna = put(tmp_path, "t.txt", "Sequence x\nr1 1 90 20 Ala TGC 0 0 77.1 high confidence set\nr1 1 20 90 Ala TGC 0 0 30.0 other\n")
    got = tools.read_trnascan(spark, trna)[0].collect()
    assert [(r.feature_type, r.start, r.strand, r.biotype) for r in got] == [("transcript", 20, "-", "tRNA"), ("exon", 20, "-", "tRNA"), ("transcript", 20, "+", "tRNA_pseudogene"), ("exon", 20, "+", "tRNA_pseudogene")]
    cm = put(tmp_path, "c.tbl", "# x\nr1 - U6 RF1 cm 1 50 90 20 - no 1 0.5 0.0 44.1 1e-9 ! -\n")
    assert [(r.start, r.end, r.strand, r.score) for r in tools.read_cmsearch_tblout(spark, cm)[0].collect()] == [(20, 90, "-", 44.1)]


def test_gene_tools(spark, tmp_path):
    gb = put(tmp_path, "g.gff", "1 genBlastG transcript 10 90 30.9 + . ID=77-R1-1-A1;Name=77;PID=1\n1 genBlastG coding_exon 10 90 . + . ID=77-R1-1-A1-E2;Parent=77-R1-1-A1\n")
    got = tools.read_genblast_gff(spark, gb)[0].collect()
    assert [(r.feature_type, r.transcript_id, r.exon_number) for r in got] == [("transcript", "77", None), ("exon", "77", 2)]
    line = "1\tAUGUSTUS\t{}\t{}\t{}\t.\t+\t.\tx\n"
    au = put(tmp_path, "a.rs101.re200.aug", line.format("transcript", 1, 50) + line.format("exon", 1, 20) + line.format("exon", 30, 50) + "# end gene g1\n" + line.format("exon", 60, 70))
    got = tools.read_augustus_gff(spark, au).orderBy("start", "feature_type").collect()
    assert [(r.feature_type, r.start, r.end, r.exon_number) for r in got] == [("exon", 101, 120, 1), ("transcript", 101, 150, None), ("exon", 130, 150, 2)]
    bed = put(tmp_path, "b.bed", "r1\t99\t300\tt1\t0\t-\t99\t300\t0\t2\t10,20,\t0,50,\n")
    from genefeat.operators.reads import bed12_to_transcripts

    assert [tuple(x) for x in bed12_to_transcripts(tools.read_bed12(spark, bed)[0]).first().exons] == [(100, 109), (150, 169)]


def test_evidence_and_rfam(spark, tmp_path):
    assert tools.read_rnasamba(spark, put(tmp_path, "r.tsv", "sequence_name\tp\tl\nt\t0.9\tcoding\nt\t0.1\tnoncoding\nx\ty\n"))[0].first().rnasamba_prob == 0.9  # the first of an id counts
    assert tools.read_cpc2(spark, put(tmp_path, "c.tsv", "#ID\nt\t9\t3\t0\t0\t0\t0\t0.7\tcoding\n"))[0].first().cpc2_coding
    assert tools.read_diamond(spark, put(tmp_path, "d.tsv", "t\tp" + "\t0" * 8 + "\t1e-5\t60\nshort\n"))[0].first().evalue == 1e-5
    seed = put(tmp_path, "s.seed", "#=GF AC   RF1\n#=GF ID   U6\n#=GF DE   told\n#=GF TP   Gene; snRNA;\nx\n//\n#=GF AC   RF2\n//\n")
    assert [tuple(r) for r in tools.read_rfam_seed(spark, seed).collect()] == [("RF1", "U6", "told", "snRNA;"), ("RF2", None, None, None)]
    cm = put(tmp_path, "m.cm", "INFERNAL1/a\nNAME  U6\nACC   RF1\nDESC  told\nCLEN  90\nW   120\nGA    40.50\n//\nHMMER3\nNAME U6\n//\n")
    assert [tuple(r) for r in tools.read_rfam_cm(spark, cm).collect()] == [("U6", "told", 90, 120, "RF1", 40.5)]
    sj = put(tmp_path, "j.tab", "r1\t1\t200\t2\t0\t1\t5\t3\t9\n")
    assert tools.read_star_junctions(spark, sj)[0].first().strand_code == 2


def test_exports(spark, tmp_path):
    from .test_models import tx

    t = tx(spark, ("a", "-", [(1, 100), (200, 300)], (10, 250)), ("b", "+", [(5, 9)], None))
    export.write_gtf(t, str(tmp_path / "out"))
    rows, rejects = tools.read_gtf(spark, str(tmp_path / "out"))
    assert rejects.count() == 0 and rows.count() == 7
    exon = rows.filter("feature_type = 'exon' and start = 200").first()
    assert exon.attributes["exon_number"] == "1"
    sets = export.sequence_sets(t.selectExpr("*", "'ACG' as cdna", "case when transcript_id = 'a' then 'MK' end as protein"))
    assert {k: v.count() for k, v in sets.items()} == {"cdna": 2, "canonical_cdna": 2, "protein": 1, "canonical_protein": 1}
    assert export.to_gene_tables(t)["translation"].first().start_offset == 51
