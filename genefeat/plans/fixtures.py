"""Gene models, contigs, tool rows and evidence derived from the given tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TX_EXONS = """
SELECT concat('r', CAST(CAST(floor(o_custkey / 30) AS BIGINT) AS VARCHAR(20))) AS seq_region,
       CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, tx AS transcript_id,
       concat('r', CAST(CAST(floor(o_custkey / 30) AS BIGINT) AS VARCHAR(20)), ':', CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END, ':',
              CAST(CAST(floor(((tx * 7919) % 1000000) / 5000) AS BIGINT) AS VARCHAR(20))) AS gene_id,
       CASE tx % 3 WHEN 0 THEN 'transcriptomic' WHEN 1 THEN 'busco' ELSE 'protein' END AS source,
       CASE WHEN tx % 4 = 0 THEN 'lncRNA' ELSE 'protein_coding' END AS biotype,
       1 + (o_orderkey * 7919) % 1000000 + ln * 400 + pk % 200 AS s,
       1 + (o_orderkey * 7919) % 1000000 + ln * 400 + pk % 200 + 20 + q * 4 AS e
FROM (SELECT l_orderkey AS tx, l_linenumber AS ln, min(l_partkey) AS pk, CAST(max(l_quantity) AS BIGINT) AS q
      FROM lineitem GROUP BY l_orderkey, l_linenumber) AS lines
JOIN orders ON tx = o_orderkey
"""

CONTIGS = """
SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', ''{g})),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS seq
FROM documents
"""

TOOL_ROWS = """
SELECT DISTINCT concat('r', CAST(l_suppkey AS VARCHAR(20))) AS seq_region,
  1 + (l_orderkey*613 + l_partkey*37) % 1000000 AS s,
  1 + (l_orderkey*613 + l_partkey*37) % 1000000 + 20 + CAST(l_quantity AS BIGINT)*20 AS e,
  1 + l_partkey % 20 AS period, l_quantity / 5 AS copies, 60 + l_partkey % 41 AS matches,
  20 + l_orderkey % 100 AS score, 30 + l_partkey % 50 AS gc, l_discount * 10 AS oe,
  l_linenumber % 3 AS strand_code, l_linenumber % 7 AS motif,
  CAST(l_quantity AS BIGINT) AS uniq, l_partkey % 30 AS multi, l_suppkey % 8 AS model
FROM lineitem
"""

EVIDENCE = """
SELECT o_orderkey AS transcript_id, (o_orderkey*31 % 101) / CAST(100 AS DOUBLE) AS rnasamba_prob, (o_orderkey*17 % 101) / CAST(100 AS DOUBLE) AS cpc2_prob,
       o_orderkey*31 % 101 >= 50 AS rnasamba_coding, o_orderkey*17 % 101 >= 50 AS cpc2_coding, o_orderkey*13 % 300 AS peptide_length
FROM orders
"""


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def exon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    # One shuffle by order serves the exons' aggregate, the join with orders and the models; the SQL alone would take two.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition("l_orderkey").createOrReplaceTempView("lineitem")
    return spark.sql(TX_EXONS).withColumnsRenamed({"s": "start", "e": "end"})


def raw_exon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exon for each line, repeated numbers and all."""
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    start = 1 + (F.col("l_orderkey") * 7919) % 1000000 + F.col("l_linenumber") * 400 + F.col("l_partkey") % 200
    region = F.concat(F.lit("r"), (F.col("l_suppkey") % 3).cast("string"))
    return t("lineitem").select(F.col("l_orderkey").alias("transcript_id"), region.alias("seq_region"), F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-").alias("strand"), start.alias("start"), (start + F.col("l_quantity").cast("bigint") * 4 - 60).alias("end"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_exons as models; the CDS is the span less 30 bases at each end, unless lncRNA or a span of 100 or less."""
    from ..operators.models import build_transcripts

    t = build_transcripts(exon_rows(spark, sf_dir), "gene_id", "source", "biotype")
    coding = (F.col("biotype") == "protein_coding") & (F.col("end") - F.col("start") >= 100)
    return t.withColumns({"cds_start": F.when(coding, F.col("start") + 30), "cds_end": F.when(coding, F.col("end") - 30)})


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "documents")
    return spark.sql(CONTIGS.format(g=""))


def tool_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "lineitem")
    return spark.sql(TOOL_ROWS).withColumnsRenamed({"s": "start", "e": "end"})


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return spark.sql(EVIDENCE)


def diamond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hit for every fifth transcript, another for every 25th."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    hit = o.filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("transcript_id"), ((F.col("o_orderkey") % 7 + 1) / 1000.0).alias("evalue"))
    return hit.unionByName(hit.filter("transcript_id % 25 = 0").withColumn("evalue", F.col("evalue") / 2))


# The same for DuckDB, as common table expressions.
TRANSCRIPTS = """
SELECT transcript_id, min(gene_id) AS gene_id, min(seq_region) AS seq_region, min(strand) AS strand, min(source) AS source, min(biotype) AS biotype,
       min(s) AS s, max(e) AS e, count(*) AS n_exons, sum(e - s + 1) AS len,
       CASE WHEN min(biotype) = 'protein_coding' AND max(e) - min(s) >= 100 THEN min(s) + 30 END AS cs, CASE WHEN min(biotype) = 'protein_coding' AND max(e) - min(s) >= 100 THEN max(e) - 30 END AS ce
FROM tx_exons GROUP BY transcript_id
"""

CDS_EXONS = """
SELECT x.transcript_id, t.gene_id, x.seq_region, x.strand, t.source, greatest(x.s, cs) AS s, least(x.e, ce) AS e
FROM tx_exons x JOIN tx t ON x.transcript_id = t.transcript_id WHERE x.s <= ce AND x.e >= cs
"""


DIAMOND = """
SELECT o_orderkey AS transcript_id, min(v) AS evalue, count(*) AS n_hits
FROM (SELECT o_orderkey, (o_orderkey % 7 + 1) / 1000.0::DOUBLE AS v FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT o_orderkey, (o_orderkey % 7 + 1) / 1000.0::DOUBLE / 2 FROM orders WHERE o_orderkey % 25 = 0) GROUP BY 1
"""


def duck(body: str, *ctes: str) -> str:
    """body after the CTEs named: tx_exons, tx, cds, contigs, tool_rows, evidence, diamond."""
    known = {"tx_exons": TX_EXONS, "tx": TRANSCRIPTS, "cds": CDS_EXONS, "contigs": CONTIGS.format(g=", 'g'"), "tool_rows": TOOL_ROWS, "evidence": EVIDENCE, "diamond": DIAMOND}
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({known[n]})" for n in ctes) + " " + body if ctes else body


# Lines of each tool over tool_rows, good and malformed, as expressions that Spark and DuckDB both run.
_T = "chr(9)"
TOOL_LINES = {
    "gtf": (f"concat_ws({_T}, seq_region, 't', 'exon', s, e, '.', '+', '.', 'gene_id \"g\";')", f"concat_ws({_T}, seq_region, 't', 'exon', 'x', e, '.', '+', '.', 'gene_id \"g\";')"),
    "bed12": (f"concat_ws({_T}, seq_region, s, e, 'n', '0', '+', '0', '0', '0', '1', '10,', '0,')", f"concat_ws({_T}, seq_region, s, e, 'n', '0', '+', '0', '0', '0', '2', '10,20,', '0,')"),
    "repeatmasker": ("concat_ws(' ', score, '1.0', '0.0', '0.0', seq_region, s, e, '(99)', '+', 'rep', 'LINE/L1', multi, period, '(7)', uniq)", "concat_ws(' ', score, '1.0', '0.0', '0.0', seq_region, s, e, '(99)', '+', 'rep', 'LINE/L1', multi, period, '(7)')"),
    "dust": ("concat_ws(' ', s, '-', e)", "concat_ws(' ', s, e)"),
    "trf": ("concat_ws(' ', s, e, period, '2.5', '9', matches, '0', score, '1', '2', '3', '4', '1.5', 'ACGT', 'ACGT')", "concat_ws(' ', s, e, period, 'x', '9', matches, '0', score, '1', '2', '3', '4', '1.5', 'ACGT', 'ACGT')"),
    "red": ("concat('>', seq_region, ':', s, '-', e)", "concat(seq_region, ':', s)"),
    "eponine": ("concat_ws(' ', seq_region, 'e', 'TSS', s, e, score, '+', '.')", "concat_ws(' ', seq_region, 'e', 'TSS', 'x', e, score, '+', '.')"),
    "cpg": ("concat_ws(' ', seq_region, s, e, score, '0', '0', gc, '1')", "concat_ws(' ', seq_region, s, e, score, '0', '0', 'x', '1')"),
    "trnascan": ("concat_ws(' ', seq_region, '1', s, e, 'Ala', 'TGC', '0', '0', score, 'pseudo')", "concat_ws(' ', seq_region, '1', s, e, 'Ala')"),
    "cmsearch": ("concat_ws(' ', seq_region, '-', 'm', 'RF1', 'cm', '1', '99', s, e, '+', 'no', '1', '0.5', '0.0', score, '1e-5', '!', '-')", "concat_ws(' ', seq_region, '-', 'm', 'RF1', 'cm', '1', '99', s, e, '+', 'no')"),
    "genblast": ("concat_ws(' ', seq_region, 'genBlastG', 'transcript', s, e, '30.9', '+', '.', 'ID=1;Name=77;PID=1')", "concat_ws(' ', seq_region, 'genBlastG', 'transcript', s, e, '30.9', '+', '.', 'ID=1')"),
    "augustus": (f"concat(concat_ws({_T}, seq_region, 'AUGUSTUS', 'transcript', s, e, '.', '+', '.', 'x'), chr(10), '# end gene')", f"concat_ws({_T}, seq_region, 'AUGUSTUS', 'transcript', 'x', e, '.', '+', '.', 'x')"),
    "star": (f"concat_ws({_T}, seq_region, s, e, strand_code, motif, '1', uniq, multi, '9')", f"concat_ws({_T}, seq_region, s, e, strand_code, 'x', '1', uniq, multi, '9')"),
    "rnasamba": (f"concat_ws({_T}, concat_ws('_', seq_region, s, e, period, matches, score, gc, strand_code, motif, uniq, multi, model, CAST(round(oe * 10) AS BIGINT)), '0.9', 'coding')", f"concat_ws({_T}, seq_region, s)"),
    "cpc2": (f"concat_ws({_T}, 't', '900', s, '0', '0', '0', '0', '0.7', 'coding')", f"concat_ws({_T}, 't', '900', 'x', '0', '0', '0', '0', '0.7', s)"),
    "diamond": (f"concat_ws({_T}, 't', 'P', s, e, '1', '0', '1', '9', '1', '9', '1e-5', score)", f"concat_ws({_T}, 't', 'P', s, e)"),
}
TOOL_GROUPS = {
    "repeats": ("repeatmasker", "dust", "trf", "red"),
    "small_features": ("eponine", "cpg", "trnascan", "cmsearch"),
    "models": ("gtf", "bed12", "genblast", "augustus"),
    "evidence": ("star", "rnasamba", "cpc2", "diamond"),
}
WITHOUT_REGION = ("rnasamba", "cpc2", "diamond")


def tool_lines(rows: DataFrame, tool: str) -> DataFrame:
    """(line): a tool's output on tool_rows(); that of rows with motif 6 is malformed."""
    good, bad = TOOL_LINES[tool]
    return rows.withColumnsRenamed({"start": "s", "end": "e"}).select(F.expr(f"CASE WHEN motif = 6 THEN {bad} ELSE {good} END").alias("line"))
