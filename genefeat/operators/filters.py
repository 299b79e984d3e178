"""Filters with published thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score thresholds that replace a model's own.
RFAM_THRESHOLDS = {"LSU_rRNA_eukarya": 1700.0, "SSU_rRNA_eukarya": 1600.0, "5_8S_rRNA": 85.0, "5S_rRNA": 75.0}
RFAM_DROPPED = ("LSU_rRNA_archaea", "LSU_rRNA_bacteria")


def trf_filter(rows: DataFrame, period: str = "period", copies: str = "copies", matches: str = "matches", score: str = "score") -> DataFrame:
    p, c, m, s = map(F.col, (period, copies, matches, score))
    return rows.filter(((s < 50) & (m >= 80) & (c > 2) & (p < 10)) | ((c >= 2) & (m >= 70) & (s >= 50)))


def cpg_filter(rows: DataFrame, min_length: int = 400, min_gc: float = 50, min_oe: float = 0.6) -> DataFrame:
    return rows.filter((F.col("end") - F.col("start") + 1 >= min_length) & (F.col("gc") >= min_gc) & (F.col("oe") >= min_oe))


def rfam_threshold(hits: DataFrame, models: DataFrame) -> DataFrame:
    """hits (query, score, ...) of known models (name, threshold) at or over the threshold."""
    own = F.col("threshold").cast("double")
    for name, value in RFAM_THRESHOLDS.items():
        own = F.when(F.col("query") == name, value).otherwise(own)
    joined = hits.join(models.select(F.col("name").alias("query"), "threshold"), "query")
    return joined.filter(~F.col("query").isin(*RFAM_DROPPED) & (F.col("score") >= own)).drop("threshold")


def select_models(models: DataFrame, accessions: DataFrame) -> DataFrame:
    return models.join(accessions, "accession", "left_semi")


def junction_filter(junctions: DataFrame, min_length: int = 100, min_multi: int = 10, strict: bool = True) -> DataFrame:
    """Junctions (strand_code, motif, multi, ...) with a strand; those with a motif code of 0 (not canonical) need
    min_multi reads on several places. strict=False leaves that last rule out."""
    keep = (F.col("strand_code") != 0) & (F.col("end") - F.col("start") + 1 >= min_length)
    if strict:
        keep = keep & ~((F.col("motif") == 0) & (F.col("multi") < min_multi))
    return junctions.filter(keep).withColumn("strand", F.when(F.col("strand_code") == 2, "-").otherwise("+"))


def small_model(cds_count: Column, cds_seq: Column, span: Column, min_cds: int = 300, min_span: int = 1000) -> Column:
    """Whether a model is too small: no CDS; one CDS exon; two without start or stop, or under twice min_cds; a short
    span or CDS."""
    n = F.coalesce(F.length(cds_seq), F.lit(0))
    ends = F.upper(cds_seq).rlike("^ATG") & F.upper(cds_seq).rlike("(TAA|TAG|TGA)$")
    return (n == 0) | (cds_count <= 1) | ((cds_count == 2) & (~ends | (n < 2 * min_cds))) | (span < min_span) | (n < min_cds)


def min_length_lncrna(transcripts: DataFrame, minimum: int = 200) -> DataFrame:
    """Transcripts of genes with any transcript of the minimum length."""
    from .models import total

    long = transcripts.withColumn("__n", total(F.col("exons"))).groupBy("gene_id").agg(F.max("__n").alias("n")).filter(F.col("n") >= minimum)
    return transcripts.join(long.select("gene_id"), "gene_id", "left_semi")


# Prefixes of repeat classes and the types they stand for, in the order that they are tried.
REPEAT_TYPES = [
    ("^Low_Comp", "Low complexity regions"),
    ("^LINE", "Type I Transposons/LINE"),
    ("^SINE", "Type I Transposons/SINE"),
    ("^DNA", "Type II Transposons"),
    ("^LTR", "LTRs"),
    ("^Other", "Other repeats"),
    ("^Satelli", "Satellite repeats"),
    ("^Simple", "Simple repeats"),
    ("^Tandem", "Tandem repeats"),
    ("^TRF", "Tandem repeats"),
    ("^Waterman", "Waterman"),
    ("^Recon", "Recon"),
    ("^Tet_repeat", "Tetraodon repeats"),
    ("^MaskRegion", "Mask region"),
    ("^dust", "Dust"),
    ("^Unknown", "Unknown"),
    ("RNA$", "RNA repeats"),
]


def repeat_class_type(repeat_class: str | Column, rna_at_end: bool = True) -> Column:
    """First pattern that fits. rna_at_end=False looks for RNA as the whole class only."""
    col = F.col(repeat_class) if isinstance(repeat_class, str) else repeat_class
    out = None
    for pattern, name in REPEAT_TYPES:
        pattern = pattern if rna_at_end or not pattern.endswith("$") else f"^{pattern}"
        out = F.when(col.rlike(pattern), name) if out is None else out.when(col.rlike(pattern), name)
    return out.otherwise("Unknown")


# Prefixes of family types and the biotypes they stand for; the last that fits counts.
RFAM_BIOTYPES = [("snRNA;", "snRNA"), ("snRNA; snoRNA", "snoRNA"), ("snRNA; snoRNA; scaRNA;", "scaRNA"), ("rRNA;", "rRNA"), ("antisense;", "antisense"), ("antitoxin;", "antitoxin"), ("ribozyme;", "ribozyme")]


def rfam_biotype(hits: DataFrame, families: DataFrame) -> DataFrame:
    """hits (accession, query, ...) with biotype from the families' types (accession, type): misc_RNA where nothing
    fits; vault and Y RNA by the family's name. Start and end are put in order."""
    told = hits.join(families.select("accession", F.col("type").alias("__type")), "accession", "left")
    biotype = F.when(F.lit(False), "")
    for prefix, name in reversed(RFAM_BIOTYPES):
        biotype = biotype.when(F.col("__type").startswith(prefix), name)
    biotype = F.when(F.lower("query").startswith("vault"), "Vault_RNA").when(F.col("query") == "Y_RNA", "Y_RNA").otherwise(biotype.otherwise("misc_RNA"))
    return told.withColumns({"biotype": biotype, "start": F.least("start", "end"), "end": F.greatest("start", "end")}).drop("__type")


def rfam_features(hits: DataFrame) -> DataFrame:
    """A transcript and an exon row for each hit."""
    return hits.withColumn("feature_type", F.explode(F.array(F.lit("transcript"), F.lit("exon"))))
