"""Registered queries: each operator over tables derived from the given ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..functions.tables import partitions, save, shared_dir
from ..operators import choice, clusters, evidence, filters, intervals, joining, models, reads, slices
from ..operators.orfs import chunk_orfs
from ..sinks import export
from ..sources import fasta, ingest, tools
from ..sources.regions import region_index
from . import fixtures, geneset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tx(spark, d, *sources: str) -> DataFrame:
    t = fixtures.transcripts(spark, d)
    return t.filter(F.col("source").isin(*sources)) if sources else t


def named_contigs(spark, d) -> DataFrame:
    return fixtures.contigs(spark, d).select(F.col("doc_id").cast("string").alias("name"), "seq")


def wide_utr(t: DataFrame) -> DataFrame:
    """A CDS over the middle half of each span."""
    quarter = F.floor((F.col("end") - F.col("start")) / 4)
    return t.withColumns({"cds_start": F.col("start") + quarter, "cds_end": F.col("end") - quarter})


def told_exons(t: DataFrame) -> DataFrame:
    return models.numbered_exons(t).select("transcript_id", "rank", "start", "end")


@query
def canonical_transcripts(spark, d):
    told = [F.size("exons").cast("bigint").alias("n_exons"), F.size(sq.introns("exons")).cast("bigint").alias("n_introns"), (F.col("end") - F.col("start") + 1).alias("span")]
    return models.canonical_transcripts(tx(spark, d), carry=told)


@query
def gene_models(spark, d):
    return models.build_genes(tx(spark, d))


@query
def intron_lengths(spark, d):
    return models.derive_introns(tx(spark, d)).select("transcript_id", "rank", "start", "end", "length")


@query
def short_intron_merge(spark, d):
    return models.merge_short_introns(tx(spark, d)).select("transcript_id", F.size("exons").cast("bigint").alias("n_exons"), models.total(F.col("exons")).alias("length"))


@query
def overlapping_exon_filter(spark, d):
    return models.drop_overlapping_exons(tx(spark, d)).select("transcript_id", F.size("exons").cast("bigint").alias("n_exons"))


@query
def model_integrity(spark, d):
    return models.check_model_integrity(fixtures.raw_exon_rows(spark, d))


@query
def attach_cds(spark, d):
    t = tx(spark, d)
    return models.attach_cds(t, clusters.coding_exons(t)).select("transcript_id", "cds_start", "cds_end")


@query
def translation_coords(spark, d):
    coords = models.format_translation_coords(models.translation_coords(F.col("exons"), F.col("strand"), F.col("cds_start"), F.col("cds_end")))
    t = tx(spark, d).filter(models.has_coding_exons()).withColumn("coords", coords)
    back = models.parse_translation_coords(F.col("coords"), F.col("exons"))
    return t.select("transcript_id", "coords", back.isNotNull().alias("parses"))


@query
def gene_biotypes(spark, d):
    return models.gene_biotypes(tx(spark, d)).select("gene_id", "transcript_id", "biotype", "gene_biotype")


@query
def override_biotypes(spark, d):
    return models.override_biotypes(tx(spark, d), "coding", "noncoding").select("gene_id", "transcript_id", "biotype", "gene_biotype")


@query
def region_lengths(spark, d):
    return slices.region_lengths(named_contigs(spark, d), 1000)


@query
def genome_size(spark, d):
    return slices.genome_size(slices.region_lengths(named_contigs(spark, d)))


@query
def make_slices(spark, d):
    return slices.make_slices(slices.region_lengths(named_contigs(spark, d)), 5000, 500, 1000)


@query
def split_by_length(spark, d):
    return slices.split_by_length(slices.region_lengths(named_contigs(spark, d)), 5000, 1000)


@query
def slice_rebase(spark, d):
    x = fixtures.exon_rows(spark, d)
    offset = F.floor((F.col("start") - 1) / 50_000) * 50_000 + 1
    kind = F.when(F.col("transcript_id") % 5 == 0, "intron").otherwise("exon")
    local = x.withColumn("slice_start", offset).withColumns({"start": F.col("start") - F.col("slice_start") + 1, "end": F.col("end") - F.col("slice_start") + 1, "feature_type": kind})
    return slices.slice_to_genome(local).select("seq_region", "transcript_id", "start", "end")


@query
def genome_to_slice(spark, d):
    x = fixtures.exon_rows(spark, d)
    cut = slices.make_slices(x.groupBy("seq_region").agg(F.max("end").alias("length")), 100_000, 10_000, 1000)
    return slices.genome_to_slice(x.select("seq_region", "transcript_id", "start", "end"), cut)


@query
def renumber_ids(spark, d):
    t = tx(spark, d).select("seq_region", "gene_id", "transcript_id", "start", "end")
    return slices.renumber_gene_ids(t).select("transcript_id", "new_gene_id", "new_transcript_id")


@query
def renumber_features(spark, d):
    rows = fixtures.exon_rows(spark, d).select("seq_region", "start", "end", "transcript_id")
    return slices.renumber_feature_ids(rows, "repeat", [F.col(c) for c in ("seq_region", "start", "end", "transcript_id")])


@query
def batch_records(spark, d):
    t = tx(spark, d).select("gene_id", "transcript_id", "start")
    return slices.batch_records(t, 20, [F.col("gene_id")], "gene").select("transcript_id", "batch")


@query
def batch_sequences(spark, d):
    return slices.batch_records(fixtures.contigs(spark, d).select("doc_id"), 20, [F.col("doc_id")], "sequence")


@query
def count_features(spark, d):
    rows = fixtures.exon_rows(spark, d).withColumn("feature_type", F.when(F.col("start") % 3 == 0, "intron").otherwise("exon"))
    return slices.count_features(rows, "exon")


@query
def min_rows(spark, d):
    x = fixtures.exon_rows(spark, d)
    return slices.check_min_rows({s: x.filter(F.col("source") == s) for s in geneset.PRIORITY})


@query
def get_sequence(spark, d):
    c = named_contigs(spark, d)
    wanted = c.filter(F.length("seq") >= 400).select(F.col("name").alias("id"), F.col("name").alias("seq_region"), F.when(F.col("name").cast("bigint") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("name").cast("bigint") % 150 + 1).alias("start"), (F.col("name").cast("bigint") % 150 + 210).alias("end"))
    return slices.get_sequence(slices.chunk_genome(c, 64), wanted, chunk=64)


@query
def sequence_to_genomic(spark, d):
    t = tx(spark, d)
    asked = t.select("transcript_id", F.explode(F.array(*(F.lit(n).cast("bigint") for n in (1, 50, 150)))).alias("position"))
    return models.sequence_to_genomic(models.numbered_exons(t), asked)


@query
def overlap_join(spark, d):
    t = tx(spark, d).select("transcript_id", "seq_region", "strand", "start", "end", "biotype")
    pairs = intervals.overlap_join(t.filter("biotype = 'lncRNA'"), t.filter("biotype <> 'lncRNA'"))
    return pairs.select(F.col("l.transcript_id").alias("left_id"), F.col("r.transcript_id").alias("right_id"), intervals.overlap_length(F.col("l.start"), F.col("l.end"), F.col("r.start"), F.col("r.end")).alias("overlap"))


@query
def containment(spark, d):
    t = tx(spark, d).select("transcript_id", "seq_region", "strand", "start", "end")
    pairs = intervals.containment_join(t, t).filter("l.transcript_id <> r.transcript_id")
    return pairs.select(F.col("l.transcript_id").alias("outer_id"), F.col("r.transcript_id").alias("inner_id"))


@query
def lncrna_overlap_filter(spark, d):
    return intervals.drop_lncrna_overlapping_coding(tx(spark, d)).select("transcript_id", "biotype")


@query
def lncrna_overlap_filter_unstranded(spark, d):
    return intervals.drop_lncrna_overlapping_coding(tx(spark, d), stranded=False).select("transcript_id", "biotype")


@query
def lncrna_min_length(spark, d):
    return filters.min_length_lncrna(tx(spark, d).filter("biotype = 'lncRNA'")).select("gene_id", "transcript_id")


@query
def span_clusters(spark, d):
    return intervals.cluster_by_span(tx(spark, d), piece=100_000).select("transcript_id", "cluster_start")


@query
def coding_exon_clusters(spark, d):
    return clusters.cluster_by_coding_exon(tx(spark, d)).select("transcript_id", "cluster", "cluster_size")


@query
def coding_overlap(spark, d):
    t = tx(spark, d)
    return clusters.coding_overlap(t.filter("source = 'transcriptomic'"), t.filter("source = 'protein'"))


@query
def layer_sets(spark, d):
    return geneset.layer_sets(tx(spark, d)).select("transcript_id", "source")


@query
def augment_sets(spark, d):
    t = models.single_transcript_genes(tx(spark, d).filter(models.has_coding_exons()))
    return geneset.augment_from(t.filter("source = 'transcriptomic'"), t.filter("source = 'busco'"), 0.9).select("transcript_id")


@query
def skipped_exons(spark, d):
    return clusters.skipped_exons(tx(spark, d))


@query
def readthrough_filter(spark, d):
    return clusters.remove_readthroughs(models.gene_biotypes(tx(spark, d)), 1).select("gene_id", "transcript_id")


@query
def cds_extents(spark, d):
    return clusters.cds_extents(tx(spark, d)).select("gene_id", "cds_low", "cds_high")


@query
def utr_over_neighbour(spark, d):
    return told_exons(clusters.trim_utr_over_neighbour_cds(wide_utr(tx(spark, d))))


@query
def collapse_transcripts(spark, d):
    return clusters.collapse_transcripts(tx(spark, d).filter(models.has_coding_exons()), max_per_cluster=2).select("transcript_id")


@query
def trf_filter(spark, d):
    return filters.trf_filter(fixtures.tool_rows(spark, d)).select("seq_region", "start", "end", "score")


@query
def cpg_filter(spark, d):
    return filters.cpg_filter(fixtures.tool_rows(spark, d)).select("seq_region", "start", "end", "gc")


@query
def junction_filter(spark, d):
    return filters.junction_filter(fixtures.tool_rows(spark, d)).select("seq_region", "start", "end", "strand", "multi")


RFAM_NAMES = ("LSU_rRNA_eukarya", "LSU_rRNA_archaea", "SSU_rRNA_eukarya", "5_8S_rRNA", "5S_rRNA", "Y_RNA", "U6", "Vault")
RFAM_TYPES = ("rRNA;", "rRNA;", "rRNA;", "rRNA;", "rRNA;", "snRNA;", "snRNA; snoRNA; CD-box;", "antisense;")


def rfam_models(spark, d) -> DataFrame:
    """Models by number, from the suppliers' keys."""
    number = (F.col("s_suppkey") % 8).cast("int")
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), number + 1)
    return spark.read.parquet(f"{d}/supplier.parquet").select(number.alias("model"), pick(RFAM_NAMES).alias("name"), pick(RFAM_TYPES).alias("type"), F.concat(F.lit("RF"), number.cast("string")).alias("accession"), (number * 10 + 30).cast("double").alias("threshold")).distinct()


def rfam_hits(spark, d) -> DataFrame:
    told = fixtures.tool_rows(spark, d).join(rfam_models(spark, d).select("model", F.col("name").alias("query"), "accession"), "model")
    return told.select("seq_region", "start", "end", F.when(F.col("strand_code") == 2, "-").otherwise("+").alias("strand"), "query", "accession", F.col("score").cast("double").alias("score"))


@query
def rfam_threshold(spark, d):
    return filters.rfam_threshold(rfam_hits(spark, d), rfam_models(spark, d).select("name", "threshold")).select("seq_region", "start", "end", "query", "score")


@query
def rfam_best_hits(spark, d):
    return choice.resolve_overlaps(rfam_hits(spark, d).drop("query")).select("seq_region", "strand", "start", "end", "accession", "score")


@query
def rfam_best_hits_greedy(spark, d):
    return choice.resolve_overlaps(rfam_hits(spark, d).drop("query"), mode="greedy").select("seq_region", "strand", "start", "end", "accession", "score")


@query
def rfam_biotype(spark, d):
    told = filters.rfam_features(filters.rfam_biotype(rfam_hits(spark, d), rfam_models(spark, d)))
    return told.groupBy("query", "biotype", "feature_type").agg(F.count("*").alias("n"))


@query
def select_models(spark, d):
    m = rfam_models(spark, d)
    return filters.select_models(m, m.filter("threshold >= 60").select("accession")).select("name", "accession", "threshold")


@query
def repeat_class_types(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    kinds = F.array(*map(F.lit, ("LINE/L1", "SINE", "DNA/hAT", "LTR/Gypsy", "Simple_repeat", "tRNA", "rRNA", "Satellite", "Low_complexity", "odd")))
    return part.select("p_partkey", filters.repeat_class_type(F.element_at(kinds, (F.col("p_partkey") % 10 + 1).cast("int"))).alias("repeat_type"))


def _validated(mode):
    def run(spark, d):
        t = models.single_transcript_genes(tx(spark, d)).drop("biotype")
        e = evidence.combine_evidence(fixtures.evidence(spark, d).select("transcript_id", "rnasamba_prob", "rnasamba_coding"), fixtures.evidence(spark, d).select("transcript_id", "cpc2_prob", "cpc2_coding", "peptide_length"), fixtures.diamond(spark, d))
        return evidence.validate_coding(t, e, mode)[0].select("transcript_id", "biotype", "cds_start")

    return run


for _mode in (None, "relaxed", "moderate"):
    QUERIES[f"coding_validation_{_mode or 'general'}"] = _validated(_mode)


@query
def combine_evidence(spark, d):
    e = fixtures.evidence(spark, d)
    told = evidence.combine_evidence(e.select("transcript_id", "rnasamba_prob"), e.select("transcript_id", "cpc2_prob"), fixtures.diamond(spark, d))
    return told.select("transcript_id", "rnasamba_prob", "cpc2_prob", "evalue", "n_hits")


@query
def exon_hints(spark, d):
    return evidence.exon_hints(fixtures.exon_rows(spark, d))


@query
def junction_hints(spark, d):
    return evidence.junction_hints(fixtures.tool_rows(spark, d))


@query
def cds_chain_counts(spark, d):
    return evidence.cds_chain_counts(tx(spark, d)).groupBy("seq_region", "n").agg(F.count("*").alias("n_chains"))


@query
def model_stats(spark, d):
    told = evidence.model_stats(tx(spark, d))
    return told.select("transcript_id", "n_exons", "n_cds_exons", "cds_length", F.round("mean_cds_exon", 6).alias("mean_cds_exon"), F.round("cds_ratio", 6).alias("cds_ratio"), "span", "longest_intron")


@query
def model_scores(spark, d):
    return evidence.score_models(tx(spark, d)).select("transcript_id", "score", "is_good")


@query
def sub_chain_filter(spark, d):
    named = clusters.cluster_by_coding_exon(tx(spark, d).filter(models.has_coding_exons()))
    return evidence.drop_sub_chains(named).select("transcript_id", "is_good")


@query
def final_classification(spark, d):
    scored = evidence.score_models(tx(spark, d)).drop("score")
    return evidence.final_classification(scored).select("transcript_id", "class")


@query
def reverse_complement(spark, d):
    return fixtures.contigs(spark, d).select("doc_id", F.md5(sq.reverse_complement("seq").cast("binary")).alias("digest"))


@query
def translate(spark, d):
    whole = F.substring("seq", F.lit(1), (F.floor(F.length("seq") / 3) * 3).cast("int"))
    return fixtures.contigs(spark, d).select("doc_id", F.md5(sq.translate_codons(whole).cast("binary")).alias("digest"))


@query
def orfs(spark, d):
    c = fixtures.contigs(spark, d).select("doc_id", F.posexplode(F.regexp_extract_all("seq", F.lit("(?s).{1,100000}"), F.lit(0))).alias("k", "seq"))
    start = F.col("k").cast("bigint") * 100_000
    chunks = c.select("doc_id", (start + 1).alias("start"), (start + F.length("seq")).alias("end"), "seq")
    return chunk_orfs(save(chunks), 60, "doc_id").select("doc_id", "strand", "frame", "start", "end")


@query
def orfs_in_sequences(spark, d):
    """As orfs, by expressions over whole sequences."""
    c = fixtures.contigs(spark, d)
    both = c.withColumn("strand", F.lit("+")).unionByName(c.select("doc_id", sq.reverse_complement("seq").alias("seq"), F.lit("-").alias("strand")))
    frames = both.select("doc_id", "strand", F.explode(F.array(*(F.struct(F.lit(f).alias("frame"), sq.orfs_in_frame(F.col("seq"), f).alias("found")) for f in range(3)))).alias("x"))
    each = frames.select("doc_id", "strand", F.col("x.frame").alias("frame"), F.explode("x.found").alias("o"))
    told = each.select("doc_id", "strand", F.col("frame").cast("bigint").alias("frame"), F.col("o.start").cast("bigint").alias("start"), F.col("o.end").cast("bigint").alias("end"))
    return told.filter(F.col("end") - F.col("start") + 1 >= 60)


@query
def best_translations(spark, d):
    t = fixtures.contigs(spark, d).select("doc_id", sq.best_translation("seq", 20).alias("t"))
    return t.select("doc_id", F.col("t.start").cast("bigint").alias("start"), F.col("t.end").cast("bigint").alias("end"), F.col("t.met").alias("met"))


@query
def pas_sites(spark, d):
    return fixtures.contigs(spark, d).select("doc_id", sq.pas_cut_site("seq", (F.col("doc_id") % 100).cast("int")).cast("bigint").alias("cut"))


@query
def splice_sites(spark, d):
    at = (F.col("doc_id") % 50 + 1).cast("int")
    return fixtures.contigs(spark, d).filter(F.length("seq") > 200).select("doc_id", sq.is_canonical_splice(F.substring("seq", at, F.lit(100))).alias("canonical"), sq.valid_cds("seq", 300).alias("valid"))


@query
def exon_strings(spark, d):
    return tx(spark, d).select("transcript_id", sq.exon_string("exons", "strand").alias("exon_string"), sq.intron_string("exons").alias("intron_string"))


@query
def bed12_to_exons(spark, d):
    t = tx(spark, d)
    bed = t.select(F.col("transcript_id").alias("name"), "seq_region", "strand", (F.col("start") - 1).alias("offset"), F.transform("exons", lambda x: x["end"] - x["start"] + 1).alias("sizes"), F.transform("exons", lambda x: x["start"] - F.col("start")).alias("starts"))
    return reads.bed12_to_exons(bed)


@query
def gtf_roundtrip(spark, d):
    """Models written as GTF and read back."""
    path = f"{shared_dir(spark)}/gtf_{uuid.uuid4().hex}"
    export.write_gtf(tx(spark, d), path, compression="gzip")
    rows, _ = tools.read_gtf(spark, path)
    return rows.filter("feature_type = 'exon'").select(F.col("attributes")["transcript_id"].cast("bigint").alias("transcript_id"), F.col("attributes")["exon_number"].cast("bigint").alias("rank"), "seq_region", "strand", "start", "end")


@query
def gtf_of_regions(spark, d):
    """Exons by transcript of some regions of a GTF, of which only the files that hold them are opened."""
    path = f"{shared_dir(spark)}/gtf_{uuid.uuid4().hex}"
    export.write_gtf(tx(spark, d), path, compression="gzip")
    rows, _ = tools.read_gtf(spark, path, regions=["r1", "r10", "r2", "r7"])
    ids = F.col("attributes")["transcript_id"].cast("bigint").alias("transcript_id")
    return rows.filter("feature_type = 'exon'").groupBy("seq_region", "strand", ids).agg(F.count("*").alias("n_exons"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


@query
def gtf_region_index(spark, d):
    """What the index of a written GTF says of each region: its lines over all files."""
    path = f"{shared_dir(spark)}/gtf_{uuid.uuid4().hex}"
    export.write_gtf(tx(spark, d), path, compression="gzip")
    return region_index(spark, path).groupBy("seq_region").agg(F.sum("n_lines").alias("n_lines"))


@query
def fasta_roundtrip(spark, d):
    """Contigs written as FASTA and read back."""
    path = f"{shared_dir(spark)}/fasta_{uuid.uuid4().hex}"
    c = named_contigs(spark, d).filter(F.length("seq") > 0)
    c.select(F.concat(F.lit(">"), "name", F.lit("\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))).write.text(path)
    return tools.read_fasta(spark, path).select("name", F.length("seq").cast("bigint").alias("length"), F.md5(F.col("seq").cast("binary")).alias("digest"))


def wrapped_fasta(spark, c: DataFrame, width: int = 60) -> str:
    """The folder of contigs (name, seq) as FASTA with a note in each header."""
    return written(spark, c.select(F.concat(F.lit(">"), "name", F.lit(" a contig\n"), F.regexp_replace("seq", f"(.{{{width}}})", "$1\n")).alias("line")))


@query
def fasta_chunks(spark, d):
    """Contigs written as FASTA and read straight to chunks."""
    chunks, _ = fasta.read_fasta_chunks(spark, wrapped_fasta(spark, named_contigs(spark, d)), 1000)
    return chunks.select("seq_region", "start", "end", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query
def fasta_lengths(spark, d):
    chunks, _ = fasta.read_fasta_chunks(spark, wrapped_fasta(spark, named_contigs(spark, d)), 1000)
    return fasta.chunk_lengths(chunks, 500)


@query
def orfs_over_chunks(spark, d):
    """From FASTA to ORFs over chunks that are shorter than many of them."""
    chunks, _ = fasta.read_fasta_chunks(spark, wrapped_fasta(spark, named_contigs(spark, d)), 200)
    found = chunk_orfs(save(chunks), 60)
    return found.select(F.col("seq_region").cast("bigint").alias("doc_id"), "strand", "frame", "start", "end")


def _attributed(spark, d) -> DataFrame:
    rows = fixtures.tool_rows(spark, d).withColumn("strand", F.lit("+"))
    keys = F.when(F.col("model") == 0, F.create_map(F.lit("score"), F.col("score").cast("string"))).otherwise(F.create_map(F.lit("score"), F.col("score").cast("string"), F.lit("repeat_name"), F.concat(F.lit("m"), F.col("model").cast("string"))))
    return rows.withColumn("attributes", keys)


@query
def repeat_table(spark, d):
    return export.to_repeat_table(_attributed(spark, d), "trf")


@query
def simple_feature_table(spark, d):
    return export.to_simple_feature_table(_attributed(spark, d), "cpg")


@query
def collate_results(spark, d):
    rows = fixtures.tool_rows(spark, d)
    told = export.collate_results({"trf": filters.trf_filter(rows), "cpg": filters.cpg_filter(rows)})
    return told.groupBy("analysis").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


@query
def gene_tables(spark, d):
    tables = export.to_gene_tables(tx(spark, d))
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def gene_table(spark, d):
    return export.to_gene_tables(tx(spark, d))["gene"]


@query
def utr_split(spark, d):
    told = models.split_utr(wide_utr(tx(spark, d)))
    return told.select("transcript_id", F.size("utr5").cast("bigint").alias("n5"), F.size("utr3").cast("bigint").alias("n3"), "utr5_length", "utr3_length")


@query
def three_prime_trim(spark, d):
    return told_exons(models.trim_three_prime(wide_utr(tx(spark, d)), max_utr=80))


@query
def five_prime_trim(spark, d):
    return told_exons(models.trim_five_prime(wide_utr(tx(spark, d))))


@query
def dedup_proteins(spark, d):
    c = named_contigs(spark, d).select(F.concat(F.lit("6573_0:"), F.lpad("name", 8, "0"), F.lit(" made")).alias("name"), sq.amino_acids("seq").alias("seq"))
    kept = reads.reheader_proteins(reads.dedup_proteins(c))
    return kept.select("name", F.length("seq").cast("bigint").alias("length"))


def _sampled(**options) -> Query:
    def run(spark, d):
        r = fixtures.contigs(spark, d).select(F.col("doc_id").alias("read_no"), F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
        return reads.subsample_reads(r, key=(F.col("read_no") * 7919) % 10007, **options)

    return run


QUERIES["subsample_reads"] = _sampled(limit=400, fraction=0.3)
QUERIES["subsample_reads_smaller"] = _sampled(limit=200, fraction=0.3, method=0)
QUERIES["subsample_reads_share"] = _sampled(limit=100, fraction=0.3, method=1)
QUERIES["subsample_reads_limit"] = _sampled(limit=150)


@query
def paired_files(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    name = F.concat(F.lit("in/s"), F.floor(F.col("c_custkey") / 2).cast("string"), F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.concat(F.lit("_"), (F.col("c_custkey") % 2 + 1).cast("string"))), F.lit(".fastq.gz"))
    return tools.paired_files(c.select(name.alias("path")))


@query
def pair_mates(spark, d):
    r = fixtures.contigs(spark, d).select(F.lit("s").alias("sample"), (F.col("doc_id") % 2 + 1).cast("int").alias("mate"), F.floor(F.col("doc_id") / 2).alias("read_no"), F.col("doc_id").cast("string").alias("header"), "seq", F.lit("I").alias("qual"))
    return tools.pair_mates(r).select("read_no", "header1", "header2", "seq1", "seq2")


@query
def clade_members(spark, d):
    region, nation = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("region", "nation"))
    levels = region.select(F.col("r_regionkey").alias("level_id"), F.col("r_name").alias("name"))
    path = nation.select(F.col("n_name").alias("species"), F.concat(F.lit("{"), F.col("n_regionkey").cast("string"), F.lit(","), (F.col("n_nationkey") + 100).cast("string"), F.lit("}")).alias("path"))
    return reads.clade_members(levels, path, "1")


@query
def small_models(spark, d):
    t = tx(spark, d)
    n = F.size(models.cds_exons())
    seq = F.when(F.col("cds_start").isNotNull(), F.concat(F.lit("ATG"), F.repeat(F.lit("A"), F.greatest(models.total(models.cds_exons()) - 6, F.lit(0)).cast("int")), F.lit("TAA")))
    return t.select("transcript_id", filters.small_model(n, seq, F.col("end") - F.col("start") + 1).alias("small"))


# Readers: tool output is written as text from the given tables, and read back.


def written(spark, lines: DataFrame, compression: str = "none") -> str:
    """The folder of a table of lines, written as text."""
    path = f"{shared_dir(spark)}/text_{uuid.uuid4().hex}"
    lines.write.text(path, compression=compression)
    return path


def spaced(*parts, sep: str = " ") -> Column:
    return F.concat_ws(sep, *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)).alias("line")


def tabbed(*parts) -> Column:
    return spaced(*parts, sep="\t")


C = F.col


@query
def read_fastq(spark, d):
    c = fixtures.contigs(spark, d).filter(F.length("seq") > 0)
    path = written(spark, c.select(F.concat_ws("\n", F.concat(F.lit("@"), "doc_id"), "seq", F.lit("+"), F.repeat(F.lit("I"), F.length("seq"))).alias("line")))
    return tools.read_fastq(spark, path, 1).select("mate", "header", F.md5(C("seq").cast("binary")).alias("digest"), F.length("qual").cast("bigint").alias("n_qual"))


@query
def read_bed12(spark, d):
    joined = lambda f: F.array_join(F.transform("exons", f), ",")
    lines = tx(spark, d).select(tabbed(C("seq_region"), C("start") - 1, C("end"), C("transcript_id"), 0, C("strand"), 0, 0, 0, F.size("exons"), F.concat(joined(lambda x: (x["end"] - x["start"] + 1).cast("string")), F.lit(",")), joined(lambda x: (x["start"] - C("start")).cast("string"))))
    rows, _ = tools.read_bed12(spark, written(spark, lines))
    return reads.bed12_to_exons(rows).select(C("name").cast("bigint").alias("name"), "seq_region", "strand", "rank", "start", "end")


@query
def read_repeatmasker(spark, d):
    """Every seventh line lacks a field and is a reject; there are head lines."""
    t = fixtures.tool_rows(spark, d)
    plus, kinds = C("strand_code") != 2, F.array(*map(F.lit, ("LINE/L1", "DNA/hAT", "Simple_repeat")))
    line = spaced(C("score"), 1.0, 0.0, 0.0, C("seq_region"), C("start"), C("end"), F.lit("(99)"), F.when(plus, "+").otherwise("C"), F.concat(F.lit("rep"), C("model").cast("string")), F.element_at(kinds, (C("motif") % 3 + 1).cast("int")), F.when(plus, C("multi").cast("string")).otherwise("(7)"), C("period"), F.when(plus, "(7)").otherwise(C("multi").cast("string")), C("uniq"))
    lines = t.select(F.when(C("motif") == 6, F.regexp_replace(line, r" \S+$", "")).when(C("motif") == 5, F.concat(line, F.lit(" *"))).otherwise(line).alias("line"))
    rows, _ = tools.read_repeatmasker(spark, written(spark, lines.union(t.limit(1).select(F.lit("   SW  perc perc")))))
    return rows.drop("path")


@query
def read_dust(spark, d):
    rows, _ = tools.read_dust(spark, written(spark, fixtures.tool_rows(spark, d).select(spaced(C("start") - 1, "-", C("end") - 1))), "r1")
    return rows.drop("path")


@query
def read_trf(spark, d):
    line = spaced(C("start"), C("end"), C("period"), C("copies"), 9, C("matches"), 0, C("score"), 1, 2, 3, 4, 1.5, "ACGT", "ACGTACGT")
    rows, _ = tools.read_trf(spark, written(spark, fixtures.tool_rows(spark, d).select(line)), "r1")
    return rows.drop("path")


@query
def read_red(spark, d):
    line = F.concat(F.lit(">"), "seq_region", F.lit(":"), (C("start") - 1).cast("string"), F.lit("-"), (C("end") - 1).cast("string"))
    return tools.read_red(spark, written(spark, fixtures.tool_rows(spark, d).select(line)))[0].drop("path")


@query
def read_eponine(spark, d):
    minus = C("strand_code") == 2
    line = spaced(C("seq_region"), "eponine", "TSS", C("start") + minus.cast("int"), C("end") + minus.cast("int"), C("score"), F.when(minus, "-").otherwise("+"), ".")
    t = fixtures.tool_rows(spark, d)
    return tools.read_eponine(spark, written(spark, t.select(line).union(t.limit(1).select(F.lit("# head")))))[0].drop("path")


@query
def read_cpg(spark, d):
    line = spaced(C("seq_region"), C("start"), C("end"), C("score"), 0, 0, C("gc"), F.when(C("motif") == 0, "-").when(C("motif") == 1, "inf").otherwise(C("oe").cast("string")))
    return tools.read_cpg(spark, written(spark, fixtures.tool_rows(spark, d).select(line)))[0].drop("path")


@query
def read_trnascan(spark, d):
    minus = C("strand_code") == 2
    line = spaced(C("seq_region"), 1, F.when(minus, C("end")).otherwise(C("start")), F.when(minus, C("start")).otherwise(C("end")), F.concat(F.lit("Ala"), C("model").cast("string")), "TGC", 0, 0, C("score"), F.when(C("motif") < 3, "high confidence set").otherwise("pseudo"))
    t = fixtures.tool_rows(spark, d)
    return tools.read_trnascan(spark, written(spark, t.select(line).union(t.limit(1).select(F.lit("Sequence  tRNA Bounds")))))[0].drop("path")


@query
def read_cmsearch(spark, d):
    line = spaced(C("seq_region"), "-", F.concat(F.lit("m"), C("model").cast("string")), F.concat(F.lit("RF"), C("model").cast("string")), "cm", 1, 99, F.when(C("strand_code") == 2, C("end")).otherwise(C("start")), F.when(C("strand_code") == 2, C("start")).otherwise(C("end")), F.when(C("strand_code") == 2, "-").otherwise("+"), "no", 1, 0.5, 0.0, C("score"), "1e-5", "!", "-")
    return tools.read_cmsearch_tblout(spark, written(spark, fixtures.tool_rows(spark, d).select(line)))[0].drop("path")


@query
def read_genblast(spark, d):
    t = tx(spark, d)
    name = lambda rank: F.concat(F.lit("ID=x;Name=P"), C("transcript_id").cast("string"))
    whole = t.select(spaced(C("seq_region"), "genBlast", "transcript", C("start"), C("end"), 50.5, C("strand"), ".", name(0)))
    parts = models.numbered_exons(t).select(spaced(C("seq_region"), "genBlast", "coding_exon", C("start"), C("end"), 1.5, C("strand"), ".", F.concat(F.lit("ID=P"), C("transcript_id").cast("string"), F.lit("-R1-1-A1-E"), C("rank").cast("string"), F.lit(";Parent=P"), C("transcript_id").cast("string"), F.lit("-R1-1-A1"))))
    return tools.read_genblast_gff(spark, written(spark, whole.union(parts)))[0].drop("path")


@query
def read_augustus(spark, d):
    """A record for each model; ids follow files, so they are left out here."""
    t = tx(spark, d)
    line = lambda kind, a, b: F.concat_ws("\t", "seq_region", F.lit("AUGUSTUS"), F.lit(kind), a.cast("string"), b.cast("string"), F.lit("0.9"), "strand", F.lit("."), F.lit("g1.t1"))
    record = F.concat_ws("\n", F.lit("# start gene g1"), line("gene", C("start"), C("end")), line("transcript", C("start"), C("end")), F.array_join(F.transform("exons", lambda x: line("exon", x["start"], x["end"])), "\n"), F.lit("# end gene g1"))
    return tools.read_augustus_gff(spark, written(spark, t.select(record.alias("line")))).select("seq_region", "feature_type", "start", "end", "strand", C("exon_number").cast("bigint").alias("exon_number"))


@query
def read_star_junctions(spark, d):
    line = tabbed(C("seq_region"), C("start"), C("end"), C("strand_code"), C("motif"), 1, C("uniq"), C("multi"), 30)
    return tools.read_star_junctions(spark, written(spark, fixtures.tool_rows(spark, d).select(line)))[0].drop("path")


@query
def read_rnasamba(spark, d):
    """Every tenth line has a field too many."""
    e = fixtures.evidence(spark, d)
    line = tabbed(C("transcript_id"), C("rnasamba_prob"), F.when(C("rnasamba_coding"), "coding").otherwise("noncoding"))
    lines = e.select(F.when(C("transcript_id") % 10 == 0, F.concat(line, F.lit("\tx"))).otherwise(line)).union(e.limit(1).select(F.lit("sequence_name\tp\tlabel")))
    return tools.read_rnasamba(spark, written(spark, lines))[0].drop("path")


@query
def read_cpc2(spark, d):
    line = tabbed(C("transcript_id"), 900, C("peptide_length"), 0.1, 5.0, 1, 0.2, C("cpc2_prob"), F.when(C("cpc2_coding"), "coding").otherwise("noncoding"))
    return tools.read_cpc2(spark, written(spark, fixtures.evidence(spark, d).select(line)))[0].drop("path")


@query
def read_diamond(spark, d):
    line = tabbed(C("transcript_id"), "P1", 90.0, 100, 1, 0, 1, 100, 1, 100, C("evalue"), 200)
    rows, _ = tools.read_diamond(spark, written(spark, fixtures.diamond(spark, d).select(line)))
    return rows.groupBy("transcript_id").agg(F.min("evalue").alias("evalue"), F.count("*").alias("n_hits"))


@query
def read_rfam_seed(spark, d):
    m = rfam_models(spark, d)
    block = F.concat(F.lit("# STOCKHOLM 1.0\n#=GF AC   "), "accession", F.lit("\n#=GF ID   "), "name", F.lit("\n#=GF DE   about "), "name", F.lit("\n#=GF TP   Gene; "), "type", F.lit("\nseq ACGU\n//"))
    return tools.read_rfam_seed(spark, written(spark, m.select(block.alias("line"))))


@query
def read_rfam_cm(spark, d):
    """An INFERNAL and a HMMER block for each model."""
    m = rfam_models(spark, d)
    block = lambda kind: F.concat(F.lit(f"{kind}/1\nNAME     "), "name", F.lit("\nACC      "), "accession", F.lit("\nDESC     thing\nCLEN     "), (C("model") * 10 + 50).cast("string"), F.lit("\nW        "), (C("model") * 10 + 80).cast("string"), F.lit("\nGA       "), C("threshold").cast("string"), F.lit("\n//"))
    return tools.read_rfam_cm(spark, written(spark, m.select(block("INFERNAL1").alias("line")).union(m.select(block("HMMER3")))))


@query
def sequence_sets(spark, d):
    """The four FASTA sets of models with made-up sequences, written and read back."""
    t = tx(spark, d).withColumns({"cdna": F.repeat(F.lit("ACGT"), (C("end") % 7 + 1).cast("int")), "protein": F.when(C("cds_start").isNotNull(), F.repeat(F.lit("MK"), (C("start") % 5 + 1).cast("int")))})
    path = f"{shared_dir(spark)}/sets_{uuid.uuid4().hex}"
    export.write_sequences(t, path)
    out = None
    for name in ("cdna", "canonical_cdna", "protein", "canonical_protein"):
        one = tools.read_fasta(spark, f"{path}/{name}").select(F.lit(name).alias("set"), C("name").cast("bigint").alias("transcript_id"), "seq")
        out = one if out is None else out.unionByName(one)
    return out


# Ingest jobs of every reader.

READERS: dict[str, ingest.Reader] = {
    "gtf": tools.read_gtf,
    "bed12": tools.read_bed12,
    "repeatmasker": tools.read_repeatmasker,
    "dust": lambda spark, path: tools.read_dust(spark, path, "r1"),
    "trf": lambda spark, path: tools.read_trf(spark, path, "r1", filtered=False),
    "red": tools.read_red,
    "eponine": tools.read_eponine,
    "cpg": lambda spark, path: tools.read_cpg(spark, path, filtered=False),
    "trnascan": tools.read_trnascan,
    "cmsearch": tools.read_cmsearch_tblout,
    "genblast": tools.read_genblast_gff,
    "augustus": tools.read_augustus,
    "star": tools.read_star_junctions,
    "rnasamba": tools.read_rnasamba,
    "cpc2": tools.read_cpc2,
    "diamond": tools.read_diamond,
}


def _ingest(group: str) -> Query:
    def run(spark, d):
        """What a group of readers leaves in feature tables, by region, and in rejects. A second run finds nothing new."""
        out, told = f"{shared_dir(spark)}/ingest_{uuid.uuid4().hex}", None
        given = save(fixtures.tool_rows(spark, d))
        for tool in fixtures.TOOL_GROUPS[group]:
            path = written(spark, fixtures.tool_lines(given, tool), "gzip")
            if not ingest.ingest(spark, READERS[tool], path, out, tool) or ingest.ingest(spark, READERS[tool], path, out, tool):
                raise RuntimeError(f"{tool}: files are not read once")
            rows = ingest.read_features(spark, out, tool)
            region = C("seq_region") if "seq_region" in rows.columns else F.lit(None).cast("string")
            both = rows.select(F.lit("row").alias("kind"), region.alias("value")).unionByName(ingest.read_rejects(spark, out, tool).select(F.lit("reject").alias("kind"), F.col("line").alias("value")))
            one = both.groupBy(F.lit(tool).alias("analysis"), "kind", "value").agg(F.count("*").alias("n"))
            told = one if told is None else told.unionByName(one)
        return told

    return run


for _group in fixtures.TOOL_GROUPS:
    QUERIES[f"ingest_{_group}"] = _ingest(_group)


@query
def augustus_records(spark, d):
    """What belongs to each id that the Augustus reader gives."""
    t = tx(spark, d)
    row = lambda kind, s, e: F.concat_ws("\t", "seq_region", F.lit("AUGUSTUS"), F.lit(kind), s.cast("string"), e.cast("string"), F.lit("."), "strand", F.lit("."), F.lit("x"))
    exons = F.array_join(F.transform("exons", lambda x: row("exon", x["start"], x["end"])), "\n")
    rows, _ = tools.read_augustus(spark, written(spark, t.select(F.concat_ws("\n", row("transcript", C("start"), C("end")), exons, F.lit("# end gene")).alias("line"))))
    exon = C("feature_type") == "exon"
    told = rows.groupBy("gene_id").agg(F.min("seq_region").alias("seq_region"), F.min("start").alias("start"), F.max("end").alias("end"), F.count_if(~exon).alias("n_transcripts"), F.count_if(exon).alias("n_exons"), F.max("exon_number").cast("bigint").alias("last_exon"))
    return told.drop("gene_id")


# Small operators on their own.


@query
def region_names(spark, d):
    c = named_contigs(spark, d).select(F.concat(F.lit(">"), F.when(C("name").cast("bigint") % 10 == 0, "MT").otherwise(C("name")), F.lit(" a note")).alias("name"))
    return slices.region_names(c)


@query
def merge_region_sets(spark, d):
    """Models, their cDNA and, for those that code, proteins under new ids; sequences are told by their old ids."""
    t = tx(spark, d)
    seqs = lambda df, kind: df.select("seq_region", "transcript_id", F.concat(F.lit(kind), C("transcript_id").cast("string")).alias("seq"))
    named, cdna, protein = slices.merge_region_sets(t, seqs(t, "c"), seqs(t.filter("cds_start is not null"), "p"), "sel")
    told = named.select(C("new_transcript_id").alias("transcript_id"), C("new_gene_id").alias("gene_id"), "start", "end")
    return slices.attach_sequences(told, cdna, protein)


@query
def all_exons_cds(spark, d):
    return models.all_exons_cds(tx(spark, d)).select("transcript_id", "cds_start", "cds_end")


@query
def single_transcript_genes(spark, d):
    return models.build_genes(models.single_transcript_genes(tx(spark, d)))


@query
def default_biotypes(spark, d):
    t = tx(spark, d)
    coords = models.format_translation_coords(models.translation_coords(C("exons"), C("strand"), C("cds_start"), C("cds_end")))
    rows = t.withColumns({"translation_coords": F.when(C("cds_start").isNotNull(), coords), "biotype": F.when(C("transcript_id") % 3 == 0, C("biotype"))})
    return models.default_biotype(rows).select("transcript_id", "biotype")


@query
def canonical_genes(spark, d):
    """The canonical model of each cluster of genes of one transcript."""
    named = clusters.cluster_by_coding_exon(models.single_transcript_genes(tx(spark, d)))
    return models.select_canonical_gene(named)


@query
def gene_order(spark, d):
    return models.gene_order(models.build_genes(tx(spark, d))).select("gene_id", "place")


@query
def collapse_lncrna(spark, d):
    return clusters.collapse_lncrna(tx(spark, d), max_per_cluster=1).select("transcript_id", "gene_id", "biotype")


# Composites; each is also built of operators that have their own query above.


def contig_stream(spark, d, size: int = 1000) -> DataFrame:
    """(k, seq): all contigs end to end in order of id, every base of them, in pieces of `size` from 0; what the last
    one lacks is N. Places come from lengths: dealt by range, summed in each range, offset by the ranges before."""
    c = save(fixtures.contigs(spark, d).filter(F.length("seq") > 0))  # dealing by range reads it twice
    dealt = save(c.repartitionByRange(partitions(spark), "doc_id").withColumn("p", F.spark_partition_id()))
    sizes = dealt.groupBy("p").agg(F.sum(F.length("seq")).alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.p") < F.col("a.p"), "left").groupBy("a.p").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    inside = F.sum(F.length("seq")).over(Window.partitionBy("p").orderBy("doc_id", "seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn("at", F.coalesce(inside, F.lit(0))).join(F.broadcast(before), "p").withColumn("at", F.col("at") + F.col("before"))  # a row for each range
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.length("seq") - 1) / size)
    cut = placed.select("at", "seq", F.explode(F.sequence(first, last)).alias("k"))
    start = F.greatest(F.col("k") * size, "at")
    piece = F.substring("seq", (start - F.col("at") + 1).cast("int"), (F.col("k") * size + size - start).cast("int"))
    whole = cut.select("k", F.struct(start.alias("start"), piece.alias("seq")).alias("x")).groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["seq"]), "").alias("seq"))
    return whole.select("k", F.rpad("seq", size, "N").alias("seq"))


def layout(spark, d, t: DataFrame) -> slices.Layout:
    """The genome that models t lie on: all contigs laid along the regions in pieces of 1,000 bases, one region after the
    other, from the start again where they end before the regions do. Where there are more bases than the exons need,
    regions are longer."""
    bases = save(contig_stream(spark, d))
    ends = save(t.groupBy("seq_region").agg(F.max("end").alias("n")))
    pieces = bases.count()
    regions, longest = ends.agg(F.count("*"), F.max("n")).first()
    each = max(longest // 1000 + 1, -(-pieces // regions)) if regions and pieces else 0
    return slices.Layout(bases, save(slices.numbered(ends, [F.col("seq_region")], "r").select("seq_region", "r")), each, pieces, 1000)


def genome(spark, d) -> DataFrame:
    """Regions as chunks of 1,000 bases, written out."""
    return layout(spark, d, fixtures.exon_rows(spark, d)).chunks()


def _digests(seqs: DataFrame) -> DataFrame:
    return seqs.select("transcript_id", F.length("seq").cast("bigint").alias("length"), F.md5(F.col("seq").cast("binary")).alias("digest"))


@query
def transcript_sequences(spark, d):
    t = save(tx(spark, d))
    return _digests(slices.transcript_sequences(layout(spark, d, t), t))


@query
def cds_sequences(spark, d):
    t = save(tx(spark, d))
    return _digests(slices.transcript_sequences(layout(spark, d, t), t, coding=True))


@query
def clean_transcripts(spark, d):
    """Models whose CDS, from their best translation, is valid at low bounds, and those with short introns merged."""
    t = save(tx(spark, d).drop("cds_start", "cds_end"))
    chunks = layout(spark, d, t)
    t = save(geneset.compute_translations(t, chunks, 10).drop("cds_seq").filter("cds_start is not null"))
    return models.clean_transcripts(t, geneset.cds_sequences(chunks), 30, 30).select("transcript_id", "merged", F.size("exons").cast("bigint").alias("n_exons"), F.length("cds_seq").cast("bigint").alias("cds_length"))


@query
def three_prime_trim_at_signal(spark, d):
    t = save(tx(spark, d))
    trimmed = save(models.trim_three_prime(wide_utr(t)))
    ends = save(geneset.with_last_exon(trimmed, layout(spark, d, t), "last"))
    return told_exons(models.trim_three_prime(ends, sequence="last").drop("last"))


@query
def select_best(spark, d):
    return geneset.select_best(tx(spark, d)).select("transcript_id", "class")


@query
def select_best_busco(spark, d):
    return geneset.select_best(tx(spark, d, "busco"), **geneset.MODES["busco"]).select("transcript_id", "class")


@query
def select_best_protein(spark, d):
    t = save(tx(spark, d))
    return geneset.select_best(t.filter("source = 'protein'"), layout(spark, d, t), **geneset.MODES["protein"]).select("transcript_id", "class")


@query
def select_best_transcriptomic(spark, d):
    t = save(tx(spark, d))
    return geneset.select_best(t.filter("source = 'transcriptomic'"), layout(spark, d, t), **geneset.MODES["transcriptomic"]).select("transcript_id", "class", "cds_start", "cds_end", "start", "end")


@query
def finalise_layers(spark, d):
    t = models.single_transcript_genes(tx(spark, d).filter("cds_start is not null"))
    return geneset.finalise_layers({s: t.filter(F.col("source") == s) for s in geneset.PRIORITY}).select("transcript_id", "source")


@query
def clean_geneset(spark, d):
    return geneset.clean_geneset(tx(spark, d)).select("gene_id", "transcript_id", "biotype", "start", "end")


@query
def clean_utrs_and_lncrna(spark, d):
    return geneset.clean_utrs_and_lncrna(tx(spark, d)).select("transcript_id", "biotype", "start", "end")


@query
def join_transcripts(spark, d):
    return joining.join_transcripts(tx(spark, d)).select("transcript_id", F.size("exons").cast("bigint").alias("n_exons"), "start", "end")


@query
def utr_orf_search(spark, d):
    """Models with a short CDS near their start, so that most of them is UTR."""
    t = save(tx(spark, d).withColumns({"cds_start": F.col("start"), "cds_end": F.col("start") + 60, "cds_seq": F.lit(None).cast("string")}))
    chunks = layout(spark, d, t)
    found = models.utr_orf_search(t, lambda df: geneset.compute_translations(df, chunks, 10), min_utr=200, multi=40, single=60)
    return found.select("transcript_id", "round", F.size("exons").cast("bigint").alias("n_exons"))


@query
def compute_translations(spark, d):
    t = save(tx(spark, d).drop("cds_start", "cds_end"))
    told = geneset.compute_translations(t, layout(spark, d, t), 20)
    return told.select("transcript_id", "cds_start", "cds_end", F.length("cds_seq").cast("bigint").alias("cds_length"))


def _finalised(modes):
    def run(spark, d):
        t = save(models.single_transcript_genes(tx(spark, d)))
        chunks = layout(spark, d, t)
        e = evidence.combine_evidence(fixtures.evidence(spark, d).select("transcript_id", "rnasamba_prob", "rnasamba_coding"), fixtures.evidence(spark, d).select("transcript_id", "cpc2_prob", "cpc2_coding", "peptide_length"), fixtures.diamond(spark, d))
        t, e = (x.withColumn("transcript_id", F.col("transcript_id").cast("string")) for x in (t, e))
        t = t.withColumn("gene_id", F.col("transcript_id"))
        final = geneset.finalise_geneset({s: t.filter(F.col("source") == s) for s in geneset.PRIORITY}, chunks, e, modes=modes)
        seqs = final["cdna"].select("transcript_id", F.md5(F.col("seq").cast("binary")).alias("cdna")).join(final["protein"].select("transcript_id", F.md5(F.col("seq").cast("binary")).alias("protein")), "transcript_id", "left")
        return final["transcripts"].select("gene_id", "transcript_id", "biotype", "start", "end").join(seqs, "transcript_id", "left")

    return run


QUERIES["finalise_geneset"] = _finalised({})
QUERIES["finalise_geneset_by_source"] = _finalised(None)
