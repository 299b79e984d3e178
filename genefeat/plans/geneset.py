"""Gene-set stages: pipelines over the operators, each a plan of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import best_translation
from ..functions.tables import save
from ..operators.clusters import cluster_by_coding_exon, coding_exons, coding_overlap, collapse_lncrna, collapse_transcripts, remove_readthroughs, trim_utr_over_neighbour_cds
from ..operators.evidence import drop_sub_chains, final_classification, proteins, score_models, validate_coding
from ..operators.intervals import drop_lncrna_overlapping_coding, overlap_pairs
from ..operators.joining import join_transcripts
from ..operators.models import all_exons_cds, canonical_transcripts, cds_exons, clean_transcripts, drop_overlapping_exons, gene_biotypes, genomic_position, single_transcript_genes, total, trim_five_prime, trim_three_prime, utr_orf_search
from ..operators.slices import Layout, get_sequence, merge_region_sets, renumber_gene_ids, transcript_sequences

PRIORITY = ("transcriptomic", "busco", "protein")


def compute_translations(transcripts: DataFrame, chunks: DataFrame | Layout, min_aa: int = 50) -> DataFrame:
    """transcripts with cds_start, cds_end and cds_seq from their best translation; null where there is none."""
    best = transcript_sequences(chunks, transcripts).select("transcript_id", "seq", best_translation("seq", min_aa, protein=False).alias("t"))
    best = best.select("transcript_id", F.col("t.start").cast("bigint").alias("__first"), F.col("t.end").cast("bigint").alias("__last"), F.when(F.col("t").isNotNull(), F.expr("substring(seq, t.start, t.end - t.start + 1)")).alias("cds_seq"))
    both = transcripts.drop("cds_start", "cds_end", "cds_seq").join(best, "transcript_id", "left")
    a, z = (genomic_position(F.col(c), F.col("exons"), F.col("strand")) for c in ("__first", "__last"))
    return both.withColumns({"__a": a, "__z": z}).select(*transcripts.drop("cds_start", "cds_end", "cds_seq").columns, F.least("__a", "__z").alias("cds_start"), F.greatest("__a", "__z").alias("cds_end"), "cds_seq")


def cds_sequences(chunks: DataFrame | Layout) -> Callable[[DataFrame], DataFrame]:
    def attach(df: DataFrame) -> DataFrame:
        return df.join(transcript_sequences(chunks, df, coding=True).withColumnRenamed("seq", "cds_seq"), "transcript_id")

    return attach


def with_last_exon(transcripts: DataFrame, chunks: DataFrame | Layout, name: str) -> DataFrame:
    """transcripts with a column of the sequence of their last exon, in transcript direction; null where the genome has
    none of it."""
    minus = F.col("strand") == "-"
    last = F.when(minus, F.col("exons")[0]).otherwise(F.element_at("exons", -1))
    wanted = transcripts.select(F.col("transcript_id").alias("__id"), "seq_region", "strand", last["start"].alias("start"), last["end"].alias("end"))
    seqs = get_sequence(chunks, wanted, key="__id").select("__id", F.col("seq").alias(name))
    return transcripts.join(seqs, F.col("transcript_id") == F.col("__id"), "left").drop("__id")


def trim_utrs(transcripts: DataFrame, chunks: DataFrame | Layout | None = None) -> DataFrame:
    """3' UTR trimmed, with the genome's chunks also to its polyadenylation site (trimming again changes nothing else),
    then 5' UTR."""
    t = trim_three_prime(transcripts)
    if chunks is not None:
        t = trim_three_prime(save(with_last_exon(save(t), chunks, "__last")), sequence="__last").drop("__last")
    return trim_five_prime(save(t))


#: How models of each source are selected: transcriptomic ones are translated and searched for ORFs in their UTRs, BUSCO
#: and protein ones code from end to end, and protein ones are cleaned before.
MODES = {"transcriptomic": {"cds": "best", "search_utr": True}, "busco": {"cds": "all_exons"}, "protein": {"cds": "all_exons", "clean": True}}


def select_best(transcripts: DataFrame, chunks: DataFrame | Layout | None = None, join: bool = False, cds: str = "keep", clean: bool = False, search_utr: bool = False, collapse: bool = True) -> DataFrame:
    """Transcripts of a source that make models: no overlapping exons, optionally joined; with their CDS kept, the whole
    transcript as CDS (all_exons) or their best translation (best); optionally cleaned, and searched in their UTRs and
    trimmed; scored, freed of sub-chains, classified; the good ones collapsed. Others carry class ignore or check.
    What needs sequences takes the genome's chunks."""
    if cds not in ("keep", "all_exons", "best"):
        raise ValueError(f"unknown cds mode {cds}")
    if chunks is None and (cds == "best" or clean or search_utr):
        raise ValueError("translating, cleaning and searching need the genome's chunks")
    t = drop_overlapping_exons(transcripts)
    if join:
        t = t.withColumn("transcript_id", F.col("transcript_id").cast("string"))
        made = join_transcripts(t)
        t = t.unionByName(made.select(t.columns))
    if cds == "all_exons":
        t = all_exons_cds(t)
    elif cds == "best":
        t = save(compute_translations(t, chunks).drop("cds_seq"))
    if clean:
        t = t.withColumn("transcript_id", F.col("transcript_id").cast("string"))
        t = save(clean_transcripts(t, cds_sequences(chunks)).withColumn("transcript_id", F.when(F.col("merged"), F.concat("transcript_id", F.lit("_m"))).otherwise(F.col("transcript_id"))).drop("cds_seq", "merged"))
    if search_utr:
        t = utr_orf_search(t.withColumn("cds_seq", F.lit(None).cast("string")), lambda df: compute_translations(df, chunks)).drop("cds_seq", "round")
        t = t.withColumn("transcript_id", F.col("transcript_id").cast("string"))  # also where no UTR gave a model
        t = save(trim_utrs(t, chunks))
    columns = t.columns
    scored = save(score_models(single_transcript_genes(t)).select(*columns, "is_good"))
    good = cluster_by_coding_exon(scored.filter("is_good").drop("is_good"))
    single = good.filter("cluster_size = 1").select(*columns, F.lit(True).alias("is_good"))
    several = drop_sub_chains(good.filter("cluster_size > 1").drop("cluster_size")).select(*columns, "is_good")
    told = single.unionByName(several).unionByName(scored.filter("not is_good").select(*columns, "is_good"))
    classed = save(final_classification(told).drop("is_good"))
    best = classed.filter("class = 'good'").drop("class")
    best = collapse_transcripts(best) if collapse else best
    return best.withColumn("class", F.lit("good")).unionByName(classed.filter("class <> 'good'"))


def augment_from(upper: DataFrame, lower: DataFrame, max_coverage: float) -> DataFrame:
    """Rows of lower (source as upper's) to add to upper: for clusters of both that overlap, the lower one's canonical
    model, if the upper's canonical model has no CDS, doesn't meet the cluster, or covers at most max_coverage of its CDS.
    Gene models of one transcript each."""

    def clusters(df):
        named = save(cluster_by_coding_exon(df))
        spans = named.groupBy("cluster").agg(F.min("seq_region").alias("seq_region"), F.min("strand").alias("strand"), F.min("start").alias("start"), F.max("end").alias("end"))
        return named, spans.join(canonical_transcripts(named, "cluster"), "cluster")

    _, up = clusters(upper)
    low_named, low = clusters(lower)
    pairs = overlap_pairs(up, low).select(F.col("l.canonical_transcript").alias("u"), F.col("r.canonical_transcript").alias("c"), F.col("r.cluster").alias("cluster"))
    heads = upper.join(up.select(F.col("canonical_transcript").alias("transcript_id")), "transcript_id", "left_semi")
    met = coding_overlap(heads, low_named).join(low_named.select(F.col("transcript_id").alias("right_id"), "cluster"), "right_id").select(F.col("left_id").alias("u"), "cluster").distinct().withColumn("met", F.lit(True))
    shared = coding_overlap(heads, lower).select(F.col("left_id").alias("u"), F.col("right_id").alias("c"), "overlap")
    lengths = lower.select(F.col("transcript_id").alias("c"), total(cds_exons()).alias("length"))
    told = pairs.join(met, ["u", "cluster"], "left").join(shared, ["u", "c"], "left").join(lengths, "c")
    add = F.col("met").isNull() | (F.coalesce("overlap", F.lit(0)) <= F.lit(max_coverage) * F.col("length"))
    return lower.join(told.filter(add).select(F.col("c").alias("transcript_id")).distinct(), "transcript_id", "left_semi")


def layer_sets(transcripts: DataFrame, priority: tuple[str, ...] = PRIORITY) -> DataFrame:
    """Of each cluster the models of the source that comes first in the priority; a model alone always stays."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("source"))
    named = save(cluster_by_coding_exon(transcripts).withColumn("__rank", F.when(rank > 0, rank).otherwise(len(priority) + 1)))
    best = named.groupBy("cluster").agg(F.min("__rank").alias("__best"))
    return named.join(best, "cluster").filter("__rank = __best").select(transcripts.columns)


def finalise_layers(sets: dict[str, DataFrame]) -> DataFrame:
    """The sources' models with each upper set augmented by the lower ones, then layered and collapsed."""
    tr, bu, pr = (sets[s] for s in PRIORITY)
    from_busco = augment_from(tr, bu, 0.9).withColumn("source", F.lit("transcriptomic"))
    from_protein = augment_from(tr, pr, 0.8).withColumn("source", F.lit("transcriptomic"))
    to_busco = augment_from(bu, pr, 0.8).withColumn("source", F.lit("busco"))
    parts = [tr, bu, pr, *(x.withColumn("transcript_id", F.concat_ws("_", F.col("transcript_id").cast("string"), F.lit(s))) for x, s in ((from_busco, "b"), (from_protein, "p"), (to_busco, "q")))]
    out = None
    for p in parts:
        p = p.withColumn("transcript_id", F.col("transcript_id").cast("string"))
        out = p if out is None else out.unionByName(p)
    return collapse_transcripts(layer_sets(save(out)))


def clean_geneset(transcripts: DataFrame) -> DataFrame:
    """Collapsed, numbered, with biotypes, without lncRNA on coding genes of their strand, lncRNA collapsed by span,
    without read-throughs."""
    coding = F.col("cds_start").isNotNull()
    t = collapse_transcripts(transcripts.filter(coding)).unionByName(collapse_transcripts(transcripts.filter(~coding), coding_only=False).select(transcripts.columns))
    named = renumber_gene_ids(save(t)).drop("gene_id", "transcript_id").withColumnsRenamed({"new_gene_id": "gene_id", "new_transcript_id": "transcript_id"})
    typed = save(gene_biotypes(named))
    kept = collapse_lncrna(drop_lncrna_overlapping_coding(typed, stranded=True))
    return remove_readthroughs(save(kept))


def clean_utrs_and_lncrna(transcripts: DataFrame) -> DataFrame:
    """Coding models without UTR exons on a neighbour's CDS and with trimmed UTRs, in place of the original ones; then
    lncRNA on coding models of any strand go."""
    coding = F.coalesce(F.col("biotype") == "protein_coding", F.lit(False))
    cleaned = trim_utrs(trim_utr_over_neighbour_cds(transcripts.filter(coding)))
    return drop_lncrna_overlapping_coding(save(cleaned.unionByName(transcripts.filter(~coding))), stranded=False)


def finalise_geneset(sources: dict[str, DataFrame], chunks: DataFrame | Layout, evidence: DataFrame, mode: str | None = None, modes: dict[str, dict] | None = None, label: str = "final") -> dict[str, DataFrame]:
    """From models by source to the final set: transcripts under ids label_N, cdna, protein, rejects. Between stages ids
    are made unique to the source."""
    modes = MODES if modes is None else modes
    best = {}
    for s, df in sources.items():
        good = select_best(df, chunks, **modes.get(s, {})).filter("class = 'good'").drop("class")
        best[s] = save(good.withColumn("transcript_id", F.concat_ws(":", F.lit(s), F.col("transcript_id").cast("string"))))
    layered = save(finalise_layers(best))
    own = layered.withColumn("__own", F.regexp_replace(F.regexp_replace("transcript_id", r"^[^:]*:", ""), r"(_[bpq]|_m|_utr[53])+$", ""))
    known = own.select("transcript_id", "__own").join(evidence.withColumnRenamed("transcript_id", "__own"), "__own").drop("__own")
    validated, rejects = validate_coding(layered, known, mode)
    final = save(clean_utrs_and_lncrna(clean_geneset(save(validated))))
    by_region = lambda seqs: seqs.join(final.select("transcript_id", "seq_region"), "transcript_id")
    cdna = by_region(transcript_sequences(chunks, final))
    protein = by_region(proteins(final, transcript_sequences(chunks, final.filter("cds_start is not null"), coding=True)))
    named, cdna, protein = merge_region_sets(final, save(cdna), save(protein), label)
    named = named.drop("gene_id", "transcript_id").withColumnsRenamed({"new_gene_id": "gene_id", "new_transcript_id": "transcript_id"})
    return {"transcripts": named, "cdna": cdna, "protein": protein, "rejects": rejects}


__all__ = ["augment_from", "clean_geneset", "clean_utrs_and_lncrna", "coding_exons", "compute_translations", "finalise_geneset", "finalise_layers", "layer_sets", "select_best"]
