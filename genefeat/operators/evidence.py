"""Hints, scores of models, and validation of coding potential."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import exon_string, introns
from ..functions.tables import save
from .clusters import cluster_by_coding_exon
from .filters import junction_filter
from .models import cds_exons, total



def exon_hints(exons: DataFrame) -> DataFrame:
    """Distinct exons with their support, in text order of region, strand, start, end."""
    out = exons.groupBy("seq_region", "strand", "start", "end").agg(F.count("*").alias("mul"))
    return out.orderBy(*(F.col(c).cast("string") for c in ("seq_region", "strand", "start", "end")))


def junction_hints(junctions: DataFrame, **options) -> DataFrame:
    return junction_filter(junctions, **options).select("seq_region", "strand", "start", "end", (F.col("uniq") + F.col("multi")).alias("mul"))


def cds_chain_counts(transcripts: DataFrame) -> DataFrame:
    """(seq_region, chain, n): how many models share a chain of coding exons."""
    told = transcripts.withColumn("chain", exon_string(cds_exons(), "strand"))
    return told.groupBy("seq_region", "chain").agg(F.count("*").alias("n"))


def model_stats(transcripts: DataFrame) -> DataFrame:
    """transcripts with n_exons, n_cds_exons, cds_length, mean_cds_exon, cds_ratio, span, longest_intron."""
    cds = cds_exons()
    n, length = F.size(cds), total(cds)
    return transcripts.withColumns({"n_exons": F.size("exons").cast("bigint"), "n_cds_exons": n.cast("bigint"), "cds_length": length, "mean_cds_exon": F.when(n > 0, length / n), "cds_ratio": n / F.size("exons"), "span": F.col("end") - F.col("start") + 1, "longest_intron": F.array_max(F.transform(introns("exons"), lambda x: x["end"] - x["start"] + 1))})


def score_models(transcripts: DataFrame, single: int = 450, other: int = 300, minimum: int = 1) -> DataFrame:
    """transcripts with score and is_good: a point for a single coding exon of `single` bases or a CDS of `other`."""
    told = model_stats(transcripts)
    point = ((F.col("n_cds_exons") == 1) & (F.col("cds_length") >= single)) | (F.col("cds_length") >= other)
    told = told.withColumn("score", F.when((F.col("n_cds_exons") > 0) & point, 1).otherwise(0).cast("bigint"))
    return told.withColumn("is_good", (F.col("n_cds_exons") > 0) & (F.col("score") >= minimum))


def sub_chains(chains: DataFrame, by_text: bool = True) -> DataFrame:
    """(cluster, chain): of distinct chains (array of introns), the ones that are part of another chain of their cluster.

    Every stretch of a chain that is as long as some chain of the cluster is a key: its number of introns, and a hash of
    all but the first intron's start, which is compared itself. So a chain meets the starts that lead into its own introns,
    however many chains have them, and no two chains are compared. by_text: the first start may also be the end of a
    longer number (100..5200 is part of 5100..5200), as where chains are compared as texts."""
    sizes = chains.filter(F.size("chain") > 0).groupBy("cluster").agg(F.collect_set(F.size("chain")).alias("sizes"))
    key = lambda part, n: [n.alias("n"), F.element_at(part, 1)["end"].alias("end"), F.xxhash64(F.slice(part, 2, F.greatest(n - 1, F.lit(0)))).alias("h"), F.element_at(part, 1)["start"].cast("string").alias("start")]
    each = chains.join(sizes, "cluster").select("cluster", "chain", F.explode(F.filter("sizes", lambda n: n <= F.size("chain"))).alias("n"))
    each = each.select("cluster", "chain", "n", F.explode(F.sequence(F.lit(1), F.size("chain") - F.col("n") + 1)).alias("p"))
    proper = (F.col("n") < F.size("chain")).alias("proper")
    index = each.select("cluster", *key(F.slice("chain", F.col("p"), F.col("n")), F.col("n")), proper)
    index = index.groupBy("cluster", "n", "end", "h", "start").agg(F.max("proper").alias("proper")).withColumnRenamed("start", "into")
    own = chains.filter(F.size("chain") > 0).select("cluster", "chain", *key(F.col("chain"), F.size("chain")))
    same = F.col("into") == F.col("start")
    part = (same & F.col("proper")) | (~same & F.col("into").endswith(F.col("start"))) if by_text else same & F.col("proper")
    return own.join(index, ["cluster", "n", "end", "h"]).filter(part).select("cluster", "chain").distinct()


def drop_sub_chains(transcripts: DataFrame, fraction: float = 0.75, empty_is_subchain: bool = False, by_text: bool = True) -> DataFrame:
    """transcripts (with cluster) and is_good: false where the coding introns are part of another chain of the cluster
    (see sub_chains()), or where both coding exons and CDS are under a fraction of the cluster's largest among the rest."""
    told = transcripts.withColumns({"__chain": introns(cds_exons()), "__n": F.size(cds_exons()), "__len": total(cds_exons())})
    chains = save(told.select("cluster", F.col("__chain").alias("chain")).distinct())
    sub = sub_chains(chains, by_text)
    if empty_is_subchain:
        several = chains.groupBy("cluster").count().filter("count > 1").select("cluster")
        sub = sub.unionByName(chains.filter(F.size("chain") == 0).join(several, "cluster", "left_semi"))
    sub = sub.withColumnRenamed("chain", "__chain").withColumn("__sub", F.lit(True))
    flagged = told.join(sub, ["cluster", "__chain"], "left").withColumn("__sub", F.coalesce("__sub", F.lit(False)))
    largest = flagged.filter("not __sub").groupBy("cluster").agg(F.max("__n").alias("__most"), F.max("__len").alias("__longest"))
    joined = flagged.join(largest, "cluster", "left")
    small = (F.col("__n") < fraction * F.col("__most")) & (F.col("__len") < fraction * F.col("__longest"))
    return joined.withColumn("is_good", ~F.col("__sub") & ~F.coalesce(small, F.lit(False))).select(*transcripts.columns, "is_good")


def final_classification(transcripts: DataFrame) -> DataFrame:
    """transcripts (is_good, ...) with class: good; of the others, ignore in a cluster with a good one, check elsewhere."""
    named = cluster_by_coding_exon(transcripts)
    best = named.groupBy("cluster").agg(F.max("is_good").alias("__any"))
    told = named.join(best, "cluster")
    return told.withColumn("class", F.when(F.col("is_good"), "good").when(F.col("__any"), "ignore").otherwise("check")).select(*transcripts.columns, "class")


def combine_evidence(rnasamba: DataFrame, cpc2: DataFrame, diamond: DataFrame, single_hit_only: bool = False) -> DataFrame:
    """By transcript_id: both coding calls, and the hits' smallest e-value and number. single_hit_only ignores the hits
    of a transcript with several."""
    hits = diamond.groupBy("transcript_id").agg(F.min("evalue").alias("evalue"), F.count("*").alias("n_hits"))
    hits = hits.filter("n_hits = 1") if single_hit_only else hits
    return rnasamba.join(cpc2, "transcript_id").join(hits, "transcript_id", "left")


def coding_call(mode: str | None = None) -> Column:
    """protein_coding, lncRNA, or null for a model to drop, from columns source, single_cds_exon, rnasamba_coding,
    rnasamba_prob, cpc2_coding, cpc2_prob, peptide_length, evalue, transcript_length. mode: None, relaxed or moderate."""
    a, b, p = F.col("rnasamba_coding"), F.col("cpc2_coding"), F.col("peptide_length")
    top, mean = F.greatest("rnasamba_prob", "cpc2_prob"), (F.col("rnasamba_prob") + F.col("cpc2_prob")) / 2
    hit, single = F.col("evalue").isNotNull(), F.col("single_cds_exon")
    general = hit | (a & b & (p >= 75)) | ((a | b) & (p >= 75) & (top >= 0.8))
    relaxed = hit | (a & b & (p >= 100)) | ((a | b) & (p >= 100) & (top >= 0.8))
    moderate = (hit & (p >= 100)) | (a & b & (p >= 100) & (mean >= 0.9))
    out = F.when(F.col("source").isin("busco", "protein"), "protein_coding")
    if mode in ("relaxed", "moderate"):
        out = out.when(single, F.when(relaxed if mode == "relaxed" else moderate, "protein_coding"))
    elif mode is not None:
        raise ValueError(f"unknown mode {mode}")
    return out.when(general, "protein_coding").when(F.col("transcript_length") >= 200, "lncRNA")


def validate_coding(transcripts: DataFrame, evidence: DataFrame, mode: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(validated, rejects): transcripts with their biotype, those called lncRNA without CDS; rejects have no evidence.
    What the rules drop is in neither."""
    told = transcripts.join(evidence.withColumn("__known", F.lit(True)), "transcript_id", "left")
    told = told.withColumns({"single_cds_exon": F.size(cds_exons()) == 1, "transcript_length": total(F.col("exons"))})
    safe = F.col("source").isin("busco", "protein")
    called = told.filter(F.col("__known") | safe).withColumn("biotype", coding_call(mode)).filter("biotype is not null")
    lnc = F.col("biotype") == "lncRNA"
    called = called.withColumns({c: F.when(~lnc, F.col(c)) for c in ("cds_start", "cds_end")})
    columns = list(dict.fromkeys([*transcripts.columns, "biotype"]))
    return called.select(columns), told.filter(F.col("__known").isNull() & ~safe).select(transcripts.columns)


def proteins(transcripts: DataFrame, cds: DataFrame) -> DataFrame:
    """(transcript_id, seq): translations of coding sequences, the final stop left out."""
    from ..functions.sequence import amino_acids

    return cds.join(transcripts.select("transcript_id"), "transcript_id", "left_semi").filter(F.length("seq") >= 3).select("transcript_id", F.regexp_replace(amino_acids("seq"), r"\*$", "").alias("seq"))
