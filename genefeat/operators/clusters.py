"""Clusters of transcripts, and what is decided within them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import intron_string
from ..functions.tables import save
from .graph import connected_components
from .intervals import cluster_by_span, overlap_length, overlap_pairs, overlaps
from .models import build_transcripts, canonical_transcripts, cds_exons, total


def coding_exons(transcripts: DataFrame, *carry: str) -> DataFrame:
    """A row for each exon's coding part."""
    told = transcripts.select("transcript_id", *carry, "seq_region", "strand", F.explode(cds_exons()).alias("e"))
    return told.select("transcript_id", *carry, "seq_region", "strand", F.col("e.start").alias("start"), F.col("e.end").alias("end"))


def _piece_labels(table: pa.Table) -> pa.Table:
    """A piece's edges (transcript_id, island) to (transcript_id, label): each transcript with the smallest one that shared
    islands connect it with."""
    ids, islands = table.column("transcript_id").combine_chunks().dictionary_encode(), table.column("island").combine_chunks().dictionary_encode()
    names = ids.dictionary
    rank = np.empty(len(names), np.int64)
    order = pc.sort_indices(names).to_numpy()
    rank[order] = np.arange(len(names))
    low = rank[ids.indices.to_numpy()]
    n = len(names)
    parent = list(range(n + len(islands.dictionary)))  # transcripts by rank, then islands

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(low.tolist(), (n + islands.indices.to_numpy()).tolist(), strict=True):
        a, b = top(x), top(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return pa.table({"transcript_id": names.take(pa.array(order)), "label": names.take(pa.array(order[[top(x) for x in range(n)]]))})


def island_labels(edges: DataFrame, most_edges: int = 4_000_000) -> DataFrame:
    """(transcript_id, label) of edges (transcript_id, seq_region, strand, piece, island): for each transcript the smallest
    one that it is connected with by islands.

    A piece of a region is solved in one task; one with more than most_edges edges is not, and its islands stand as they
    are, each with its smallest transcript. What connects pieces, or islands of these, is transcripts with several labels:
    only those go into rounds."""
    piece = ["seq_region", "strand", "piece"]
    edges = save(edges)
    large = F.broadcast(save(edges.groupBy(*piece).count().filter(F.col("count") > most_edges).select(*piece)))  # under 1/most_edges of the edges
    kind = edges.schema["transcript_id"].dataType.simpleString()
    small = edges.join(large, piece, "left_anti").groupBy(*piece).applyInArrow(_piece_labels, f"transcript_id {kind}, label {kind}")
    rest = edges.join(large, piece, "left_semi")
    hubs = rest.groupBy(*piece, "island").agg(F.min("transcript_id").alias("label"))
    found = save(small.unionByName(rest.join(hubs, [*piece, "island"]).select("transcript_id", "label")))
    own = found.groupBy("transcript_id").agg(F.min("label").alias("m"), F.max("label").alias("x"))
    crossing = own.filter("m <> x").select("transcript_id", "m")
    links = save(found.join(crossing, "transcript_id").filter("label <> m").select("label", "m").distinct())
    if links.isEmpty():
        return own.select("transcript_id", F.col("m").alias("label"))
    joined = connected_components(links, "label", "m").withColumnsRenamed({"node": "m", "label": "whole"})
    return own.join(joined, "m", "left").select("transcript_id", F.coalesce("whole", "m").alias("label"))


def cluster_by_coding_exon(transcripts: DataFrame, piece: int = 1_000_000, most_edges: int = 4_000_000) -> DataFrame:
    """transcripts with cluster (its smallest transcript_id) and cluster_size: connected by overlap of coding exons on one
    strand. Exon islands and their transcripts are the graph, so no pair of a deep island is written out. A transcript
    without coding exons is a cluster of its own."""
    islands = cluster_by_span(coding_exons(transcripts))
    edges = islands.select("transcript_id", "seq_region", "strand", F.floor(F.col("cluster_start") / piece).alias("piece"), F.col("cluster_start").alias("island")).distinct()
    labels = island_labels(edges, most_edges)
    named = transcripts.join(labels, "transcript_id", "left").withColumn("cluster", F.coalesce("label", "transcript_id")).drop("label")
    return named.join(named.groupBy("cluster").agg(F.count("*").alias("cluster_size")), "cluster")


def coding_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, overlap): bases in which the coding exons of two transcripts overlap."""
    pairs = overlap_pairs(coding_exons(left), coding_exons(right))
    length = overlap_length(F.col("l.start"), F.col("l.end"), F.col("r.start"), F.col("r.end"))
    return pairs.groupBy(F.col("l.transcript_id").alias("left_id"), F.col("r.transcript_id").alias("right_id")).agg(F.sum(length).alias("overlap"))


def collapse_transcripts(transcripts: DataFrame, coding_only: bool = True, max_per_cluster: int = 100, max_exon: int = 50_000) -> DataFrame:
    """Transcripts with an exon over max_exon go; of those of a cluster with the same introns the widest stays; then the
    max_per_cluster with the longest CDS. gene_id is the cluster. (Internal limits on short introns don't arise here.)"""
    short = transcripts.filter(~F.exists("exons", lambda x: x["end"] - x["start"] + 1 > max_exon))
    if coding_only:
        named = cluster_by_coding_exon(short)
    else:
        named = cluster_by_span(short).withColumn("cluster", F.concat_ws(":", "seq_region", "strand", F.col("cluster_start").cast("string"))).drop("cluster_start")
    chain = F.when(F.size("exons") > 1, intron_string("exons")).otherwise(F.concat_ws(":", "start", "end"))
    named = named.withColumns({"__chain": chain, "__cds": total(cds_exons())})
    same = Window.partitionBy("cluster", "__chain").orderBy(F.desc(F.col("end") - F.col("start")), "transcript_id")
    top = Window.partitionBy("cluster").orderBy(F.desc("__cds"), "transcript_id")
    kept = named.withColumn("__n", F.row_number().over(same)).filter("__n = 1").withColumn("__n", F.row_number().over(top)).filter(F.col("__n") <= max_per_cluster)
    return kept.withColumn("gene_id", F.col("cluster").cast(transcripts.schema["gene_id"].dataType)).select(transcripts.columns)


def collapse_lncrna(transcripts: DataFrame, **options) -> DataFrame:
    """The lncRNA collapsed by span, the others as they are."""
    lnc = F.col("biotype") == "lncRNA"
    return transcripts.filter(~F.coalesce(lnc, F.lit(False))).unionByName(collapse_transcripts(transcripts.filter(lnc), coding_only=False, **options))


def skipped_exons(transcripts: DataFrame) -> DataFrame:
    """(gene_id, transcript_id, rank, n_skipped) for each intron: distinct coding exons of the gene that it overlaps."""
    from .models import derive_introns

    exons = coding_exons(transcripts, "gene_id").select("gene_id", F.col("start").alias("s"), F.col("end").alias("e")).distinct()
    gaps = derive_introns(transcripts, "gene_id")
    hit = overlaps(F.col("start"), F.col("end"), F.col("s"), F.col("e"))
    return gaps.join(exons, "gene_id", "left").groupBy("gene_id", "transcript_id", "rank").agg(F.count_if(hit).alias("n_skipped"))


def remove_readthroughs(transcripts: DataFrame, max_skip: int = 3) -> DataFrame:
    """Transcripts of coding genes with an intron over more than max_skip of the gene's coding exons go, but for the
    canonical one where none would be left. Others stay."""
    coding = F.coalesce(F.col("gene_biotype") == "protein_coding", F.lit(False))
    codes, rest = transcripts.filter(coding), transcripts.filter(~coding)
    bad = skipped_exons(codes).filter(F.col("n_skipped") > max_skip).select("transcript_id").distinct()
    left = codes.join(bad, "transcript_id", "left_anti")
    none = codes.join(left.select("gene_id").distinct(), "gene_id", "left_anti")
    canonical = none.join(canonical_transcripts(none).select(F.col("canonical_transcript").alias("transcript_id")), "transcript_id", "left_semi")
    return left.unionByName(canonical.select(left.columns)).unionByName(rest.select(left.columns))


def cds_extents(transcripts: DataFrame) -> DataFrame:
    """(gene_id, cds_low, cds_high) of genes with a CDS."""
    return transcripts.filter("cds_start is not null").groupBy("gene_id").agg(F.min("seq_region").alias("seq_region"), F.min("strand").alias("strand"), F.min("cds_start").alias("cds_low"), F.max("cds_end").alias("cds_high"))


def trim_utr_over_neighbour_cds(transcripts: DataFrame) -> DataFrame:
    """Of coding genes, exons without coding bases that overlap the CDS extent of another gene on the strand go."""
    from .models import numbered_exons

    exons = numbered_exons(transcripts)
    utr = F.col("cds_start").isNotNull() & ((F.col("end") < F.col("cds_start")) | (F.col("start") > F.col("cds_end")))
    extents = cds_extents(transcripts).select("gene_id", "seq_region", "strand", F.col("cds_low").alias("start"), F.col("cds_high").alias("end"))
    hit = overlap_pairs(exons.filter(utr).select("transcript_id", "gene_id", "rank", "seq_region", "strand", "start", "end"), extents).filter("l.gene_id <> r.gene_id")
    left = exons.join(hit.select("l.transcript_id", "l.rank").distinct(), ["transcript_id", "rank"], "left_anti")
    rebuilt = build_transcripts(left)
    return transcripts.drop("exons", "start", "end", "seq_region", "strand").join(rebuilt, "transcript_id").select(transcripts.columns)
