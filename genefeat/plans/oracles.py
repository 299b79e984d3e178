"""SQL that gives the same rows as the registered queries, for DuckDB."""

from __future__ import annotations

from ..operators.filters import REPEAT_TYPES
from . import fixtures
from .fixtures import DIAMOND, EVIDENCE, duck
from .queries import RFAM_NAMES, RFAM_TYPES
from .stages_sql import Stages, stage

ORACLES: dict[str, str] = {}


def put(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = duck(body, *ctes)


# Each transcript's bases of coding exons, in a CTE that others follow.
CDSLEN = "cl AS (SELECT transcript_id, sum(e - s + 1) AS cds_len, count(*) AS n_cds FROM cds GROUP BY 1)"
RANKED = "rk AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END) AS rank FROM tx_exons)"
INTRONS = "it AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY s) AS rank, e + 1 AS a, lead(s) OVER (PARTITION BY transcript_id ORDER BY s) - 1 AS b FROM tx_exons)"


def more(ctes: tuple[str, ...], *extra: str) -> str:
    """WITH clause of known CTEs, then extra ones."""
    head = duck("", *ctes).strip()
    return head + "".join(f", {x}" for x in extra) + " "


A = ("tx_exons", "tx", "cds")
BEST = "bst AS (SELECT t.*, row_number() OVER (PARTITION BY gene_id ORDER BY (cs IS NULL), -coalesce(cds_len // 3, 0), -len, t.transcript_id) AS k FROM tx t LEFT JOIN cl ON t.transcript_id = cl.transcript_id)"

ORACLES["canonical_transcripts"] = more(A, CDSLEN, BEST) + "SELECT gene_id, transcript_id AS canonical_transcript, n_exons, n_exons - 1 AS n_introns, e - s + 1 AS span FROM bst WHERE k = 1"
put("gene_models", "SELECT gene_id, min(seq_region) AS seq_region, min(strand) AS strand, min(s) AS start, max(e) AS \"end\", count(*) AS n_transcripts FROM tx GROUP BY 1", "tx_exons", "tx")
ORACLES["intron_lengths"] = more(("tx_exons",), INTRONS) + "SELECT transcript_id, rank, a AS start, b AS \"end\", b - a + 1 AS length FROM it WHERE b IS NOT NULL"
ORACLES["short_intron_merge"] = more(("tx_exons",), "m AS (SELECT *, max(e) OVER (PARTITION BY transcript_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM tx_exons)", "g AS (SELECT *, sum(CASE WHEN p IS NULL OR s - p - 1 >= 75 THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id ORDER BY s, e) AS blk FROM m)", "b AS (SELECT transcript_id, blk, max(e) - min(s) + 1 AS n FROM g GROUP BY 1, 2)") + "SELECT transcript_id, count(*) AS n_exons, sum(n) AS length FROM b GROUP BY 1"
ORACLES["overlapping_exon_filter"] = more(("tx_exons",), INTRONS) + "SELECT transcript_id, count(*) AS n_exons FROM it GROUP BY 1 HAVING count_if(coalesce(b + 1 < a, false)) = 0"
ORACLES["model_integrity"] = """WITH x AS (SELECT l_orderkey AS transcript_id, concat('r', l_suppkey % 3) AS seq_region, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand,
  1 + (l_orderkey * 7919) % 1000000 + l_linenumber * 400 + l_partkey % 200 AS s, CAST(l_quantity AS BIGINT) * 4 - 60 AS q FROM lineitem),
  g AS (SELECT transcript_id, min(strand) <> max(strand) AS ms, min(seq_region) <> max(seq_region) AS mr, bool_or(s > s + q) AS bad, min(s) >= max(s + q) AS em FROM x GROUP BY 1)
  SELECT transcript_id, 'mixed_strand' AS violation FROM g WHERE ms UNION ALL SELECT transcript_id, 'mixed_region' FROM g WHERE mr UNION ALL SELECT transcript_id, 'exon_start_after_end' FROM g WHERE bad UNION ALL SELECT transcript_id, 'empty_span' FROM g WHERE em"""
put("attach_cds", "SELECT t.transcript_id, min(c.s) AS cds_start, max(c.e) AS cds_end FROM tx t LEFT JOIN cds c ON t.transcript_id = c.transcript_id GROUP BY 1", *A)
ORACLES["translation_coords"] = more(A, "f AS (SELECT x.*, cs, ce, row_number() OVER (PARTITION BY x.transcript_id ORDER BY x.s) AS lo, row_number() OVER (PARTITION BY x.transcript_id ORDER BY x.s DESC) AS hi FROM tx_exons x JOIN tx t ON x.transcript_id = t.transcript_id WHERE x.s <= ce AND x.e >= cs)", "p AS (SELECT a.transcript_id, a.strand, a.s AS s1, a.e AS e1, b.s AS s2, b.e AS e2, a.cs, a.ce FROM f a JOIN f b ON a.transcript_id = b.transcript_id AND a.lo = 1 AND b.hi = 1)") + "SELECT transcript_id, CASE WHEN strand = '-' THEN concat_ws(':', s2, e2, e2 - least(ce, e2) + 1, s1, e1, e1 - greatest(cs, s1) + 1) ELSE concat_ws(':', s1, e1, greatest(cs, s1) - s1 + 1, s2, e2, least(ce, e2) - s2 + 1) END AS coords, true AS parses FROM p"
put("gene_biotypes", "SELECT gene_id, transcript_id, CASE WHEN cs IS NULL THEN 'lncRNA' ELSE 'protein_coding' END AS biotype, CASE WHEN bool_or(cs IS NOT NULL) OVER (PARTITION BY gene_id) THEN 'protein_coding' ELSE 'lncRNA' END AS gene_biotype FROM tx", "tx_exons", "tx")
ORACLES["override_biotypes"] = more(A, CDSLEN, BEST) + "SELECT a.gene_id, a.transcript_id, CASE WHEN a.cs IS NULL THEN 'noncoding' ELSE 'coding' END AS biotype, CASE WHEN b.cs IS NULL THEN 'noncoding' ELSE 'coding' END AS gene_biotype FROM bst a JOIN bst b ON a.gene_id = b.gene_id AND b.k = 1"

NAMED = "r AS (SELECT CAST(doc_id AS VARCHAR) AS seq_region, length(seq) AS length FROM contigs)"
ORACLES["region_lengths"] = more(("contigs",), NAMED) + "SELECT * FROM r WHERE length > 1000"
ORACLES["genome_size"] = more(("contigs",), NAMED) + "SELECT CAST(sum(length) AS BIGINT) AS genome_size FROM r"


def cut(size: int, step: int) -> str:
    return f"k AS (SELECT seq_region, length, unnest(range(CASE WHEN length <= {size} THEN 1 ELSE 1 + CAST(ceil((length - {size}) / {step}.0) AS BIGINT) END)) AS k FROM r WHERE length >= 1000), sl AS (SELECT seq_region, k * {step} + 1 AS start, least(k * {step} + {size}, length) AS \"end\", k FROM k)"


ORACLES["make_slices"] = more(("contigs",), NAMED, cut(5000, 4500)) + 'SELECT seq_region, start, "end" FROM sl WHERE "end" - start + 1 >= 1000'
ORACLES["split_by_length"] = more(("contigs",), NAMED, cut(5000, 5000)) + 'SELECT concat(seq_region, \'_sli\', k + 1) AS name, seq_region, start, "end" FROM sl WHERE "end" - start + 1 >= 1000'
put("slice_rebase", 'SELECT seq_region, transcript_id, s AS start, e AS "end" FROM tx_exons WHERE transcript_id % 5 <> 0', "tx_exons")
ORACLES["genome_to_slice"] = more(("tx_exons",), "r AS (SELECT seq_region, max(e) AS length FROM tx_exons GROUP BY 1)", cut(100_000, 90_000)) + 'SELECT x.seq_region, x.transcript_id, sl.start AS slice_start, sl."end" AS slice_end, x.s - sl.start + 1 AS start, x.e - sl.start + 1 AS "end" FROM tx_exons x JOIN sl ON x.seq_region = sl.seq_region AND x.s >= sl.start AND x.e <= sl."end" WHERE sl."end" - sl.start + 1 >= 1000'
ORACLES["renumber_ids"] = more(("tx_exons", "tx"), "g AS (SELECT seq_region, gene_id, row_number() OVER (ORDER BY seq_region, min(s), max(e), gene_id) AS g FROM tx GROUP BY 1, 2)", "t AS (SELECT *, row_number() OVER (PARTITION BY seq_region, gene_id ORDER BY s, e, transcript_id) AS k FROM tx)") + "SELECT t.transcript_id, concat('gene', g) AS new_gene_id, concat('gene', g, '.t', k) AS new_transcript_id FROM t JOIN g ON t.seq_region = g.seq_region AND t.gene_id = g.gene_id"
put("renumber_features", "SELECT seq_region, s AS start, e AS \"end\", transcript_id, concat('repeat', row_number() OVER (ORDER BY seq_region, s, e, transcript_id)) AS feature_id FROM tx_exons", "tx_exons")
put("batch_records", "SELECT transcript_id, (dense_rank() OVER (ORDER BY gene_id) - 1) // 20 AS batch FROM tx", "tx_exons", "tx")
ORACLES["batch_sequences"] = "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS batch FROM documents"
put("count_features", "SELECT source, count(*) AS n FROM tx_exons WHERE s % 3 <> 0 GROUP BY 1", "tx_exons")
put("min_rows", "SELECT count(*) AS n, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) <= 100000 THEN 'too_few' ELSE 'ok' END AS status FROM tx_exons", "tx_exons")
put("get_sequence", "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 2 = 0 THEN q ELSE reverse(translate(q, 'ACGT', 'TGCA')) END AS seq FROM (SELECT doc_id, substr(seq, doc_id % 150 + 1, 210) AS q FROM contigs WHERE length(seq) >= 400)", "contigs")
ORACLES["sequence_to_genomic"] = more(("tx_exons",), RANKED, "c AS (SELECT *, sum(e - s + 1) OVER (PARTITION BY transcript_id ORDER BY rank) AS z FROM rk)", "q AS (SELECT unnest([1, 50, 150]) AS p)") + "SELECT transcript_id, CAST(p AS BIGINT) AS position, CASE WHEN strand = '-' THEN e - (p - (z - (e - s))) ELSE s + (p - (z - (e - s))) END AS genomic FROM c JOIN q ON p <= z AND p >= z - (e - s)"
put("overlap_join", "SELECT a.transcript_id AS left_id, b.transcript_id AS right_id, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS overlap FROM tx a JOIN tx b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s WHERE a.biotype = 'lncRNA' AND b.biotype <> 'lncRNA'", "tx_exons", "tx")
put("containment", "SELECT a.transcript_id AS outer_id, b.transcript_id AS inner_id FROM tx a JOIN tx b ON a.seq_region = b.seq_region AND a.s <= b.s AND a.e >= b.e AND a.transcript_id <> b.transcript_id", "tx_exons", "tx")
for _name, _strand in (("lncrna_overlap_filter", "AND a.strand = b.strand "), ("lncrna_overlap_filter_unstranded", "")):
    put(_name, f"SELECT transcript_id, biotype FROM tx a WHERE biotype = 'protein_coding' OR NOT EXISTS (SELECT 1 FROM tx b WHERE b.biotype = 'protein_coding' AND a.seq_region = b.seq_region {_strand}AND a.s <= b.e AND a.e >= b.s)", "tx_exons", "tx")
put("lncrna_min_length", "SELECT gene_id, transcript_id FROM tx WHERE biotype = 'lncRNA' AND gene_id IN (SELECT gene_id FROM tx WHERE biotype = 'lncRNA' AND len >= 200)", "tx_exons", "tx")
ORACLES["span_clusters"] = more(("tx_exons", "tx"), "p AS (SELECT *, max(e) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM tx)") + "SELECT transcript_id, max(CASE WHEN p IS NULL OR s > p THEN s END) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cluster_start FROM p"


def components(where: str = "true") -> str:
    """cc (transcript_id, cluster): transcripts connected by overlap of coding exons."""
    return f"""ed AS (SELECT DISTINCT a.transcript_id AS x, b.transcript_id AS y FROM cds a JOIN cds b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s AND {where}),
  re AS (SELECT x AS n, y AS m FROM ed UNION SELECT re.n, ed.y FROM re JOIN ed ON re.m = ed.x), lb AS (SELECT n, min(m) AS l FROM re GROUP BY 1),
  cc AS (SELECT t.transcript_id, coalesce(l, t.transcript_id) AS cluster, t.source, t.gene_id, t.seq_region, t.strand, t.s, t.e, t.cs, t.len, t.n_exons FROM tx t LEFT JOIN lb ON lb.n = t.transcript_id)"""


ORACLES["coding_exon_clusters"] = more(A, components()) + "SELECT transcript_id, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size FROM cc"
put("coding_overlap", "SELECT a.transcript_id AS left_id, b.transcript_id AS right_id, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) AS BIGINT) AS overlap FROM cds a JOIN cds b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s WHERE a.source = 'transcriptomic' AND b.source = 'protein' GROUP BY 1, 2", *A)
ORACLES["layer_sets"] = more(A, components(), "p AS (SELECT *, CASE source WHEN 'transcriptomic' THEN 1 WHEN 'busco' THEN 2 ELSE 3 END AS r FROM cc)") + "SELECT transcript_id, source FROM (SELECT *, min(r) OVER (PARTITION BY cluster) AS b FROM p) WHERE r = b"
ORACLES["augment_sets"] = more(
    A, components("a.source = b.source"), CDSLEN,
    "ty AS (SELECT c.*, cds_len, row_number() OVER (PARTITION BY cluster ORDER BY -(cds_len // 3), -len, c.transcript_id) AS k FROM cc c JOIN cl ON c.transcript_id = cl.transcript_id)",
    "sp AS (SELECT cluster, min(source) AS source, min(seq_region) AS seq_region, min(strand) AS strand, min(s) AS s, max(e) AS e, min(CASE WHEN k = 1 THEN transcript_id END) AS head FROM ty GROUP BY 1)",
    "pr AS (SELECT u.head AS u, l.head AS c, l.cluster AS lc FROM sp u JOIN sp l ON u.seq_region = l.seq_region AND u.strand = l.strand AND u.s <= l.e AND u.e >= l.s WHERE u.source = 'transcriptomic' AND l.source = 'busco')",
    "ov AS (SELECT a.transcript_id AS u, b.transcript_id AS x, sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) AS n FROM cds a JOIN cds b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s GROUP BY 1, 2)",
    "mt AS (SELECT DISTINCT ov.u, ty.cluster FROM ov JOIN ty ON ov.x = ty.transcript_id)",
) + "SELECT DISTINCT pr.c AS transcript_id FROM pr LEFT JOIN mt ON mt.u = pr.u AND mt.cluster = pr.lc LEFT JOIN ov ON ov.u = pr.u AND ov.x = pr.c JOIN cl ON cl.transcript_id = pr.c WHERE mt.u IS NULL OR coalesce(ov.n, 0) <= 0.9 * cl.cds_len"
SKIPPED = "dx AS (SELECT DISTINCT gene_id, s, e FROM cds)", "ig AS (SELECT it.*, tx.gene_id AS g FROM it JOIN tx ON it.transcript_id = tx.transcript_id WHERE b IS NOT NULL)", "sk AS (SELECT g AS gene_id, transcript_id, rank, count_if(dx.s IS NOT NULL AND a <= dx.e AND b >= dx.s) AS n_skipped FROM ig LEFT JOIN dx ON ig.g = dx.gene_id GROUP BY 1, 2, 3)"
ORACLES["skipped_exons"] = more(A, INTRONS, *SKIPPED) + "SELECT gene_id, transcript_id, rank, CAST(n_skipped AS BIGINT) AS n_skipped FROM sk"
ORACLES["readthrough_filter"] = more(A, INTRONS, *SKIPPED, CDSLEN, BEST, "gb AS (SELECT gene_id, bool_or(cs IS NOT NULL) AS codes FROM tx GROUP BY 1)", "lf AS (SELECT t.gene_id, t.transcript_id FROM tx t JOIN gb ON t.gene_id = gb.gene_id AND codes WHERE t.transcript_id NOT IN (SELECT transcript_id FROM sk WHERE n_skipped > 1))") + "SELECT * FROM lf UNION ALL SELECT gene_id, transcript_id FROM bst WHERE k = 1 AND gene_id IN (SELECT gene_id FROM gb WHERE codes) AND gene_id NOT IN (SELECT gene_id FROM lf) UNION ALL SELECT t.gene_id, t.transcript_id FROM tx t JOIN gb ON t.gene_id = gb.gene_id WHERE NOT codes"
put("cds_extents", "SELECT gene_id, min(cs) AS cds_low, max(ce) AS cds_high FROM tx WHERE cs IS NOT NULL GROUP BY 1", "tx_exons", "tx")
# Models with the CDS over the middle half of their span.
WIDE = "w AS (SELECT transcript_id, gene_id, seq_region, strand, s AS ts, e AS te, s + (e - s) // 4 AS cs, e - (e - s) // 4 AS ce FROM tx)"
ORACLES["utr_over_neighbour"] = more(("tx_exons", "tx"), WIDE, RANKED, "gx AS (SELECT gene_id, min(seq_region) AS seq_region, min(strand) AS strand, min(cs) AS lo, max(ce) AS hi FROM w GROUP BY 1)", "lf AS (SELECT r.* FROM rk r JOIN w ON r.transcript_id = w.transcript_id WHERE NOT ((r.e < w.cs OR r.s > w.ce) AND EXISTS (SELECT 1 FROM gx WHERE gx.gene_id <> w.gene_id AND gx.seq_region = r.seq_region AND gx.strand = r.strand AND r.s <= gx.hi AND r.e >= gx.lo)))") + 'SELECT transcript_id, row_number() OVER (PARTITION BY transcript_id ORDER BY rank) AS rank, s AS start, e AS "end" FROM lf'
ORACLES["collapse_transcripts"] = more(A, components(), CDSLEN, INTRONS, "ch AS (SELECT transcript_id, string_agg(concat(a, '..', b, ':'), '' ORDER BY a) AS chain FROM it WHERE b IS NOT NULL GROUP BY 1)", "q AS (SELECT c.*, cds_len, coalesce(chain, concat(s, ':', e)) AS chain FROM cc c JOIN cl ON c.transcript_id = cl.transcript_id LEFT JOIN ch ON c.transcript_id = ch.transcript_id)", "o AS (SELECT *, row_number() OVER (PARTITION BY cluster, chain ORDER BY s - e, transcript_id) AS k FROM q)", "p AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY -cds_len, transcript_id) AS j FROM o WHERE k = 1)") + "SELECT transcript_id FROM p WHERE j <= 2"
TRF = "((score < 50 AND matches >= 80 AND copies > 2 AND period < 10) OR (copies >= 2 AND matches >= 70 AND score >= 50))"
CPG = "(e - s + 1 >= 400 AND gc >= 50 AND oe >= 0.6)"
JUNCTION = "(strand_code <> 0 AND e - s + 1 >= 100 AND NOT (motif = 0 AND multi < 10))"
STRAND = "CASE WHEN strand_code = 2 THEN '-' ELSE '+' END"
put("trf_filter", f'SELECT seq_region, s AS start, e AS "end", score FROM tool_rows WHERE {TRF}', "tool_rows")
put("cpg_filter", f'SELECT seq_region, s AS start, e AS "end", gc FROM tool_rows WHERE {CPG}', "tool_rows")
put("junction_filter", f'SELECT seq_region, s AS start, e AS "end", {STRAND} AS strand, multi FROM tool_rows WHERE {JUNCTION}', "tool_rows")
put("junction_hints", f'SELECT seq_region, {STRAND} AS strand, s AS start, e AS "end", uniq + multi AS mul FROM tool_rows WHERE {JUNCTION}', "tool_rows")
MODELS = "md AS (SELECT DISTINCT s_suppkey % 8 AS model, list_extract([" + ", ".join(f"'{x}'" for x in RFAM_NAMES) + "], s_suppkey % 8 + 1) AS name, list_extract([" + ", ".join(f"'{x}'" for x in RFAM_TYPES) + "], s_suppkey % 8 + 1) AS type, concat('RF', s_suppkey % 8) AS accession, CAST(s_suppkey % 8 * 10 + 30 AS DOUBLE) AS threshold FROM supplier)"
HITS = f"ht AS (SELECT seq_region, s, e, {STRAND} AS strand, name AS query, accession, CAST(score AS DOUBLE) AS score, type, threshold FROM tool_rows JOIN md ON tool_rows.model = md.model)"
ORACLES["rfam_threshold"] = more(("tool_rows",), MODELS, HITS) + "SELECT seq_region, s AS start, e AS \"end\", query, score FROM ht WHERE query NOT IN ('LSU_rRNA_archaea', 'LSU_rRNA_bacteria') AND score >= CASE query WHEN 'LSU_rRNA_eukarya' THEN 1700 WHEN 'SSU_rRNA_eukarya' THEN 1600 WHEN '5_8S_rRNA' THEN 85 WHEN '5S_rRNA' THEN 75 ELSE threshold END"
ORACLES["rfam_best_hits"] = more(("tool_rows",), MODELS, HITS, "d AS (SELECT DISTINCT seq_region, strand, s, e, accession, score FROM ht)") + 'SELECT seq_region, strand, s AS start, e AS "end", accession, score FROM d a WHERE NOT EXISTS (SELECT 1 FROM d b WHERE a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s AND (-b.score, b.accession, b.s, b.e) < (-a.score, a.accession, a.s, a.e))'
ORACLES["rfam_biotype"] = more(("tool_rows",), MODELS, HITS) + "SELECT query, CASE WHEN lower(query) LIKE 'vault%' THEN 'Vault_RNA' WHEN query = 'Y_RNA' THEN 'Y_RNA' WHEN type LIKE 'ribozyme;%' THEN 'ribozyme' WHEN type LIKE 'antitoxin;%' THEN 'antitoxin' WHEN type LIKE 'antisense;%' THEN 'antisense' WHEN type LIKE 'rRNA;%' THEN 'rRNA' WHEN type LIKE 'snRNA; snoRNA; scaRNA;%' THEN 'scaRNA' WHEN type LIKE 'snRNA; snoRNA%' THEN 'snoRNA' WHEN type LIKE 'snRNA;%' THEN 'snRNA' ELSE 'misc_RNA' END AS biotype, f AS feature_type, count(*) AS n FROM ht, (SELECT unnest(['transcript', 'exon']) AS f) GROUP BY ALL"
ORACLES["select_models"] = f"WITH {MODELS} SELECT name, accession, threshold FROM md WHERE threshold >= 60"
ORACLES["repeat_class_types"] = "WITH p AS (SELECT p_partkey, list_extract(['LINE/L1', 'SINE', 'DNA/hAT', 'LTR/Gypsy', 'Simple_repeat', 'tRNA', 'rRNA', 'Satellite', 'Low_complexity', 'odd'], CAST(p_partkey % 10 + 1 AS INT)) AS c FROM part) SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(c, '{p}') THEN '{n}'" for p, n in REPEAT_TYPES) + " ELSE 'Unknown' END AS repeat_type FROM p"
for _mode in ("general", "relaxed", "moderate"):
    _single = {"general": "", "relaxed": "WHEN n_cds = 1 THEN CASE WHEN hit OR (a AND b AND p >= 100) OR ((a OR b) AND p >= 100 AND m >= 0.8) THEN 'protein_coding' END ", "moderate": "WHEN n_cds = 1 THEN CASE WHEN (hit AND p >= 100) OR (a AND b AND p >= 100 AND v >= 0.9) THEN 'protein_coding' END "}[_mode]
    ORACLES[f"coding_validation_{_mode}"] = more((*A, "evidence", "diamond"), CDSLEN, "j AS (SELECT t.transcript_id, t.source, t.cs, t.len, coalesce(n_cds, 0) AS n_cds, rnasamba_coding AS a, cpc2_coding AS b, peptide_length AS p, greatest(rnasamba_prob, cpc2_prob) AS m, (rnasamba_prob + cpc2_prob) / 2 AS v, d.evalue IS NOT NULL AS hit FROM tx t LEFT JOIN cl ON t.transcript_id = cl.transcript_id JOIN evidence ev ON ev.transcript_id = t.transcript_id LEFT JOIN diamond d ON d.transcript_id = t.transcript_id)", f"k AS (SELECT *, CASE WHEN source IN ('busco', 'protein') THEN 'protein_coding' {_single}WHEN hit OR (a AND b AND p >= 75) OR ((a OR b) AND p >= 75 AND m >= 0.8) THEN 'protein_coding' WHEN len >= 200 THEN 'lncRNA' END AS biotype FROM j)") + "SELECT transcript_id, biotype, CASE WHEN biotype <> 'lncRNA' THEN cs END AS cds_start FROM k WHERE biotype IS NOT NULL"
put("combine_evidence", "SELECT ev.transcript_id, rnasamba_prob, cpc2_prob, evalue, n_hits FROM evidence ev LEFT JOIN diamond d ON ev.transcript_id = d.transcript_id", "evidence", "diamond")
put("exon_hints", 'SELECT seq_region, strand, s AS start, e AS "end", count(*) AS mul FROM tx_exons GROUP BY ALL', "tx_exons")
ORACLES["cds_chain_counts"] = more(A, "c AS (SELECT t.transcript_id, t.seq_region, coalesce(string_agg(concat(c.s, ':', c.e, ':', c.strand), ':' ORDER BY c.s), '') AS chain FROM tx t LEFT JOIN cds c ON t.transcript_id = c.transcript_id GROUP BY 1, 2)", "n AS (SELECT seq_region, chain, count(*) AS n FROM c GROUP BY 1, 2)") + "SELECT seq_region, n, count(*) AS n_chains FROM n GROUP BY 1, 2"
STATS = "st AS (SELECT t.transcript_id, t.n_exons, coalesce(n_cds, 0) AS n_cds_exons, coalesce(cds_len, 0) AS cds_length, t.e - t.s + 1 AS span FROM tx t LEFT JOIN cl ON t.transcript_id = cl.transcript_id)"
ORACLES["model_stats"] = more(A, CDSLEN, STATS, INTRONS, "mi AS (SELECT transcript_id, max(b - a + 1) AS longest_intron FROM it GROUP BY 1)") + "SELECT st.transcript_id, n_exons, n_cds_exons, CAST(cds_length AS BIGINT) AS cds_length, round(CASE WHEN n_cds_exons > 0 THEN cds_length / n_cds_exons END, 6) AS mean_cds_exon, round(n_cds_exons / n_exons, 6) AS cds_ratio, span, longest_intron FROM st JOIN mi ON st.transcript_id = mi.transcript_id"
GOOD = "n_cds_exons > 0 AND ((n_cds_exons = 1 AND cds_length >= 450) OR cds_length >= 300)"
ORACLES["model_scores"] = more(A, CDSLEN, STATS) + f"SELECT transcript_id, CAST(CASE WHEN {GOOD} THEN 1 ELSE 0 END AS BIGINT) AS score, {GOOD} AS is_good FROM st"
ORACLES["sub_chain_filter"] = more(A, components(), CDSLEN, "ci AS (SELECT transcript_id, e + 1 AS a, lead(s) OVER (PARTITION BY transcript_id ORDER BY s) - 1 AS b FROM cds)", "ch AS (SELECT transcript_id, coalesce(string_agg(concat(a, '..', b, ':'), '' ORDER BY a) FILTER (b IS NOT NULL), '') AS chain FROM ci GROUP BY 1)", "q AS (SELECT c.cluster, c.transcript_id, chain, n_cds, cds_len FROM cc c JOIN cl ON c.transcript_id = cl.transcript_id JOIN ch ON ch.transcript_id = c.transcript_id)", "f AS (SELECT q.*, chain <> '' AND EXISTS (SELECT 1 FROM q o WHERE o.cluster = q.cluster AND o.chain <> q.chain AND contains(o.chain, q.chain)) AS sub FROM q)", "m AS (SELECT cluster, max(n_cds) AS mn, max(cds_len) AS ml FROM f WHERE NOT sub GROUP BY 1)") + "SELECT transcript_id, NOT sub AND NOT coalesce(n_cds < 0.75 * mn AND cds_len < 0.75 * ml, false) AS is_good FROM f LEFT JOIN m ON f.cluster = m.cluster"
ORACLES["final_classification"] = more(A, components(), CDSLEN, STATS, f"q AS (SELECT c.cluster, c.transcript_id, {GOOD} AS g FROM cc c JOIN st ON c.transcript_id = st.transcript_id)") + "SELECT transcript_id, CASE WHEN g THEN 'good' WHEN bool_or(g) OVER (PARTITION BY cluster) THEN 'ignore' ELSE 'check' END AS class FROM q"
put("reverse_complement", "SELECT doc_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS digest FROM contigs", "contigs")
AA = "list_extract(['" + "', '".join("FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG") + "'], CAST(16 * (instr('TCAG', substr(c, 1, 1)) - 1) + 4 * (instr('TCAG', substr(c, 2, 1)) - 1) + instr('TCAG', substr(c, 3, 1)) AS INT))"
put("translate", f"SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(seq, '...'), lambda c: {AA}), '')) AS digest FROM contigs", "contigs")
FRAMES = f"bo AS (SELECT doc_id, '+' AS strand, seq FROM contigs UNION ALL SELECT doc_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM contigs), fr AS (SELECT doc_id, strand, f AS frame, array_to_string(list_transform(regexp_extract_all(substr(seq, f + 1), '...'), lambda c: {AA}), '') AS aa FROM bo, range(3) r(f)), ps AS (SELECT doc_id, strand, frame, string_split(aa, '*') AS p FROM fr), ex AS (SELECT doc_id, strand, frame, unnest(p) AS x, generate_subscripts(p, 1) AS i, len(p) AS n FROM ps), st AS (SELECT *, coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id, strand, frame ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p0 FROM ex)"
ORF = "ob AS (SELECT *, p0 + instr(x, 'M') - 1 AS m, length(x) - instr(x, 'M') + 1 AS k FROM st WHERE i < n AND instr(x, 'M') > 0), oo AS (SELECT doc_id, strand, frame, m * 3 + frame + 1 AS start, (m + k + 1) * 3 + frame AS \"end\", k FROM ob)"
ORACLES["orfs"] = more(("contigs",), FRAMES, ORF) + 'SELECT doc_id, strand, frame, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM oo WHERE "end" - start + 1 >= 60'
ORACLES["orfs_in_sequences"] = ORACLES["orfs_over_chunks"] = ORACLES["orfs"]
put("fasta_chunks", "SELECT CAST(doc_id AS VARCHAR) AS seq_region, CAST(k * 1000 + 1 AS BIGINT) AS start, CAST(k * 1000 + length(x) AS BIGINT) AS \"end\", md5(x) AS digest FROM (SELECT doc_id, k, substr(seq, k * 1000 + 1, 1000) AS x FROM (SELECT doc_id, seq, unnest(range((length(seq) + 999) // 1000)) AS k FROM contigs))", "contigs")
put("fasta_lengths", "SELECT CAST(doc_id AS VARCHAR) AS seq_region, CAST(length(seq) AS BIGINT) AS length FROM contigs WHERE length(seq) > 500", "contigs")
ORACLES["best_translations"] = more(("contigs",), FRAMES, ORF, "wm AS (SELECT doc_id, start, \"end\", k, row_number() OVER (PARTITION BY doc_id ORDER BY k DESC, start) AS r FROM oo WHERE strand = '+')", "nm AS (SELECT doc_id, p0 * 3 + frame + 1 AS start, (p0 + length(x)) * 3 + frame AS \"end\", length(x) AS k, row_number() OVER (PARTITION BY doc_id ORDER BY length(x) DESC, p0 * 3 + frame + 1) AS r FROM st WHERE strand = '+' AND length(x) > 0)", "b AS (SELECT c.doc_id, coalesce(wm.k, 0) < 100 AND coalesce(nm.k, 0) > 2 * coalesce(wm.k, 0) AS no, wm.start AS s1, wm.\"end\" AS e1, wm.k AS k1, nm.start AS s2, nm.\"end\" AS e2, nm.k AS k2 FROM contigs c LEFT JOIN wm ON c.doc_id = wm.doc_id AND wm.r = 1 LEFT JOIN nm ON c.doc_id = nm.doc_id AND nm.r = 1)") + 'SELECT doc_id, CAST(CASE WHEN no AND k2 >= 20 THEN s2 WHEN NOT no AND k1 >= 20 THEN s1 END AS BIGINT) AS start, CAST(CASE WHEN no AND k2 >= 20 THEN e2 WHEN NOT no AND k1 >= 20 THEN e1 END AS BIGINT) AS "end", CASE WHEN no AND k2 >= 20 THEN false WHEN NOT no AND k1 >= 20 THEN true END AS met FROM b'
ORACLES["pas_sites"] = more(("contigs",), "p AS (SELECT doc_id, seq, doc_id % 100 AS o, instr(substr(seq, doc_id % 100 + 1), 'AATAAA') AS g FROM contigs)", "q AS (SELECT *, instr(substr(seq, o + g + 5 + 15, 15), 'CA') AS c FROM p)", "z AS (SELECT *, CASE WHEN g > 0 AND c > 0 THEN o + g + 5 + 15 + c WHEN g > 0 THEN o + g + 35 WHEN length(seq) - o > 1000 THEN o + 1000 END AS cut FROM q)") + "SELECT doc_id, CASE WHEN cut < length(seq) THEN cut END AS cut FROM z"
put("splice_sites", "SELECT doc_id, concat(substr(seq, doc_id % 50 + 1, 2), substr(seq, doc_id % 50 + 99, 2)) IN ('GTAG', 'ATAC', 'GCAG') AS canonical, seq LIKE 'ATG%' AND right(seq, 3) IN ('TAA', 'TAG', 'TGA') AND length(seq) >= 300 AS valid FROM contigs WHERE length(seq) > 200", "contigs")
ORACLES["exon_strings"] = more(("tx_exons",), RANKED, INTRONS, "a AS (SELECT transcript_id, string_agg(concat(s, ':', e, ':', CASE WHEN strand = '-' THEN '-1' ELSE '1' END), ':' ORDER BY rank) AS exon_string FROM rk GROUP BY 1)", "b AS (SELECT transcript_id, coalesce(string_agg(concat(a, '..', b, ':'), '' ORDER BY a) FILTER (b IS NOT NULL), '') AS intron_string FROM it GROUP BY 1)") + "SELECT a.transcript_id, exon_string, intron_string FROM a JOIN b ON a.transcript_id = b.transcript_id"
put("bed12_to_exons", 'SELECT transcript_id AS name, seq_region, strand, row_number() OVER (PARTITION BY transcript_id ORDER BY s) AS rank, s AS start, e AS "end" FROM tx_exons', "tx_exons")
ORACLES["gtf_roundtrip"] = more(("tx_exons",), RANKED) + 'SELECT transcript_id, rank, seq_region, strand, s AS start, e AS "end" FROM rk'
ORACLES["gtf_of_regions"] = more(("tx_exons",), RANKED) + "SELECT seq_region, strand, transcript_id, count(*) AS n_exons, min(s) AS start, max(e) AS \"end\", CAST(sum(e - s + 1) AS BIGINT) AS bases FROM rk WHERE seq_region IN ('r1', 'r10', 'r2', 'r7') GROUP BY 1, 2, 3"
# A line for each gene (which has one region), transcript and exon.
ORACLES["gtf_region_index"] = more(("tx_exons",), RANKED) + "SELECT seq_region, count(*) + count(DISTINCT transcript_id) + count(DISTINCT gene_id) AS n_lines FROM rk GROUP BY 1"
put("fasta_roundtrip", "SELECT CAST(doc_id AS VARCHAR) AS name, length(seq) AS length, md5(seq) AS digest FROM contigs WHERE length(seq) > 0", "contigs")
put("repeat_table", "SELECT seq_region, s AS start, e AS \"end\", '+' AS strand, CASE WHEN model = 0 THEN 'trf' ELSE concat('m', model) END AS repeat_name, 'trf' AS repeat_class, 'Tandem repeats' AS repeat_type, 'N' AS repeat_consensus, CAST(1 AS BIGINT) AS repeat_start, e - s + 1 AS repeat_end, CAST(score AS DOUBLE) AS score, 'trf' AS analysis FROM tool_rows", "tool_rows")
put("simple_feature_table", "SELECT seq_region, s AS start, e AS \"end\", '+' AS strand, '' AS display_label, CAST(score AS DOUBLE) AS score, 'cpg' AS analysis FROM tool_rows", "tool_rows")
put("collate_results", f"SELECT 'trf' AS analysis, count(*) AS n, CAST(sum(s) AS BIGINT) AS starts FROM tool_rows WHERE {TRF} UNION ALL SELECT 'cpg', count(*), CAST(sum(s) AS BIGINT) FROM tool_rows WHERE {CPG}", "tool_rows")
put("gene_tables", "SELECT 'gene' AS name, count(DISTINCT gene_id) AS n FROM tx UNION ALL SELECT 'transcript', count(*) FROM tx UNION ALL SELECT 'exon', count(*) FROM tx_exons UNION ALL SELECT 'translation', count(*) FROM tx WHERE cs IS NOT NULL", "tx_exons", "tx")
ORACLES["gene_table"] = more(A, CDSLEN, BEST) + 'SELECT gene_id, min(seq_region) AS seq_region, min(strand) AS strand, min(s) AS start, max(e) AS "end", min(CASE WHEN k = 1 THEN biotype END) AS biotype, min(CASE WHEN k = 1 THEN transcript_id END) AS canonical_transcript FROM bst GROUP BY 1'
ORACLES["utr_split"] = more(("tx_exons", "tx"), WIDE, "lr AS (SELECT x.transcript_id, min(x.strand) AS strand, count_if(x.s < w.cs) AS nl, coalesce(sum(CASE WHEN x.s < w.cs THEN least(x.e, w.cs - 1) - x.s + 1 END), 0) AS ll, count_if(x.e > w.ce) AS nr, coalesce(sum(CASE WHEN x.e > w.ce THEN x.e - greatest(x.s, w.ce + 1) + 1 END), 0) AS rl FROM tx_exons x JOIN w ON x.transcript_id = w.transcript_id GROUP BY 1)") + "SELECT transcript_id, CAST(CASE WHEN strand = '-' THEN nr ELSE nl END AS BIGINT) AS n5, CAST(CASE WHEN strand = '-' THEN nl ELSE nr END AS BIGINT) AS n3, CAST(CASE WHEN strand = '-' THEN rl ELSE ll END - 100 AS BIGINT) AS utr5_length, CAST(CASE WHEN strand = '-' THEN ll ELSE rl END - 100 AS BIGINT) AS utr3_length FROM lr"
# Exons and CDS mirrored on the reverse strand: os, oe, a, z; i from 1 in transcript order.
ORIENTED = "ow AS (SELECT x.transcript_id, x.strand, CASE WHEN x.strand = '-' THEN -x.e ELSE x.s END AS os, CASE WHEN x.strand = '-' THEN -x.s ELSE x.e END AS oe, CASE WHEN x.strand = '-' THEN -w.ce ELSE w.cs END AS a, CASE WHEN x.strand = '-' THEN -w.cs ELSE w.ce END AS z FROM tx_exons x JOIN w ON x.transcript_id = w.transcript_id)"
BACK = "SELECT transcript_id, row_number() OVER (PARTITION BY transcript_id ORDER BY os) AS rank, CASE WHEN strand = '-' THEN -oe ELSE os END AS start, CASE WHEN strand = '-' THEN -os ELSE oe END AS \"end\" FROM "
ORACLES["three_prime_trim"] = more(
    ("tx_exons", "tx"), WIDE, ORIENTED,
    "la AS (SELECT transcript_id, max(CASE WHEN os <= z THEN oe END) AS le, min(CASE WHEN os > z THEN os END) AS ns, max(oe) > min(z) AS has FROM ow GROUP BY 1)",
    "kp AS (SELECT o.*, le, has, ns, ne, CASE WHEN le > z THEN le - z ELSE ne - ns + 1 END < 80 AND ne - ns + 1 >= 100 AND ns - le + 1 >= 250 AS keep FROM ow o JOIN la ON o.transcript_id = la.transcript_id LEFT JOIN (SELECT ow.transcript_id, os AS ms, oe AS ne FROM ow) n ON n.transcript_id = o.transcript_id AND n.ms = la.ns)",
    "ks AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY os DESC) AS r FROM kp WHERE NOT has OR os <= z OR (coalesce(keep, false) AND os = ns))",
    "fx AS (SELECT transcript_id, strand, os, CASE WHEN has AND r = 1 THEN oe - greatest(oe - os + 1 - CASE WHEN os <= z THEN z - os ELSE 0 END - 80, 0) ELSE oe END AS oe FROM ks)",
) + BACK + "fx"
ORACLES["five_prime_trim"] = more(
    ("tx_exons", "tx"), WIDE, ORIENTED,
    "fc AS (SELECT transcript_id, min(CASE WHEN oe >= a AND os <= z THEN os END) AS c1, min(os) < min(a) AS has FROM ow GROUP BY 1)",
    "sd AS (SELECT o.*, has, c1, CASE WHEN oe >= a THEN a - os + 1 ELSE oe - os + 1 END AS u FROM ow o JOIN fc ON o.transcript_id = fc.transcript_id WHERE NOT has OR os >= a OR oe >= a OR oe - os + 1 > 100)",
    "cu AS (SELECT *, (has AND (oe < a OR os = c1)) AS side, sum(CASE WHEN has AND (oe < a OR os = c1) THEN u END) OVER (PARTITION BY transcript_id ORDER BY os DESC) AS c FROM sd)",
    "ov AS (SELECT *, c - 300 AS o, max(CASE WHEN side AND c > 300 THEN os END) OVER (PARTITION BY transcript_id) AS stop FROM cu)",
    "fx AS (SELECT transcript_id, strand, CASE WHEN side AND os = stop AND u - o >= 50 THEN os + o ELSE os END AS os, oe FROM ov WHERE NOT side OR stop IS NULL OR os > stop OR (os = stop AND (u - o >= 50 OR oe >= a)))",
) + BACK + "fx"
ORACLES["dedup_proteins"] = more(("contigs",), f"p AS (SELECT concat('6573_0:', lpad(CAST(doc_id AS VARCHAR), 8, '0')) AS name, array_to_string(list_transform(regexp_extract_all(seq, '...'), lambda c: {AA}), '') AS aa FROM contigs)") + "SELECT max(name) AS name, length(aa) AS length FROM p WHERE length(aa) >= 100 GROUP BY aa"

def sampled(size: str) -> str:
    return f"WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY (doc_id * 7919) % 10007, doc_id) AS r FROM (SELECT DISTINCT doc_id FROM documents)) SELECT doc_id AS read_no, m AS mate FROM n, (SELECT unnest([1, 2]) AS m) WHERE r <= {size}"


SHARE = "CAST(round_even((SELECT count(*) FROM n) * 0.3, 0) AS BIGINT)"
ORACLES["subsample_reads"] = sampled(f"least(400, {SHARE})")
ORACLES["subsample_reads_smaller"] = sampled(f"least(200, {SHARE})")
ORACLES["subsample_reads_share"] = sampled(SHARE)
ORACLES["subsample_reads_limit"] = sampled("150")
ORACLES["paired_files"] = "SELECT concat('in/s', c_custkey // 2, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('_', c_custkey % 2 + 1) END, '.fastq.gz') AS path, concat('s', c_custkey // 2) AS sample, CAST(CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE c_custkey % 2 + 1 END AS INT) AS mate FROM customer"
put("pair_mates", "SELECT a.doc_id // 2 AS read_no, CAST(a.doc_id AS VARCHAR) AS header1, CAST(b.doc_id AS VARCHAR) AS header2, a.seq AS seq1, b.seq AS seq2 FROM contigs a LEFT JOIN contigs b ON b.doc_id = a.doc_id + 1 WHERE a.doc_id % 2 = 0", "contigs")
ORACLES["clade_members"] = "SELECT DISTINCT n_name AS species FROM nation WHERE n_regionkey = 1"
ORACLES["small_models"] = more(A, CDSLEN, STATS) + "SELECT transcript_id, CASE WHEN cds_length = 0 THEN true ELSE n_cds_exons <= 1 OR (n_cds_exons = 2 AND greatest(cds_length, 6) < 600) OR span < 1000 OR greatest(cds_length, 6) < 300 END AS small FROM st"


# Readers.
END = 'e AS "end"'
RM = "CASE WHEN strand_code <> 2"
put("read_fastq", "SELECT 1 AS mate, concat('@', doc_id) AS header, md5(seq) AS digest, length(seq) AS n_qual FROM contigs WHERE length(seq) > 0", "contigs")
def _ingested(group: str) -> str:
    """Rows by region and rejected lines of a group of readers."""
    parts = []
    for tool in fixtures.TOOL_GROUPS[group]:
        region = "CAST(NULL AS VARCHAR)" if tool in fixtures.WITHOUT_REGION else "'r1'" if tool in ("dust", "trf") else "seq_region"
        each = 2 if tool == "trnascan" else 1
        parts.append(f"SELECT '{tool}' AS analysis, 'row' AS kind, {region} AS value, count(*) * {each} AS n FROM tool_rows WHERE motif <> 6 GROUP BY ALL")
        parts.append(f"SELECT '{tool}' AS analysis, 'reject' AS kind, {fixtures.TOOL_LINES[tool][1]} AS value, count(*) AS n FROM tool_rows WHERE motif = 6 GROUP BY ALL")
    return " UNION ALL ".join(parts)


for _group in fixtures.TOOL_GROUPS:
    put(f"ingest_{_group}", _ingested(_group), "tool_rows")
put("augustus_records", "SELECT min(t.seq_region) AS seq_region, min(t.s) AS start, max(t.e) AS \"end\", CAST(1 AS BIGINT) AS n_transcripts, count(*) AS n_exons, count(*) AS last_exon FROM tx t JOIN tx_exons x ON t.transcript_id = x.transcript_id GROUP BY t.transcript_id", "tx_exons", "tx")
ORACLES["read_bed12"] = ORACLES["bed12_to_exons"]
put("read_repeatmasker", f"SELECT seq_region, s AS start, {END}, {RM} THEN '+' ELSE '-' END AS strand, CAST(score AS DOUBLE) AS score, concat('rep', model) AS repeat_name, list_extract(['LINE/L1', 'DNA/hAT', 'Simple_repeat'], motif % 3 + 1) AS repeat_class, list_extract(['Type I Transposons/LINE', 'Type II Transposons', 'Simple repeats'], motif % 3 + 1) AS repeat_type, multi AS repeat_start, period AS repeat_end FROM tool_rows WHERE motif <> 6", "tool_rows")
put("read_dust", f"SELECT 'r1' AS seq_region, s AS start, {END} FROM tool_rows", "tool_rows")
put("read_trf", f"SELECT 'r1' AS seq_region, s AS start, {END}, CAST(period AS DOUBLE) AS period, copies, CAST(matches AS DOUBLE) AS matches, CAST(score AS DOUBLE) AS score, 'ACGT' AS repeat_consensus FROM tool_rows WHERE {TRF}", "tool_rows")
put("read_red", f"SELECT seq_region, s AS start, {END} FROM tool_rows", "tool_rows")
put("read_eponine", f"SELECT seq_region, s AS start, {END}, CAST(score AS DOUBLE) AS score, {STRAND} AS strand FROM tool_rows", "tool_rows")
put("read_cpg", f"SELECT seq_region, s AS start, {END}, CAST(score AS DOUBLE) AS score, CAST(gc AS DOUBLE) AS gc, oe FROM tool_rows WHERE motif > 1 AND {CPG}", "tool_rows")
put("read_trnascan", f"SELECT seq_region, s AS start, {END}, {STRAND} AS strand, concat('Ala', model) AS trna_type, CAST(score AS DOUBLE) AS score, CASE WHEN motif < 3 THEN 'tRNA' ELSE 'tRNA_pseudogene' END AS biotype, f AS feature_type FROM tool_rows, (SELECT unnest(['transcript', 'exon']) AS f)", "tool_rows")
put("read_cmsearch", f"SELECT seq_region, concat('m', model) AS query, concat('RF', model) AS accession, s AS start, {END}, {STRAND} AS strand, CAST(score AS DOUBLE) AS score, 0.00001::DOUBLE AS evalue FROM tool_rows", "tool_rows")
ORACLES["read_genblast"] = more(("tx_exons", "tx"), RANKED) + f"SELECT seq_region, 'genBlast' AS source, 'transcript' AS feature_type, s AS start, {END}, 50.5::DOUBLE AS score, strand, concat('P', transcript_id) AS transcript_id, CAST(NULL AS INT) AS exon_number, concat('P', transcript_id) AS gene_id FROM tx UNION ALL SELECT seq_region, 'genBlast', 'exon', s, e, 1.5, strand, concat('P', transcript_id), rank, concat('P', transcript_id) FROM rk"
put("read_augustus", f"SELECT seq_region, 'transcript' AS feature_type, s AS start, {END}, strand, CAST(NULL AS BIGINT) AS exon_number FROM tx UNION ALL SELECT seq_region, 'exon', s, e, strand, row_number() OVER (PARTITION BY transcript_id ORDER BY s, e) FROM tx_exons", "tx_exons", "tx")
put("read_star_junctions", f"SELECT seq_region, s AS start, {END}, strand_code, motif, uniq, multi FROM tool_rows", "tool_rows")
put("read_rnasamba", "SELECT CAST(transcript_id AS VARCHAR) AS transcript_id, rnasamba_prob, rnasamba_coding FROM evidence WHERE transcript_id % 10 <> 0", "evidence")
put("read_cpc2", "SELECT CAST(transcript_id AS VARCHAR) AS transcript_id, 900 AS length, peptide_length, cpc2_prob, cpc2_coding FROM evidence", "evidence")
put("read_diamond", "SELECT CAST(transcript_id AS VARCHAR) AS transcript_id, evalue, n_hits FROM diamond", "diamond")
ORACLES["read_rfam_seed"] = f"WITH {MODELS} SELECT accession, name, concat('about ', name) AS description, type FROM md"
ORACLES["read_rfam_cm"] = f"WITH {MODELS} SELECT name, 'thing' AS description, model * 10 + 50 AS length, model * 10 + 80 AS max_length, accession, threshold FROM md"
ORACLES["sequence_sets"] = more(A, CDSLEN, BEST, "sq AS (SELECT transcript_id, k, cs, repeat('ACGT', CAST(e % 7 + 1 AS INT)) AS c, repeat('MK', CAST(s % 5 + 1 AS INT)) AS p FROM bst)") + "SELECT 'cdna' AS \"set\", transcript_id, c AS seq FROM sq UNION ALL SELECT 'canonical_cdna', transcript_id, c FROM sq WHERE k = 1 UNION ALL SELECT 'protein', transcript_id, p FROM sq WHERE cs IS NOT NULL UNION ALL SELECT 'canonical_protein', transcript_id, p FROM sq WHERE cs IS NOT NULL AND k = 1"

# Small operators.
ORACLES["region_names"] = "SELECT CAST(doc_id AS VARCHAR) AS seq_region FROM documents WHERE doc_id % 10 <> 0"
ORACLES["merge_region_sets"] = more(("tx_exons", "tx"), "g AS (SELECT seq_region, gene_id, row_number() OVER (ORDER BY seq_region, min(s), max(e), gene_id) AS g FROM tx GROUP BY 1, 2)", "t AS (SELECT *, row_number() OVER (PARTITION BY seq_region, gene_id ORDER BY s, e, transcript_id) AS k FROM tx)") + f"SELECT concat('sel_', g, '.t', k) AS transcript_id, concat('sel_', g) AS gene_id, s AS start, {END}, concat('c', transcript_id) AS cdna, CASE WHEN cs IS NOT NULL THEN concat('p', transcript_id) END AS protein FROM t JOIN g ON t.seq_region = g.seq_region AND t.gene_id = g.gene_id"
put("all_exons_cds", "SELECT transcript_id, s AS cds_start, e AS cds_end FROM tx", "tx_exons", "tx")
put("single_transcript_genes", f"SELECT transcript_id AS gene_id, seq_region, strand, s AS start, {END}, 1 AS n_transcripts FROM tx", "tx_exons", "tx")
put("default_biotypes", "SELECT transcript_id, CASE WHEN transcript_id % 3 = 0 THEN biotype WHEN cs IS NOT NULL THEN 'protein_coding' ELSE 'not_set' END AS biotype FROM tx", "tx_exons", "tx")
put("gene_order", "SELECT gene_id, row_number() OVER (PARTITION BY min(seq_region) ORDER BY CASE WHEN min(strand) = '-' THEN 1 ELSE 0 END, min(s), gene_id) AS place FROM tx GROUP BY gene_id", "tx_exons", "tx")

# The greedy choice, hit after hit within islands of overlapping hits.
ORACLES["rfam_best_hits_greedy"] = more(
    ("tool_rows",), MODELS, HITS,
    "d AS (SELECT DISTINCT seq_region, strand, s, e, accession, score FROM ht)",
    "o AS (SELECT *, max(e) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM d)",
    "i AS (SELECT *, max(CASE WHEN p IS NULL OR s > p THEN s END) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM o)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY seq_region, strand, isl ORDER BY score DESC, accession, s, e) AS k FROM i)",
    "w AS (SELECT seq_region, strand, isl, k, [{'s': s, 'e': e, 'a': accession, 'c': score}] AS kept FROM r WHERE k = 1 UNION ALL SELECT w.seq_region, w.strand, w.isl, r.k, CASE WHEN len(list_filter(w.kept, lambda q: q.s <= r.e AND q.e >= r.s)) = 0 THEN list_append(w.kept, {'s': r.s, 'e': r.e, 'a': r.accession, 'c': r.score}) ELSE w.kept END FROM w JOIN r ON r.seq_region = w.seq_region AND r.strand = w.strand AND r.isl = w.isl AND r.k = w.k + 1)",
    "l AS (SELECT seq_region, strand, unnest(kept) AS q FROM (SELECT *, row_number() OVER (PARTITION BY seq_region, strand, isl ORDER BY k DESC) AS z FROM w) WHERE z = 1)",
) + 'SELECT seq_region, strand, q.s AS start, q.e AS "end", q.a AS accession, q.c AS score FROM l'


# Stages.
def _canonical_genes(z: Stages) -> str:
    t, x = z.models()
    return z.canonical(z.put(f"SELECT t.*, cluster FROM {t} t JOIN {z.clusters(t, x)} c ON c.tid = t.tid"), x, "cluster")


def _collapse_lncrna(z: Stages) -> str:
    t, x = z.models()
    made = z.collapse(z.put(f"SELECT * FROM {t} WHERE biotype = 'lncRNA'"), x, coding=False, top=1)
    return z.put(f"SELECT * FROM {made} UNION ALL SELECT * FROM {t} WHERE biotype <> 'lncRNA'")


def _best_of(z: Stages, where: str = "true", all_exons: bool = False, clean: bool = False) -> str:
    every, every_x = z.models()
    t = z.put(f"SELECT * FROM {every} WHERE {where}")
    x = z.of(t, every_x)
    t = z.without_overlapping_exons(t, x)
    t = z.put(f"SELECT * REPLACE (s AS cs, e AS ce) FROM {t}") if all_exons else t
    if clean:
        t, x, _ = z.clean(z.genome(every, every_x), t, z.of(t, x))
    return z.select_best(t, x)


def _searched(z: Stages, genome: tuple, t: str, every_x: str) -> tuple[str, str]:
    """Models translated, with those found in their UTRs, and trimmed."""
    t, _ = z.translated(genome, t, z.of(t, every_x), 50)
    found = z.utr_search(genome, t, z.of(t, every_x), 4)
    t = z.put(" UNION ALL ".join(f"SELECT * REPLACE (CAST(tid AS VARCHAR) AS tid) FROM {a}" for a, _ in found))
    x = z.put(" UNION ALL ".join(f"SELECT CAST(tid AS VARCHAR) AS tid, s, e FROM {b}" for _, b in found))
    return z.trim_five(*z.cut_at_signal(genome, *z.trim_three(t, x)))


def _transcriptomic(z: Stages) -> tuple[str, str]:
    every, every_x = z.models()
    genome = z.genome(every, every_x)
    t = z.without_overlapping_exons(z.put(f"SELECT * FROM {every} WHERE source = 'transcriptomic'"), every_x)
    t, x = _searched(z, genome, t, every_x)
    return t, z.select_best(t, x)


def _sequences(z: Stages, coding: bool) -> str:
    t, x = z.models()
    genome = z.genome(t, x)
    return z.coding_sequences(genome, t, x) if coding else z.sequences(genome, t, x)


def _translations(z: Stages) -> tuple[str, str]:
    t, x = z.models()
    return z.translated(z.genome(t, x), t, x, 20)


def _cleaned(z: Stages) -> str:
    t, x = z.models()
    genome = z.genome(t, x)
    told, _ = z.translated(genome, t, x, 10)
    told = z.put(f"SELECT * FROM {told} WHERE cs IS NOT NULL")
    return z.clean(genome, told, z.of(told, x), 30, 30)[2]


def _at_signal(z: Stages) -> tuple[str, str]:
    t, x = z.models()
    t = z.put(f"SELECT * REPLACE (s + (e - s) // 4 AS cs, e - (e - s) // 4 AS ce) FROM {t}")
    genome = z.genome(t, x)
    return z.cut_at_signal(genome, *z.trim_three(t, x))


def _utr_search(z: Stages) -> str:
    t, x = z.models()
    genome = z.genome(t, x)
    short = z.put(f"SELECT * REPLACE (s AS cs, s + 60 AS ce) FROM {t}")
    found = z.utr_search(genome, short, x, 4, least=10, min_utr=200, multi=40, single=60)
    return z.put(" UNION ALL ".join(f"SELECT CAST(t.tid AS VARCHAR) AS transcript_id, {n} AS round, count(*) AS n_exons FROM {a} t JOIN {b} x ON x.tid = t.tid GROUP BY t.tid" for n, (a, b) in enumerate(found)))


def _joins(z: Stages) -> str:
    return z.put(" UNION ALL ".join(f"SELECT tid, ex FROM {q}" for q in z.join_transcripts(*z.models(), 12)))


def _layers(z: Stages) -> str:
    return z.finalise_layers(*z.models("cs IS NOT NULL", text_ids=True))[0]


def _finalised(z: Stages, by_source: bool = False) -> tuple[str, ...]:
    """by_source: transcriptomic models are searched, the others code from end to end, and protein ones are cleaned."""
    every, every_x = z.models(text_ids=True)
    genome = z.genome(every, every_x)
    evidence, diamond = z.put(EVIDENCE), z.put(DIAMOND)
    parts, exons = [], []
    for s in ("transcriptomic", "busco", "protein"):
        t = z.without_overlapping_exons(z.put(f"SELECT * REPLACE (tid AS gene_id) FROM {every} WHERE source = '{s}'"), every_x)
        x = every_x
        if by_source and s == "transcriptomic":
            t, x = _searched(z, genome, t, x)
        elif by_source:
            t = z.put(f"SELECT * REPLACE (s AS cs, e AS ce) FROM {t}")
            t, x = z.clean(genome, t, z.of(t, x))[:2] if s == "protein" else (t, x)
        best = z.select_best(t, x)
        parts.append(f"SELECT t.* REPLACE (concat('{s}:', tid) AS tid) FROM {t} t WHERE tid IN (SELECT tid FROM {best} WHERE class = 'good')")
        exons.append(f"SELECT concat('{s}:', tid) AS tid, s, e FROM {x} WHERE tid IN (SELECT tid FROM {t})")
    t, x = z.finalise_layers(z.put(" UNION ALL ".join(parts)), z.put(" UNION ALL ".join(exons)))
    told = z.put(f"SELECT t.*, len, rnasamba_coding AS a, cpc2_coding AS b, peptide_length AS p, greatest(rnasamba_prob, cpc2_prob) AS m, d.evalue IS NOT NULL AS hit, v.transcript_id IS NOT NULL AS known FROM {t} t JOIN {z.lengths(t, x)} l ON l.tid = t.tid LEFT JOIN {evidence} v ON CAST(v.transcript_id AS VARCHAR) = regexp_replace(regexp_replace(t.tid, '^[^:]*:', ''), '(_[bpq]|_m|_utr[53])+$', '') LEFT JOIN {diamond} d ON d.transcript_id = v.transcript_id")
    called = z.put(f"SELECT *, CASE WHEN source IN ('busco', 'protein') THEN 'protein_coding' WHEN hit OR (a AND b AND p >= 75) OR ((a OR b) AND p >= 75 AND m >= 0.8) THEN 'protein_coding' WHEN len >= 200 THEN 'lncRNA' END AS call FROM {told} WHERE known OR source IN ('busco', 'protein')")
    valid = z.put(f"SELECT tid, gene_id, seq_region, strand, source, call AS biotype, s, e, CASE WHEN call <> 'lncRNA' THEN cs END AS cs, CASE WHEN call <> 'lncRNA' THEN ce END AS ce FROM {called} WHERE call IS NOT NULL")
    t, x = z.clean_utrs(*z.clean_geneset(valid, x))
    cdna, cds = z.sequences(genome, t, x), z.coding_sequences(genome, t, x)
    protein = z.put(f"SELECT tid, regexp_replace(array_to_string(list_transform(regexp_extract_all(seq, '...'), lambda c: CASE WHEN regexp_full_match(c, '[ACGT]{{3}}') THEN {AA} ELSE 'X' END), ''), '\\*$', '') AS seq FROM {cds} WHERE length(seq) >= 3")
    genes = z.put(f"SELECT seq_region, gene_id, row_number() OVER (ORDER BY seq_region, min(s), max(e), gene_id) AS g FROM {t} GROUP BY 1, 2")
    ids = z.put(f"SELECT t.tid, concat('final_', g) AS gene, concat('final_', g, '.t', row_number() OVER (PARTITION BY t.seq_region, t.gene_id ORDER BY t.s, t.e, t.tid)) AS new FROM {t} t JOIN {genes} g ON g.seq_region = t.seq_region AND g.gene_id = t.gene_id")
    return t, ids, cdna, protein


SPAN = 's AS start, e AS "end"'
ORACLES["canonical_genes"] = stage(_canonical_genes, "SELECT cluster, head AS canonical_transcript FROM {}")
ORACLES["collapse_lncrna"] = stage(_collapse_lncrna, "SELECT tid AS transcript_id, gene_id, biotype FROM {}")
ORACLES["select_best"] = stage(_best_of, "SELECT tid AS transcript_id, class FROM {}")
ORACLES["select_best_busco"] = stage(lambda z: _best_of(z, "source = 'busco'", True), "SELECT tid AS transcript_id, class FROM {}")
ORACLES["select_best_protein"] = stage(lambda z: _best_of(z, "source = 'protein'", True, True), "SELECT tid AS transcript_id, class FROM {}")
ORACLES["select_best_transcriptomic"] = stage(_transcriptomic, f"SELECT b.tid AS transcript_id, class, cs AS cds_start, ce AS cds_end, {SPAN} FROM {{1}} b JOIN {{0}} t ON t.tid = b.tid")
ORACLES["finalise_layers"] = stage(_layers, "SELECT tid AS transcript_id, source FROM {}")
ORACLES["clean_geneset"] = stage(lambda z: z.clean_geneset(*z.models())[0], f"SELECT gene_id, tid AS transcript_id, biotype, {SPAN} FROM {{}}")
ORACLES["clean_utrs_and_lncrna"] = stage(lambda z: z.clean_utrs(*z.models())[0], f"SELECT tid AS transcript_id, biotype, {SPAN} FROM {{}}")
ORACLES["transcript_sequences"] = stage(lambda z: _sequences(z, False), "SELECT tid AS transcript_id, length(seq) AS length, md5(seq) AS digest FROM {}")
ORACLES["cds_sequences"] = stage(lambda z: _sequences(z, True), "SELECT tid AS transcript_id, length(seq) AS length, md5(seq) AS digest FROM {}")
ORACLES["compute_translations"] = stage(_translations, "SELECT t.tid AS transcript_id, cs AS cds_start, ce AS cds_end, length(seq) AS cds_length FROM {0} t LEFT JOIN {1} c ON c.tid = t.tid")
ORACLES["clean_transcripts"] = stage(_cleaned, "SELECT tid AS transcript_id, merged, n AS n_exons, cds_length FROM {}")
ORACLES["three_prime_trim_at_signal"] = stage(_at_signal, 'SELECT x.tid AS transcript_id, row_number() OVER (PARTITION BY x.tid ORDER BY CASE WHEN strand = \'-\' THEN -x.s ELSE x.s END) AS rank, x.s AS start, x.e AS "end" FROM {1} x JOIN {0} t ON t.tid = x.tid')
ORACLES["utr_orf_search"] = stage(_utr_search, "SELECT * FROM {}")
ORACLES["join_transcripts"] = stage(_joins, 'SELECT tid AS transcript_id, len(ex) AS n_exons, ex[1].s AS start, ex[-1].e AS "end" FROM {}')
FINAL = f"SELECT gene AS gene_id, new AS transcript_id, biotype, {SPAN}, md5(c.seq) AS cdna, md5(p.seq) AS protein FROM {{0}} t JOIN {{1}} i ON i.tid = t.tid LEFT JOIN {{2}} c ON c.tid = t.tid LEFT JOIN {{3}} p ON p.tid = t.tid"
ORACLES["finalise_geneset"] = stage(_finalised, FINAL)
ORACLES["finalise_geneset_by_source"] = stage(lambda z: _finalised(z, True), FINAL)
