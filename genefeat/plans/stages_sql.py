"""The gene-set stages in SQL, for DuckDB: each method adds common table expressions and returns the name of its result.

Models are a pair of tables: t (tid, gene_id, seq_region, strand, source, biotype, s, e, cs, ce) and x (tid, s, e)."""

from __future__ import annotations

from .fixtures import CONTIGS, TRANSCRIPTS, TX_EXONS

COLUMNS = "tid, gene_id, seq_region, strand, source, biotype, s, e, cs, ce"


class Stages:
    def __init__(self):
        self.parts: list[str] = []
        self.n = 0

    def put(self, sql: str, head: str = "") -> str:
        self.n += 1
        name = f"q{self.n}"
        self.parts.append(f"{name}{head} AS MATERIALIZED ({sql.replace('@', name)})" if "@" not in sql else f"{name}{head} AS ({sql.replace('@', name)})")
        return name

    def text(self, select: str) -> str:
        return "WITH RECURSIVE " + ", ".join(self.parts) + " " + select

    def models(self, where: str = "true", text_ids: bool = False) -> tuple[str, str]:
        x = self.put(TX_EXONS)
        t = self.put(TRANSCRIPTS.replace("tx_exons", x))
        tid = "CAST(transcript_id AS VARCHAR)" if text_ids else "transcript_id"
        t = self.put(f"SELECT {tid} AS tid, gene_id, seq_region, strand, source, biotype, s, e, cs, ce FROM {t} WHERE {where}")
        return t, self.put(f"SELECT {tid} AS tid, s, e FROM {x} WHERE {tid} IN (SELECT tid FROM {t})")

    def of(self, t: str, x: str) -> str:
        """x of the models in t alone."""
        return self.put(f"SELECT * FROM {x} WHERE tid IN (SELECT tid FROM {t})")

    def cds(self, t: str, x: str) -> str:
        return self.put(f"SELECT t.tid, t.seq_region, t.strand, greatest(x.s, t.cs) AS s, least(x.e, t.ce) AS e FROM {x} x JOIN {t} t ON x.tid = t.tid WHERE x.s <= t.ce AND x.e >= t.cs")

    def lengths(self, t: str, x: str) -> str:
        """(tid, n, len, n_cds, cds_len)."""
        c = self.cds(t, x)
        return self.put(f"SELECT t.tid, n, len, coalesce(n_cds, 0) AS n_cds, coalesce(cds_len, 0) AS cds_len FROM {t} t JOIN (SELECT tid, count(*) AS n, sum(e - s + 1) AS len FROM {x} GROUP BY 1) a ON a.tid = t.tid LEFT JOIN (SELECT tid, count(*) AS n_cds, sum(e - s + 1) AS cds_len FROM {c} GROUP BY 1) b ON b.tid = t.tid")

    def clusters(self, t: str, x: str) -> str:
        """(tid, cluster, size): by overlap of coding exons on a strand."""
        c = self.cds(t, x)
        pairs = self.put(f"SELECT DISTINCT a.tid AS x, b.tid AS y FROM {c} a JOIN {c} b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s")
        reach = self.put(f"SELECT x AS n, y AS m FROM {pairs} UNION SELECT @.n, p.y FROM @ JOIN {pairs} p ON @.m = p.x")
        named = self.put(f"SELECT t.tid, coalesce(l, t.tid) AS cluster FROM {t} t LEFT JOIN (SELECT n, min(m) AS l FROM {reach} GROUP BY 1) r ON r.n = t.tid")
        return self.put(f"SELECT *, count(*) OVER (PARTITION BY cluster) AS size FROM {named}")

    def span_clusters(self, t: str) -> str:
        return self.put(f"SELECT tid, concat_ws(':', seq_region, strand, max(CASE WHEN p IS NULL OR s > p THEN s END) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS cluster FROM (SELECT *, max(e) OVER (PARTITION BY seq_region, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {t})")

    def introns(self, x: str) -> str:
        """(tid, s, a, b): the gap after each exon, null after the last."""
        return self.put(f"SELECT tid, s, e + 1 AS a, lead(s) OVER (PARTITION BY tid ORDER BY s, e) - 1 AS b FROM {x}")

    def collapse(self, t: str, x: str, coding: bool = True, top: int = 100) -> str:
        short = self.put(f"SELECT * FROM {t} WHERE tid NOT IN (SELECT tid FROM {x} WHERE e - s + 1 > 50000)")
        named = self.clusters(short, x) if coding else self.span_clusters(short)
        chains = self.put(f"SELECT tid, string_agg(concat(a, '..', b, ':'), '' ORDER BY a) AS chain FROM {self.introns(x)} WHERE b IS NOT NULL GROUP BY 1")
        told = self.put(f"SELECT t.*, cluster, cds_len, coalesce(chain, concat(t.s, ':', t.e)) AS chain FROM {short} t JOIN {named} c ON c.tid = t.tid JOIN {self.lengths(short, x)} l ON l.tid = t.tid LEFT JOIN {chains} i ON i.tid = t.tid")
        one = self.put(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster, chain ORDER BY s - e, tid) AS k FROM {told}) WHERE k = 1")
        return self.put(f"SELECT tid, CAST(cluster AS VARCHAR) AS gene_id, seq_region, strand, source, biotype, s, e, cs, ce FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY -cds_len, tid) AS j FROM {one}) WHERE j <= {top}")

    def without_overlapping_exons(self, t: str, x: str) -> str:
        return self.put(f"SELECT * FROM {t} WHERE tid NOT IN (SELECT tid FROM {self.introns(x)} WHERE b + 1 < a)")

    def select_best(self, t: str, x: str) -> str:
        """(tid, class) of models whose CDS is settled: scores, sub-chains, classes, and the good ones collapsed."""
        lengths = self.lengths(t, x)
        good = self.put(f"SELECT t.* FROM {t} t JOIN {lengths} l ON l.tid = t.tid WHERE n_cds > 0 AND ((n_cds = 1 AND cds_len >= 450) OR cds_len >= 300)")
        named = self.clusters(good, x)
        gaps = self.introns(self.cds(good, x))
        chains = self.put(f"SELECT g.tid, coalesce(string_agg(concat(a, '..', b, ':'), '' ORDER BY a) FILTER (b IS NOT NULL), '') AS chain FROM {good} g LEFT JOIN {gaps} i ON i.tid = g.tid GROUP BY 1")
        told = self.put(f"SELECT n.tid, cluster, size, chain, n_cds, cds_len FROM {named} n JOIN {chains} c ON c.tid = n.tid JOIN {lengths} l ON l.tid = n.tid")
        sub = self.put(f"SELECT *, chain <> '' AND EXISTS (SELECT 1 FROM {told} o WHERE o.cluster = q.cluster AND o.chain <> q.chain AND contains(o.chain, q.chain)) AS sub FROM {told} q")
        kept = self.put(f"SELECT tid FROM (SELECT *, max(n_cds) FILTER (NOT sub) OVER (PARTITION BY cluster) AS mn, max(cds_len) FILTER (NOT sub) OVER (PARTITION BY cluster) AS ml FROM {sub}) WHERE size = 1 OR (NOT sub AND NOT coalesce(n_cds < 0.75 * mn AND cds_len < 0.75 * ml, false))")
        classed = self.put(f"SELECT tid, CASE WHEN tid IN (SELECT tid FROM {kept}) THEN 'good' WHEN bool_or(tid IN (SELECT tid FROM {kept})) OVER (PARTITION BY cluster) THEN 'ignore' ELSE 'check' END AS class FROM {self.clusters(t, x)}")
        best = self.collapse(self.put(f"SELECT * FROM {t} WHERE tid IN (SELECT tid FROM {classed} WHERE class = 'good')"), x)
        return self.put(f"SELECT tid, 'good' AS class FROM {best} UNION ALL SELECT tid, class FROM {classed} WHERE class <> 'good'")

    def canonical(self, t: str, x: str, by: str) -> str:
        """(by, head) of t joined with a column to group by."""
        return self.put(f"SELECT {by}, arg_min(t.tid, row(cs IS NULL, -(cds_len // 3), -len, t.tid)) AS head FROM {t} t JOIN {self.lengths(t, x)} l ON l.tid = t.tid GROUP BY 1")

    def augment(self, up: str, low: str, x: str, most: float) -> str:
        """Models of low that are added to up."""
        def spans(t):
            named = self.put(f"SELECT t.*, cluster FROM {t} t JOIN {self.clusters(t, x)} c ON c.tid = t.tid")
            heads = self.canonical(named, x, "cluster")
            return named, self.put(f"SELECT n.cluster, min(seq_region) AS seq_region, min(strand) AS strand, min(s) AS s, max(e) AS e, min(head) AS head FROM {named} n JOIN {heads} h ON h.cluster = n.cluster GROUP BY 1")

        _, a = spans(up)
        low_named, b = spans(low)
        pairs = self.put(f"SELECT a.head AS u, b.head AS c, b.cluster FROM {a} a JOIN {b} b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s")
        heads = self.put(f"SELECT * FROM {up} WHERE tid IN (SELECT head FROM {a})")
        shared = self.put(f"SELECT a.tid AS u, b.tid AS c, sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) AS n FROM {self.cds(heads, x)} a JOIN {self.cds(low, x)} b ON a.seq_region = b.seq_region AND a.strand = b.strand AND a.s <= b.e AND a.e >= b.s GROUP BY 1, 2")
        met = self.put(f"SELECT DISTINCT u, cluster FROM {shared} v JOIN {low_named} l ON l.tid = v.c")
        return self.put(f"SELECT * FROM {low} WHERE tid IN (SELECT p.c FROM {pairs} p LEFT JOIN {met} m ON m.u = p.u AND m.cluster = p.cluster LEFT JOIN {shared} v ON v.u = p.u AND v.c = p.c JOIN {self.lengths(low, x)} l ON l.tid = p.c WHERE m.u IS NULL OR coalesce(v.n, 0) <= {most} * l.cds_len)")

    def finalise_layers(self, t: str, x: str) -> tuple[str, str]:
        by = {s: self.put(f"SELECT * FROM {t} WHERE source = '{s}'") for s in ("transcriptomic", "busco", "protein")}
        tr, bu, pr = by.values()
        added = [(self.augment(tr, bu, x, 0.9), "b", "transcriptomic"), (self.augment(tr, pr, x, 0.8), "p", "transcriptomic"), (self.augment(bu, pr, x, 0.8), "q", "busco")]
        more = "".join(f" UNION ALL SELECT concat(tid, '_{k}') AS tid, gene_id, seq_region, strand, '{s}' AS source, biotype, s, e, cs, ce FROM {a}" for a, k, s in added)
        every = self.put(f"SELECT {COLUMNS} FROM {t} WHERE source IN ('transcriptomic', 'busco', 'protein'){more}")
        wide = self.put(f"SELECT * FROM {x}" + "".join(f" UNION ALL SELECT concat(tid, '_{k}') AS tid, s, e FROM {x} WHERE tid IN (SELECT tid FROM {a})" for a, k, _ in added))
        ranked = self.put(f"SELECT t.*, cluster, CASE source WHEN 'transcriptomic' THEN 1 WHEN 'busco' THEN 2 ELSE 3 END AS r FROM {every} t JOIN {self.clusters(every, wide)} c ON c.tid = t.tid")
        layered = self.put(f"SELECT {COLUMNS} FROM (SELECT *, min(r) OVER (PARTITION BY cluster) AS b FROM {ranked}) WHERE r = b")
        return self.collapse(layered, wide), wide

    def drop_lncrna(self, t: str, stranded: bool) -> str:
        same = "AND a.strand = b.strand " if stranded else ""
        return self.put(f"SELECT * FROM {t} a WHERE biotype = 'protein_coding' OR NOT EXISTS (SELECT 1 FROM {t} b WHERE b.biotype = 'protein_coding' AND a.seq_region = b.seq_region {same}AND a.s <= b.e AND a.e >= b.s)")

    def renumber(self, t: str, x: str) -> tuple[str, str]:
        genes = self.put(f"SELECT seq_region, gene_id, row_number() OVER (ORDER BY seq_region, min(s), max(e), gene_id) AS g FROM {t} GROUP BY 1, 2")
        ids = self.put(f"SELECT t.tid AS old, concat('gene', g) AS gene, concat('gene', g, '.t', row_number() OVER (PARTITION BY t.seq_region, t.gene_id ORDER BY t.s, t.e, t.tid)) AS new FROM {t} t JOIN {genes} g ON g.seq_region = t.seq_region AND g.gene_id = t.gene_id")
        return self.put(f"SELECT new AS tid, gene AS gene_id, seq_region, strand, source, biotype, s, e, cs, ce FROM {t} t JOIN {ids} i ON i.old = t.tid"), self.put(f"SELECT new AS tid, s, e FROM {x} x JOIN {ids} i ON i.old = x.tid")

    def clean_geneset(self, t: str, x: str) -> tuple[str, str]:
        codes, rest = (self.put(f"SELECT * FROM {t} WHERE cs IS {k} NULL") for k in ("NOT", ""))
        both = self.put(f"SELECT * FROM {self.collapse(codes, x)} UNION ALL SELECT * FROM {self.collapse(rest, x, coding=False)}")
        named, x = self.renumber(both, x)
        typed = self.put(f"SELECT * REPLACE (CASE WHEN cs IS NULL THEN 'lncRNA' ELSE 'protein_coding' END AS biotype), bool_or(cs IS NOT NULL) OVER (PARTITION BY gene_id) AS codes FROM {named}")
        kept = self.drop_lncrna(typed, True)
        lnc = self.put(f"SELECT {COLUMNS} FROM {kept} WHERE biotype = 'lncRNA'")
        collapsed = self.collapse(lnc, x, coding=False)
        every = self.put(f"SELECT {COLUMNS}, codes FROM {kept} WHERE biotype <> 'lncRNA' UNION ALL SELECT c.*, k.codes FROM {collapsed} c JOIN {kept} k ON k.tid = c.tid")
        coding = self.put(f"SELECT {COLUMNS} FROM {every} WHERE codes")
        exons = self.put(f"SELECT DISTINCT gene_id, c.s, c.e FROM {self.cds(coding, x)} c JOIN {coding} t ON t.tid = c.tid")
        bad = self.put(f"SELECT DISTINCT tid FROM (SELECT i.tid, i.s, count(*) AS n FROM {self.introns(x)} i JOIN {coding} t ON t.tid = i.tid JOIN {exons} d ON d.gene_id = t.gene_id AND i.a <= d.e AND i.b >= d.s WHERE i.b IS NOT NULL GROUP BY 1, 2) WHERE n > 3")
        left = self.put(f"SELECT * FROM {coding} WHERE tid NOT IN (SELECT tid FROM {bad})")
        none = self.put(f"SELECT * FROM {coding} WHERE gene_id NOT IN (SELECT gene_id FROM {left})")
        heads = self.canonical(none, x, "gene_id")
        return self.put(f"SELECT * FROM {left} UNION ALL SELECT * FROM {none} WHERE tid IN (SELECT head FROM {heads}) UNION ALL SELECT {COLUMNS} FROM {every} WHERE NOT codes"), x

    def spans(self, t: str, x: str) -> str:
        """t with s and e as its exons in x have them; models without exons go."""
        return self.put(f"SELECT t.* REPLACE (n.s AS s, n.e AS e) FROM {t} t JOIN (SELECT tid, min(s) AS s, max(e) AS e FROM {x} GROUP BY 1) n ON n.tid = t.tid")

    def utr_off_neighbours(self, t: str, x: str) -> tuple[str, str]:
        genes = self.put(f"SELECT gene_id, min(seq_region) AS seq_region, min(strand) AS strand, min(cs) AS lo, max(ce) AS hi FROM {t} WHERE cs IS NOT NULL GROUP BY 1")
        left = self.put(f"SELECT x.* FROM {x} x JOIN {t} t ON t.tid = x.tid WHERE NOT (t.cs IS NOT NULL AND (x.e < t.cs OR x.s > t.ce) AND EXISTS (SELECT 1 FROM {genes} g WHERE g.gene_id <> t.gene_id AND g.seq_region = t.seq_region AND g.strand = t.strand AND x.s <= g.hi AND x.e >= g.lo))")
        return self.spans(t, left), left

    def oriented(self, t: str, x: str) -> str:
        minus = "t.strand = '-'"
        return self.put(f"SELECT x.tid, t.strand, CASE WHEN {minus} THEN -x.e ELSE x.s END AS os, CASE WHEN {minus} THEN -x.s ELSE x.e END AS oe, CASE WHEN {minus} THEN -t.ce ELSE t.cs END AS a, CASE WHEN {minus} THEN -t.cs ELSE t.ce END AS z FROM {x} x JOIN {t} t ON t.tid = x.tid")

    def back(self, t: str, oriented: str) -> tuple[str, str]:
        x = self.put(f"SELECT tid, CASE WHEN strand = '-' THEN -oe ELSE os END AS s, CASE WHEN strand = '-' THEN -os ELSE oe END AS e FROM {oriented}")
        return self.spans(t, x), x

    def trim_three(self, t: str, x: str, most: int = 1000) -> tuple[str, str]:
        o = self.oriented(t, x)
        ends = self.put(f"SELECT tid, max(CASE WHEN os <= z THEN oe END) AS le, min(CASE WHEN os > z THEN os END) AS ns, coalesce(max(oe) > min(z), false) AS has FROM {o} GROUP BY 1")
        told = self.put(f"SELECT o.*, le, has, ns, CASE WHEN le > o.z THEN le - o.z ELSE ne - ns + 1 END < {most} AND ne - ns + 1 >= 100 AND ns - le + 1 >= 250 AS keep FROM {o} o JOIN {ends} l ON o.tid = l.tid LEFT JOIN (SELECT tid AS nt, os AS ms, oe AS ne FROM {o}) n ON nt = o.tid AND ms = ns")
        kept = self.put(f"SELECT *, row_number() OVER (PARTITION BY tid ORDER BY os DESC) AS r FROM {told} WHERE NOT has OR os <= z OR (coalesce(keep, false) AND os = ns)")
        return self.back(t, self.put(f"SELECT tid, strand, os, CASE WHEN has AND r = 1 THEN oe - greatest(oe - os + 1 - CASE WHEN os <= z THEN z - os ELSE 0 END - {most}, 0) ELSE oe END AS oe FROM {kept}"))

    def trim_five(self, t: str, x: str) -> tuple[str, str]:
        o = self.oriented(t, x)
        first = self.put(f"SELECT tid, min(CASE WHEN oe >= a AND os <= z THEN os END) AS c1, coalesce(min(os) < min(a), false) AS has FROM {o} GROUP BY 1")
        side = self.put(f"SELECT o.*, has, c1, CASE WHEN oe >= a THEN a - os + 1 ELSE oe - os + 1 END AS u FROM {o} o JOIN {first} f ON o.tid = f.tid WHERE NOT has OR os >= a OR oe >= a OR oe - os + 1 > 100")
        run = self.put(f"SELECT *, (has AND (oe < a OR os = c1)) AS side, sum(CASE WHEN has AND (oe < a OR os = c1) THEN u END) OVER (PARTITION BY tid ORDER BY os DESC) AS c FROM {side}")
        over = self.put(f"SELECT *, c - 300 AS o, max(CASE WHEN side AND c > 300 THEN os END) OVER (PARTITION BY tid) AS stop FROM {run}")
        return self.back(t, self.put(f"SELECT tid, strand, CASE WHEN side AND os = stop AND u - o >= 50 THEN os + o ELSE os END AS os, oe FROM {over} WHERE NOT side OR stop IS NULL OR os > stop OR (os = stop AND (u - o >= 50 OR oe >= a))"))

    def clean_utrs(self, t: str, x: str) -> tuple[str, str]:
        codes = self.put(f"SELECT * FROM {t} WHERE biotype = 'protein_coding'")
        a, ax = self.trim_five(*self.trim_three(*self.utr_off_neighbours(codes, self.of(codes, x))))
        every = self.put(f"SELECT {COLUMNS} FROM {a} UNION ALL SELECT {COLUMNS} FROM {t} WHERE biotype IS DISTINCT FROM 'protein_coding'")
        exons = self.put(f"SELECT tid, s, e FROM {ax} UNION ALL SELECT tid, s, e FROM {x} WHERE tid IN (SELECT tid FROM {t} WHERE biotype IS DISTINCT FROM 'protein_coding')")
        return self.drop_lncrna(every, False), exons

    def genome(self, t: str, x: str) -> tuple[str, str, str]:
        """(pieces (k, seq) of the contigs' bases, regions (seq_region, r), one row (each, pieces))."""
        bases = self.put(f"SELECT string_agg(seq, '' ORDER BY doc_id, seq) AS g FROM ({CONTIGS.format(g=chr(44) + ' ' + chr(39) + 'g' + chr(39))}) WHERE length(seq) > 0")
        pieces = self.put(f"SELECT k, rpad(substr(g, k * 1000 + 1, 1000), 1000, 'N') AS seq FROM (SELECT g, unnest(range((length(g) + 999) // 1000)) AS k FROM {bases})")
        regions = self.put(f"SELECT seq_region, row_number() OVER (ORDER BY seq_region) AS r, max(e) AS n FROM {t} GROUP BY 1")
        size = self.put(f"SELECT greatest((SELECT max(n) FROM {regions}) // 1000 + 1, ((SELECT count(*) FROM {pieces}) + (SELECT count(*) FROM {regions}) - 1) // (SELECT count(*) FROM {regions})) AS each, (SELECT count(*) FROM {pieces}) AS pieces")
        return pieces, regions, size

    def sequences(self, genome: tuple[str, str, str], t: str, x: str) -> str:
        """(tid, seq) of exons in transcript direction."""
        pieces, regions, size = genome
        cut = self.put(f"SELECT x.tid, t.strand, x.s, x.e, r, unnest(range(CAST((x.s - 1) // 1000 AS BIGINT), CAST((x.e - 1) // 1000 + 1 AS BIGINT))) AS i FROM {x} x JOIN {t} t ON t.tid = x.tid JOIN {regions} g ON g.seq_region = t.seq_region")
        parts = self.put(f"SELECT c.tid, c.strand, c.s, c.e, i, substr(p.seq, CAST(greatest(c.s - i * 1000, 1) AS BIGINT), CAST(least(c.e, (i + 1) * 1000) - greatest(c.s, i * 1000 + 1) + 1 AS BIGINT)) AS q FROM {cut} c, {size} z JOIN {pieces} p ON p.k = ((c.r - 1) * z.each + c.i) % z.pieces WHERE i < z.each")
        return self.put(f"SELECT tid, CASE WHEN min(strand) = '-' THEN reverse(translate(q, 'ACGTacgt', 'TGCAtgca')) ELSE q END AS seq FROM (SELECT tid, min(strand) AS strand, string_agg(q, '' ORDER BY s, e, i) AS q FROM {parts} GROUP BY 1) GROUP BY tid, q")

    def translations(self, seqs: str, least: int) -> str:
        """(tid, first, last, met): the best translation's place in the sequence."""
        from .oracles import AA

        frames = self.put(f"SELECT tid, f, string_split(array_to_string(list_transform(regexp_extract_all(substr(seq, f + 1), '...'), lambda c: CASE WHEN regexp_full_match(c, '[ACGT]{{3}}') THEN {AA} ELSE 'X' END), ''), '*') AS p FROM {seqs}, range(3) r(f)")
        runs = self.put(f"SELECT tid, f, x, i, n, coalesce(sum(length(x) + 1) OVER (PARTITION BY tid, f ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p0 FROM (SELECT tid, f, unnest(p) AS x, generate_subscripts(p, 1) AS i, len(p) AS n FROM {frames})")
        met = self.put(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY k DESC, a) AS r FROM (SELECT tid, (p0 + instr(x, 'M') - 1) * 3 + f + 1 AS a, (p0 + length(x) + 1) * 3 + f AS b, length(x) - instr(x, 'M') + 1 AS k FROM {runs} WHERE i < n AND instr(x, 'M') > 0)) WHERE r = 1")
        free = self.put(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY k DESC, a) AS r FROM (SELECT tid, p0 * 3 + f + 1 AS a, (p0 + length(x)) * 3 + f AS b, length(x) AS k FROM {runs} WHERE length(x) > 0)) WHERE r = 1")
        both = self.put(f"SELECT s.tid, coalesce(m.k, 0) < 100 AND coalesce(o.k, 0) > 2 * coalesce(m.k, 0) AS open, m.a AS a1, m.b AS b1, m.k AS k1, o.a AS a2, o.b AS b2, o.k AS k2 FROM {seqs} s LEFT JOIN {met} m ON m.tid = s.tid LEFT JOIN {free} o ON o.tid = s.tid")
        return self.put(f"SELECT tid, CAST(CASE WHEN open THEN a2 ELSE a1 END AS BIGINT) AS first, CAST(CASE WHEN open THEN b2 ELSE b1 END AS BIGINT) AS last, NOT open AS met FROM {both} WHERE CASE WHEN open THEN k2 ELSE k1 END >= {least}")

    def coding_sequences(self, genome, t: str, x: str) -> str:
        c = self.cds(t, x)
        return self.sequences(genome, t, self.put(f"SELECT tid, s, e FROM {c}"))

    def merged_introns(self, x: str, least: int = 75) -> str:
        """x with introns under `least` closed, of the models where that changes anything."""
        ends = self.put(f"SELECT *, max(e) OVER (PARTITION BY tid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {x}")
        blocks = self.put(f"SELECT *, sum(CASE WHEN p IS NULL OR s - p - 1 >= {least} THEN 1 ELSE 0 END) OVER (PARTITION BY tid ORDER BY s, e) AS b FROM {ends}")
        made = self.put(f"SELECT tid, min(s) AS s, max(e) AS e FROM {blocks} GROUP BY tid, b")
        return self.put(f"SELECT * FROM {made} WHERE tid IN (SELECT a.tid FROM (SELECT tid, count(*) AS n FROM {made} GROUP BY 1) a JOIN (SELECT tid, count(*) AS n FROM {x} GROUP BY 1) b ON a.tid = b.tid WHERE a.n < b.n)")

    def clean(self, genome, t: str, x: str, multi: int = 300, single: int = 450) -> tuple[str, str, str]:
        """(models with a valid CDS, merged variants besides under tid_m, exons, (tid, merged, n, cds length))."""
        whole = self.coding_sequences(genome, t, x)
        made = self.merged_introns(x)
        changed = self.coding_sequences(genome, self.put(f"SELECT * FROM {t} WHERE tid IN (SELECT tid FROM {made})"), made)
        told = self.put(f"SELECT w.tid, false AS merged, w.seq, n FROM {whole} w JOIN (SELECT tid, count(*) AS n FROM {x} GROUP BY 1) c ON c.tid = w.tid UNION ALL SELECT m.tid, true, m.seq, n FROM {changed} m JOIN (SELECT tid, count(*) AS n FROM {made} GROUP BY 1) c ON c.tid = m.tid JOIN {whole} w ON w.tid = m.tid WHERE length(m.seq) >= length(w.seq)")
        kept = self.put(f"SELECT tid, merged, n, length(seq) AS cds_length FROM {told} WHERE seq LIKE 'ATG%' AND right(seq, 3) IN ('TAA', 'TAG', 'TGA') AND length(seq) >= CASE WHEN n > 1 THEN {multi} ELSE {single} END")
        named = "CASE WHEN merged THEN concat(k.tid, '_m') ELSE CAST(k.tid AS VARCHAR) END"
        models = self.put(f"SELECT t.* REPLACE ({named} AS tid) FROM {t} t JOIN {kept} k ON k.tid = t.tid")
        exons = self.put(f"SELECT {named} AS tid, s, e FROM {x} x JOIN {kept} k ON k.tid = x.tid WHERE NOT merged UNION ALL SELECT {named} AS tid, s, e FROM {made} x JOIN {kept} k ON k.tid = x.tid WHERE merged")
        return models, exons, kept

    def cut_at_signal(self, genome, t: str, x: str) -> tuple[str, str]:
        """The last exon, in transcript direction, cut at its polyadenylation site, where it has UTR."""
        o = self.oriented(t, x)
        last = self.put(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY os DESC) AS r FROM {o}) WHERE r = 1 AND z IS NOT NULL AND oe > z")
        seqs = self.sequences(genome, t, self.put(f"SELECT tid, CASE WHEN strand = '-' THEN -oe ELSE os END AS s, CASE WHEN strand = '-' THEN -os ELSE oe END AS e FROM {last}"))
        told = self.put(f"SELECT l.tid, seq, CASE WHEN os <= z THEN z - os + 1 ELSE 0 END AS c FROM {last} l JOIN {seqs} q ON q.tid = l.tid")
        sites = self.put(f"SELECT *, instr(substr(seq, CAST(c + 1 AS BIGINT)), 'AATAAA') AS g FROM {told}")
        near = self.put(f"SELECT *, instr(substr(seq, CAST(c + g + 20 AS BIGINT), 15), 'CA') AS h FROM {sites}")
        cuts = self.put(f"SELECT tid, c, seq, CASE WHEN g > 0 AND h > 0 THEN c + g + 20 + h WHEN g > 0 THEN c + g + 35 WHEN length(seq) - c > 1000 THEN c + 1000 END AS cut FROM {near}")
        moved = self.put(f"SELECT o.tid, o.strand, o.os, CASE WHEN k.tid IS NOT NULL THEN o.os + cut - 1 ELSE o.oe END AS oe FROM {o} o LEFT JOIN {last} l ON l.tid = o.tid AND l.os = o.os AND l.oe = o.oe LEFT JOIN (SELECT * FROM {cuts} WHERE cut < length(seq) AND cut > c) k ON k.tid = l.tid")
        return self.back(t, moved)

    def pieces_of_utr(self, t: str, x: str) -> str:
        """(tid, side, s, e): UTR exons; side utr5 or utr3."""
        left = f"SELECT t.tid, CASE WHEN strand = '-' THEN 'utr3' ELSE 'utr5' END AS side, x.s, least(x.e, cs - 1) AS e FROM {x} x JOIN {t} t ON t.tid = x.tid WHERE cs IS NOT NULL AND x.s < cs"
        return self.put(f"{left} UNION ALL SELECT t.tid, CASE WHEN strand = '-' THEN 'utr5' ELSE 'utr3' END, greatest(x.s, ce + 1), x.e FROM {x} x JOIN {t} t ON t.tid = x.tid WHERE cs IS NOT NULL AND x.e > ce")

    def exon_strings(self, t: str, x: str) -> str:
        return self.put(f"SELECT t.tid, concat(min(seq_region), '|', string_agg(concat(x.s, ':', x.e, ':', CASE WHEN strand = '-' THEN '-1' ELSE '1' END), ':' ORDER BY CASE WHEN strand = '-' THEN -x.s ELSE x.s END, x.e)) AS k FROM {x} x JOIN {t} t ON t.tid = x.tid GROUP BY 1")

    def utr_search(self, genome, t: str, x: str, rounds: int, least: int = 50, min_utr: int = 500, multi: int = 300, single: int = 450) -> list[tuple[str, str]]:
        """(models, exons) of each round from 0; the last must be empty for the search to be whole."""
        keys = self.exon_strings(t, x)
        first = self.put(f"SELECT t.* FROM {t} t JOIN (SELECT min(tid) AS tid FROM {keys} GROUP BY k) o ON o.tid = t.tid")
        out = [(first, self.of(first, x))]
        seen = [self.put(f"SELECT k FROM {keys}")]
        for _ in range(rounds):
            nt, nx = out[-1]
            utr = self.pieces_of_utr(nt, nx)
            wide = self.put(f"SELECT tid, side, concat(tid, '_', side) AS new FROM {utr} GROUP BY 1, 2 HAVING count(*) >= 2 AND sum(e - s + 1) - 100 >= {min_utr} AND sum(e - s + 1) >= {single + 50}")
            fx = self.put(f"SELECT new AS tid, s, e FROM {utr} u JOIN {wide} w ON w.tid = u.tid AND w.side = u.side")
            ft = self.put(f"SELECT w.new AS tid, gene_id, seq_region, strand, source, biotype, (SELECT min(s) FROM {fx} f WHERE f.tid = w.new) AS s, (SELECT max(e) FROM {fx} f WHERE f.tid = w.new) AS e, CAST(NULL AS BIGINT) AS cs, CAST(NULL AS BIGINT) AS ce FROM {nt} t JOIN {wide} w ON w.tid = t.tid")
            keys = self.exon_strings(ft, fx)
            fresh = self.put(f"SELECT min(tid) AS tid, k FROM {keys} WHERE " + " AND ".join(f"k NOT IN (SELECT k FROM {q})" for q in seen) + " GROUP BY k")
            ft = self.put(f"SELECT * FROM {ft} WHERE tid IN (SELECT tid FROM {fresh})")
            told, cds = self.translated(genome, ft, self.of(ft, fx), least)
            good = self.put(f"SELECT t.* FROM {told} t JOIN {cds} c ON c.tid = t.tid WHERE seq LIKE 'ATG%' AND right(seq, 3) IN ('TAA', 'TAG', 'TGA') AND length(seq) >= CASE WHEN (SELECT count(*) FROM {fx} f WHERE f.tid = t.tid) > 1 THEN {multi} ELSE {single} END")
            out.append((good, self.of(good, fx)))
            seen.append(self.put(f"SELECT k FROM {fresh} WHERE tid IN (SELECT tid FROM {good})"))
        return out

    def join_transcripts(self, t: str, x: str, rounds: int) -> list[str]:
        """(tid, seq_region, ex: exons as a list of structs) of each round's joins."""
        lists = f"SELECT CAST(x.tid AS VARCHAR) AS tid, t.seq_region, list({{'s': x.s, 'e': x.e}} ORDER BY x.s, x.e) AS ex FROM {x} x JOIN {t} t ON t.tid = x.tid GROUP BY x.tid, t.seq_region"
        key = "concat(seq_region, '|', array_to_string(list_transform(ex, lambda q: concat(q.s, ':', q.e, ':1')), ':'))"
        total = "list_sum(list_transform(ex, lambda q: q.e - q.s + 1))"
        pools = [self.put(f"SELECT *, {key} AS k FROM ({lists})")]
        now = self.put(f"SELECT p.* FROM {pools[0]} p JOIN (SELECT min(tid) AS tid FROM {pools[0]} GROUP BY k) o ON o.tid = p.tid")
        out = []
        for n in range(1, rounds + 1):
            pool = self.put(" UNION ALL ".join(f"SELECT * FROM {p}" for p in pools))
            pairs = self.put(f"SELECT a.tid, a.seq_region, a.ex AS a, b.ex AS b, b.tid AS other FROM {now} a JOIN {pool} b ON a.seq_region = b.seq_region AND a.tid <> b.tid AND a.ex[1].s <= b.ex[-1].e AND a.ex[-1].e >= b.ex[1].s")
            ends = self.put(f"SELECT *, list_filter(b, lambda q: q.s <= a[1].s AND q.e >= a[1].s)[1] AS f, list_filter(b, lambda q: q.s <= a[-1].e AND q.e >= a[-1].e)[-1] AS l FROM {pairs}")
            told = self.put(f"SELECT *, coalesce(f.s, a[1].s) AS lo, coalesce(l.e, a[-1].e) AS hi FROM {ends} WHERE f IS NOT NULL OR l IS NOT NULL")
            own = "CASE WHEN len(a) = 1 THEN [{'s': lo, 'e': hi}] ELSE list_concat(list_concat([{'s': lo, 'e': a[1].e}], a[2:len(a) - 1]), [{'s': a[-1].s, 'e': hi}]) END"
            before = "CASE WHEN f IS NULL THEN [] ELSE list_filter(b, lambda q: q.e < a[1].s AND q.e < lo) END"
            after = "CASE WHEN l IS NULL THEN [] ELSE list_filter(b, lambda q: q.s > a[-1].e AND q.s > hi) END"
            made = self.put(f"SELECT *, {key} AS k, {total} AS n FROM (SELECT tid, seq_region, other, list_concat(list_concat({before}, {own}), {after}) AS ex, a, b FROM {told}) WHERE ex <> a AND ex <> b")
            best = self.put(f"SELECT *, row_number() OVER (PARTITION BY tid ORDER BY n DESC, k, other) AS i, row_number() OVER (PARTITION BY tid ORDER BY len(ex) DESC, n DESC, k, other) AS j FROM {made}")
            one = self.put(f"SELECT *, row_number() OVER (PARTITION BY k ORDER BY tid, i) AS r FROM {best} WHERE i = 1 OR j = 1")
            now = self.put(f"SELECT concat(tid, '_j{n}', CASE WHEN i = 1 THEN 'l' ELSE 'e' END) AS tid, seq_region, ex, k FROM {one} WHERE r = 1 AND k NOT IN (SELECT k FROM {pool})")
            pools.append(now)
            out.append(now)
        return out

    def translated(self, genome, t: str, x: str, least: int) -> tuple[str, str]:
        """(t with the CDS of its best translation, (tid, seq) of the CDS)."""
        seqs = self.sequences(genome, t, x)
        best = self.translations(seqs, least)
        run = self.put(f"SELECT x.tid, strand, x.s, x.e, sum(x.e - x.s + 1) OVER (PARTITION BY x.tid ORDER BY CASE WHEN strand = '-' THEN -x.e ELSE x.s END) AS z FROM {x} x JOIN {t} t ON t.tid = x.tid")
        at = self.put(f"SELECT r.tid, CASE WHEN strand = '-' THEN r.e - (p - (z - (r.e - r.s))) ELSE r.s + (p - (z - (r.e - r.s))) END AS g FROM {run} r JOIN (SELECT tid, unnest([first, last]) AS p FROM {best}) q ON q.tid = r.tid AND p <= z AND p >= z - (r.e - r.s)")
        ends = self.put(f"SELECT tid, min(g) AS cs, max(g) AS ce FROM {at} GROUP BY 1")
        return self.put(f"SELECT t.* REPLACE (n.cs AS cs, n.ce AS ce) FROM {t} t LEFT JOIN {ends} n ON n.tid = t.tid"), self.put(f"SELECT b.tid, substr(seq, first, last - first + 1) AS seq FROM {best} b JOIN {seqs} s ON s.tid = b.tid")


def stage(build, select: str) -> str:
    """SQL of what build(Stages) puts; select is formatted with the names it returns."""
    stages = Stages()
    names = build(stages)
    return stages.text(select.format(*(names if isinstance(names, tuple) else (names,))))
