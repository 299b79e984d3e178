"""SQL for DuckDB that gives the rows of this subpackage's queries, where SQL can say them."""

from __future__ import annotations

from . import licenses, rules
from .secrets import ACCESS, ASSIGN, HEX, OPAQUE

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str, lower: bool = True) -> str:
    text = f"translate({text}, '{UP}', '{LOW}')" if lower else text
    return rf"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def shingles(w: str, k: str) -> str:
    """Distinct k-word shingles of a list of words, as strings."""
    return f"list_distinct(list_transform(range(1, len({w}) - {k} + 2), lambda i: array_to_string({w}[i:i + {k} - 1], ' ')))"


def spans(kind: int, pattern: str, group: int = 0, least: int = 0) -> str:
    """Rows (doc_id, source, lang, lang, kind, s, e, v) of a pattern's matches; the gaps between matches give their places."""
    return f"""SELECT doc_id, source, lang, {kind} AS kind, p AS s, p + length(m) AS e, v FROM (
      SELECT doc_id, source, lang, m, v, sum(length(g)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM (
        SELECT doc_id, source, lang, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[:len(ms)]) AS g, generate_subscripts(ms, 1) AS i FROM (
          SELECT doc_id, source, lang, regexp_extract_all(coalesce(text, ''), {q(pattern)}) AS ms, regexp_extract_all(coalesce(text, ''), {q(pattern)}, {group}) AS vs, regexp_split_to_array(coalesce(text, ''), {q(pattern)}) AS gs FROM documents))
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE length(v) >= {least}"""


OP1 = f"""WITH b AS ({spans(0, ASSIGN, 2, 6)} UNION ALL {spans(1, ACCESS)} UNION ALL {spans(2, HEX)}),
lo AS ({spans(3, OPAQUE)}), l AS (SELECT * FROM lo WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = lo.doc_id AND b.s < lo.e AND lo.s < b.e)),
c AS (SELECT * FROM b UNION ALL SELECT * FROM l),
oo AS (SELECT v, coalesce(concat('=', source), '-') AS o, count(DISTINCT concat_ws('/', source, lang)) AS r FROM c GROUP BY ALL),
ow AS (SELECT v, sum(r) AS repos, sum(r) * sum(r) <= 3 * sum(r * r) AS live FROM oo GROUP BY 1),
j AS (SELECT c.*, repos, live FROM c JOIN ow ON c.v = ow.v WHERE kind < 3 OR live),
n AS (SELECT *, concat(list_extract(['assign', 'access', 'hex', 'owned'], kind + 1), ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)) AS t FROM j),
g AS (SELECT doc_id, count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex, coalesce(string_agg(t, ',' ORDER BY s, kind) FILTER (kind < 3), '') AS base, string_agg(t, ',' ORDER BY s, kind) AS spans, count_if(live) AS n_live, count_if(NOT live) AS n_copied, max(repos) AS r FROM n GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_copied, 0) AS BIGINT) AS n_copied, CAST(coalesce(r, 0) AS BIGINT) AS most_repos FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id"""

OP2 = f"""WITH i AS (SELECT item_id, {words('text')} AS w FROM benchmark), iw AS (SELECT item_id, w, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
s AS (SELECT item_id, k, unnest({shingles('w', 'k')}) AS x FROM iw), n AS (SELECT item_id, count(*) AS n FROM s GROUP BY 1),
ks AS (SELECT DISTINCT k FROM iw), d AS (SELECT doc_id, {words('text')} AS w FROM documents), e AS (SELECT doc_id, k, unnest({shingles('w', 'k')}) AS x FROM d, ks WHERE len(w) >= k),
h AS (SELECT e.doc_id, s.item_id, count(*) AS c FROM e JOIN s ON e.k = s.k AND e.x = s.x GROUP BY 1, 2)
SELECT doc_id, h.item_id, n AS n_item_shingles, c AS n_shared FROM h JOIN n ON h.item_id = n.item_id WHERE c * 5 >= n * 4"""


def _op3(steps: int = 120, rate: float = 0.5) -> str:
    """Raking under the bound of probability 1: shares that can be had by dimension, then steps of the language's and the
    topic's factors in turn, the source's factor worked out anew in each from its cells in order of saturation."""
    powers = (("source", 0.5), ("lang", 0.7), ("topic", 0.5))
    topic = "CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty' WHEN (length(text) - length(replace(text, '|', ''))) * 100 >= length(text) THEN 'table' WHEN len(regexp_extract_all(text, '[A-Z]')) * 3 > length(text) THEN 'shouting' WHEN length(text) > 5000 THEN 'long' WHEN length(text) < 600 THEN 'short' ELSE 'prose' END"
    out = f"WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic, coalesce(len({words('text', False)}), 0) AS n FROM documents), c0 AS (SELECT source, lang, topic, sum(n)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n) > 0), tt AS (SELECT sum(tokens) AS total FROM c0)"
    for dim, power in powers:
        out += f", a_{dim} AS (SELECT {dim}, sum(tokens) / (SELECT total FROM tt) / {rate} AS bound, pow(sum(tokens), {power}) AS w FROM c0 GROUP BY 1), b_{dim} AS (SELECT {dim}, bound, w / (SELECT sum(w) FROM a_{dim}) AS asked FROM a_{dim})"
        out += f", l_{dim} AS (SELECT max((1 - coalesce(pre, 0)) / post) AS x FROM (SELECT sum(bound) OVER (ORDER BY bound / asked, {dim} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pre, sum(asked) OVER (ORDER BY bound / asked, {dim} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS post FROM b_{dim})), t_{dim} AS (SELECT {dim}, least(bound, (SELECT x FROM l_{dim}) * asked) * (SELECT total FROM tt) AS goal, (SELECT x FROM l_{dim}) * asked * (1 + 1e-12) >= bound AS whole FROM b_{dim})"
    source = "PARTITION BY source ORDER BY fl * ft DESC, lang, topic"

    def solved(table: str) -> str:
        return f"SELECT *, least(1.0::DOUBLE, {rate} * fl * ft * max((gs - coalesce(pre, 0) / {rate}) / post) OVER (PARTITION BY source)) AS p FROM (SELECT *, sum(tokens) OVER ({source} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pre, sum(tokens * fl * ft) OVER ({source} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS post FROM {table})"

    clip = lambda x: f"least(1e30::DOUBLE, greatest(1e-30::DOUBLE, {x}))"
    out += ", r AS (SELECT 0 AS i, source, lang, topic, tokens, s.goal AS gs, l.goal AS gl, t.goal AS gt, l.whole AS wl, t.whole AS wt, CASE WHEN l.whole THEN 1e30::DOUBLE ELSE 1.0 END AS fl, CASE WHEN t.whole THEN 1e30::DOUBLE ELSE 1.0 END AS ft FROM c0 JOIN t_source s USING (source) JOIN t_lang l USING (lang) JOIN t_topic t USING (topic)"
    out += f" UNION ALL SELECT i + 1, source, lang, topic, tokens, gs, gl, gt, wl, wt, CASE WHEN i % 2 = 0 AND NOT wl THEN {clip(f'fl * gl / (sum(tokens * p) OVER (PARTITION BY lang) / {rate})')} ELSE fl END, CASE WHEN i % 2 = 1 AND NOT wt THEN {clip(f'ft * gt / (sum(tokens * p) OVER (PARTITION BY topic) / {rate})')} ELSE ft END FROM ({solved('r')}) WHERE i < {steps})"
    out += f", f AS ({solved(f'(SELECT * FROM r WHERE i = {steps})')})"
    u = "CAST(concat('0x', substr(md5(concat('0:', d.doc_id)), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE"
    p = "CASE WHEN d.n > 0 THEN coalesce(f.p, 0) ELSE 0 END"
    return out + f" SELECT doc_id, d.source, d.lang, d.topic, round({p}, 6) AS probability, {u} < {p} AS kept FROM d LEFT JOIN f ON d.source = f.source AND d.lang = f.lang AND d.topic = f.topic"


# Conversations as one text with lengths told, so that a prefix of turns is a prefix of the text.
OP5 = """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
c AS (SELECT conv_id, count(*) AS n, string_agg(concat(coalesce(length(role)::VARCHAR, '-'), ':', role, coalesce(length(text)::VARCHAR, '-'), ':', text), '' ORDER BY k) AS x FROM t GROUP BY 1),
g AS (SELECT min(conv_id) AS conv_id, n, x, count(*) AS n_copies FROM c WHERE conv_id IS NOT NULL GROUP BY n, x),
m AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g h WHERE h.n > g.n AND starts_with(h.x, g.x)) UNION ALL SELECT conv_id, n, x, 1 FROM c WHERE conv_id IS NULL)
SELECT m.conv_id, (k - 1) // 256 AS part, n AS n_turns, n_copies, string_agg(concat('<|', coalesce(role, ''), '|>', chr(10), coalesce(text, ''), chr(10), '<|end|>', chr(10)), '' ORDER BY k) AS rendered
FROM m JOIN t ON m.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY m.conv_id, (k - 1) // 256, n, n_copies"""


def _op6(num: int = 4, den: int = 5) -> str:
    rows = [(i, name, sorted(licenses.bigrams_of(t))) for i, (name, t) in enumerate((n, t) for n, texts in licenses.TEMPLATES.items() for t in texts)]
    known = ", ".join(f"({i}, {q(name)}, {q(b)})" for i, name, found in rows for b in found)
    return rf"""WITH k(i, license, b) AS (VALUES {known}), kn AS (SELECT i, count(*) AS nb FROM k GROUP BY 1),
    p AS (SELECT doc_id, text, regexp_split_to_array(text, '\n[\x20\x09\r]*\n[\x20\x09\r\n]*') AS ps FROM documents),
    u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents UNION ALL SELECT doc_id, t FROM (SELECT doc_id, unnest(ps) AS t FROM p) WHERE contains(t, chr(10)) UNION ALL SELECT doc_id, text FROM p WHERE len(ps) > 1),
    w AS (SELECT doc_id, row_number() OVER () AS r, translate(t, '{UP}', '{LOW}') AS t FROM u), v AS (SELECT doc_id, r, regexp_extract_all(t, '[a-z0-9]+') AS l FROM w),
    x AS (SELECT doc_id, r, list_distinct(list_transform(range(1, len(l)), lambda i: concat(l[i], ' ', l[i + 1]))) AS bs FROM v), y AS (SELECT doc_id, r, len(bs) AS a, unnest(bs) AS b FROM x),
    z AS (SELECT doc_id, r, i, min(license) AS license, 2.0::DOUBLE * count(*) / (min(a) + min(nb)) AS dice FROM y JOIN k USING (b) JOIN kn USING (i) GROUP BY 1, 2, 3), o AS (SELECT doc_id, r, max(dice) AS dice, arg_min(license, row(-dice, license)) AS license FROM z WHERE dice >= {num / den} GROUP BY 1, 2),
    g AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS ls, max(dice) AS best FROM o GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_matches, coalesce(ls, '') AS licenses, round(coalesce(best, 0), 6) AS best_dice FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id"""


OP7 = f"""WITH RECURSIVE d AS (SELECT doc_id, {words('text')} AS w FROM documents), s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN {shingles('w', '5')} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS x FROM d),
n AS (SELECT doc_id, len(x) AS n FROM s), e AS (SELECT doc_id, unnest(x) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (min(na.n) + min(nb.n) - count(*))),
m AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r AS (SELECT a, b FROM m UNION SELECT r.a, m.b FROM r JOIN m ON r.b = m.a)
SELECT n.doc_id, n AS n_shingles, least(n.doc_id, coalesce(min(b), n.doc_id)) AS component_id FROM n LEFT JOIN r ON n.doc_id = r.a GROUP BY n.doc_id, n"""


def _op9() -> str:
    classes = ["[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[!\"''(),\-./:;?@\[\\\]^_`{}~+=]"]
    count = lambda t, c: f"len(regexp_extract_all({t}, '{c}'))"
    k = [f"k{i}" for i in range(7)]
    js = "sqrt(greatest(0, (CASE WHEN p > 0 THEN p * log2(p / ((p + r) / 2)) ELSE 0 END) + (CASE WHEN r > 0 THEN r * log2(r / ((p + r) / 2)) ELSE 0 END)))"
    part = js.replace("sqrt(greatest(0, ", "(").removesuffix("))") + ")"
    dw, dc = 0.34, 0.31
    return rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, {words("coalesce(text, '')", False)} AS w FROM documents),
    h AS (SELECT doc_id, lang, len(w) AS n, w, length(t) AS cp, {", ".join(f"{count('t', c)} AS k{i}" for i, c in enumerate(classes))}, t FROM d), hh AS (SELECT *, cp - k0 - k1 - k2 - k3 - k4 - k5 AS k6 FROM h),
    tri AS (SELECT doc_id, unnest(range(1, n - 1)) AS i, w FROM h WHERE n >= 3), tr AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS x FROM tri), tw AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM tr),
    rep AS (SELECT doc_id, count(DISTINCT j) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tw WHERE c > 1) GROUP BY 1),
    ln AS (SELECT doc_id, count(*) - count(DISTINCT x) AS r FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1),
    wc AS (SELECT lang, x, count(*) AS c FROM (SELECT lang, unnest(w) AS x FROM d) GROUP BY 1, 2), wt AS (SELECT lang, sum(c) AS total FROM wc GROUP BY 1),
    cm AS (SELECT wc.lang, x, c / total AS r FROM wc JOIN wt USING (lang) WHERE c * {rules.COMMON} >= total), co AS (SELECT lang, 1 - sum(r) AS r FROM cm GROUP BY 1),
    dc AS (SELECT doc_id, lang, x, count(*) AS c FROM (SELECT doc_id, lang, unnest(w) AS x FROM d) GROUP BY ALL),
    pj AS (SELECT hh.doc_id, hh.lang, cm.x, cm.r, coalesce(dc.c, 0) / hh.n AS p FROM hh JOIN cm ON hh.lang = cm.lang LEFT JOIN dc ON dc.doc_id = hh.doc_id AND dc.x = cm.x WHERE hh.n >= 100),
    po AS (SELECT doc_id, lang, 1 - sum(p) AS p FROM pj GROUP BY 1, 2), al AS (SELECT doc_id, greatest(p, 0) AS p, r FROM pj UNION ALL SELECT doc_id, greatest(po.p, 0), greatest(co.r, 0) FROM po JOIN co USING (lang)),
    dw AS (SELECT doc_id, sqrt(greatest(0, sum({part}) / 2)) AS js FROM al GROUP BY 1),
    rc AS (SELECT lang, {", ".join(f"sum({x}) AS r{i}" for i, x in enumerate(k))}, sum(cp) AS rt FROM hh WHERE cp > 0 GROUP BY 1),
    cl AS (SELECT doc_id, unnest([{", ".join(f"{x} / cp" for x in k)}]) AS p, unnest([{", ".join(f"r{i} / rt" for i in range(7))}]) AS r FROM hh JOIN rc USING (lang) WHERE n >= 50),
    dk AS (SELECT doc_id, sqrt(greatest(0, sum({part}) / 2)) AS js FROM cl GROUP BY 1),
    f AS (SELECT hh.doc_id, n AS n_words, cp - k3 AS word_chars, k4 AS n_symbols, coalesce(ln.r, 0) AS n_dup_lines, coalesce(rep.r, 0) AS n_repeat_words, coalesce(dw.js, 0) AS a, coalesce(dk.js, 0) AS b, coalesce({rules.COMMON} / total, 0) AS wider FROM hh LEFT JOIN wt USING (lang) LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id) LEFT JOIN dw USING (doc_id) LEFT JOIN dk USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND a * a <= {dw} * {dw} + wider AND b <= {dc} AS kept FROM f"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    steps = ", ".join(["-1"] * 8)
    bits = f"flatten(list_transform(string_split({text}, ''), lambda ch: [CAST(ascii(ch) AS BIGINT), {steps}]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT)"


# Pairs of equal three-word windows at most a quarter of the text apart, and their gaps and islands for each distance.
OP11 = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("coalesce(text, '')", False)} AS o, {crc32("doc_id::VARCHAR")} AS h FROM documents),
s AS (SELECT *, len(o) AS n, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM d), p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM s),
t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN o ELSE list_transform(range(0, n), lambda i: o[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM p),
x AS (SELECT r, n, unnest(range(0, n)) AS i, unnest(w) AS x FROM t), y AS (SELECT r, n, i, x, lead(x, 1) OVER v AS x1, lead(x, 2) OVER v AS x2 FROM x WINDOW v AS (PARTITION BY r ORDER BY i)),
e AS (SELECT a.r, b.i - a.i AS q, a.i FROM y a JOIN y b ON a.r = b.r AND a.x = b.x AND a.x1 = b.x1 AND a.x2 = b.x2 AND b.i > a.i WHERE 4 * (b.i - a.i) <= a.n),
g AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM e), l AS (SELECT r, q, min(i) AS s, count(*) + 2 + q AS m FROM g GROUP BY r, q, g HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
u AS (SELECT r, s, m, min(q) AS q FROM l GROUP BY 1, 2, 3), b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY m::DOUBLE / q DESC, s, q) AS k FROM u),
ru AS (SELECT r, count(*) AS n_runs, string_agg(concat(s::BIGINT, ',', m::BIGINT, ',', q::BIGINT, chr(10)), '' ORDER BY s, q) AS told FROM u GROUP BY 1),
dr AS (SELECT DISTINCT r, unnest(range(s + q, s + m)) AS i FROM u),
co AS (SELECT x.r, string_agg(x, ' ' ORDER BY x.i) FILTER (dr.i IS NULL) AS left_over FROM x LEFT JOIN dr ON x.r = dr.r AND x.i = dr.i GROUP BY 1)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.m AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period, CAST(1000 * b.m // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM t LEFT JOIN ru USING (r) LEFT JOIN co USING (r) LEFT JOIN b ON b.r = t.r AND b.k = 1"""


# A prefix of turns is a text with all lengths told, so nodes are texts and a subtree is what starts with one.
OP12 = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS n, {crc32("c::VARCHAR")} % 9 AS h FROM t GROUP BY 1),
b AS (SELECT s.c, t.k, role, text FROM s JOIN t ON t.c = s.c - s.c % 5 AND t.k <= s.h UNION ALL SELECT s.c, t.k - s.h + least(s.h, coalesce(o.n, 0)), role, text FROM s JOIN t ON t.c = s.c AND t.k > s.h LEFT JOIN s o ON o.c = s.c - s.c % 5),
p AS (SELECT c, k AS d, strlen(text) AS bytes, string_agg(concat(length(role), ':', role, length(text), ':', text), '' ORDER BY k) OVER (PARTITION BY c ORDER BY k) AS x FROM b UNION ALL SELECT c, 0, 0, '' FROM s),
q AS (SELECT c, d, bytes, x, lag(x) OVER v AS px, d = max(d) OVER (PARTITION BY c) AS is_end FROM p WINDOW v AS (PARTITION BY c ORDER BY d)),
n AS (SELECT d, x, min(px) AS px, min(c) AS c, count(*) AS n_convs, min(bytes) AS bytes, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS e FROM q GROUP BY d, x),
k AS (SELECT d - 1 AS d, px AS x, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2), m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.d = k.d AND n.x = k.x),
u AS (SELECT a.d, a.x, count(*) FILTER (z.n_children = 0) AS n_leaves, sum((z.n_convs - 1) * z.bytes) AS saved FROM m a JOIN q ON q.d = a.d AND q.x = a.x JOIN m z ON z.c = q.c AND z.d >= a.d GROUP BY 1, 2)
SELECT m.c AS conv_id, m.d AS depth, o.c AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, m.e AS ends_sha256
FROM m JOIN u ON m.d = u.d AND m.x = u.x LEFT JOIN m o ON o.d = m.d - 1 AND o.x = m.px"""


# Rows are numbered, as ids may repeat; a key counts once for each row.
OP13 = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d), k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UP}', '{LOW}') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY 1 HAVING count(DISTINCT r) >= 10),
g AS (SELECT r, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256 FROM k LEFT JOIN c USING (key) GROUP BY 1)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, kept_sha256 FROM d JOIN g USING (r)"""


ORACLES = {
    "op1_secret_scans": OP1,
    "op2_benchmark_decontamination": OP2,
    "op3_mixing": _op3(),
    "op5_chat_formatting": OP5,
    "op6_license_scans": _op6(),
    "op7_ngram_jaccard_join": OP7,
    "op9_quality_rules": _op9(),
    "op11_periodic_run_detection": OP11,
    "op12_conversation_prefix_trie": OP12,
    "op13_line_dedup": OP13,
}
