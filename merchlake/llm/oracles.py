"""SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

from .quality_rules import CUTOFFS, RULES

_WORDS = r"'[^\x20\x09-\x0D]+'"

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {_WORDS}) AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h FROM d, LATERAL unnest(range(1, len(ws) - 48)) t(s)),
firsts AS (SELECT h, MIN(doc_id) AS f FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN firsts USING (h) WHERE f < doc_id)),
pos AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT pos.doc_id, string_agg(w, ' ' ORDER BY pos.p) AS kept, COUNT(*) AS n FROM pos ANTI JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

def lines(depth: int = 14) -> str:
    """Runs shorter than 2**depth lines: digests of blocks of 2**k lines, each made of two of half the length; only blocks that occur twice go on."""
    here = "{'doc': doc_id, 'pos': pos}"
    block = """b{k} AS MATERIALIZED (SELECT *, MIN({here}) OVER (PARTITION BY h) AS first FROM ({rows}) QUALIFY COUNT(*) OVER (PARTITION BY h) > 1)"""
    rows = ["SELECT doc_id, pos, md5(line) AS h FROM l WHERE own"] + [f"SELECT a.doc_id, a.pos, md5(a.h || b.h) AS h FROM b{k} a JOIN b{k} b ON b.doc_id = a.doc_id AND b.pos = a.pos + {1 << k}" for k in range(depth)]
    blocks = ",\n".join(block.format(k=k, here=here, rows=r) for k, r in enumerate(rows))
    later = " UNION ALL ".join(f"SELECT doc_id, pos, {k} AS k, first FROM b{k} WHERE first < {here}" for k in range(depth + 1))
    # the common prefix with the earlier copy, by halving steps
    grow = [f"g{depth} AS (SELECT * FROM starts)"]
    for k in range(depth - 1, -1, -1):
        grow.append(f"g{k} AS MATERIALIZED (SELECT g.doc_id, g.pos, g.k, g.first, n + CASE WHEN g.k > {k} AND m.h = t.h THEN {1 << k} ELSE 0 END AS n FROM g{k + 1} g LEFT JOIN b{k} m ON m.doc_id = g.doc_id AND m.pos = g.pos + n LEFT JOIN b{k} t ON t.doc_id = g.first.doc AND t.pos = g.first.pos + n)")
    return rf"""
WITH l AS MATERIALIZED (SELECT doc_id, pos, line, regexp_matches(line, {_WORDS}) AS own FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL)),
{blocks},
deep AS MATERIALIZED (SELECT doc_id, pos, MAX(k) AS k, arg_max(first, k) AS first FROM ({later}) GROUP BY 1, 2),
starts AS MATERIALIZED (SELECT d.doc_id, d.pos, d.k, d.first, CAST(1 AS BIGINT) << d.k AS n FROM deep d LEFT JOIN deep e ON e.doc_id = d.doc_id AND e.pos = d.pos - 1 WHERE e.first IS NULL OR e.first.doc <> d.first.doc OR e.first.pos + 1 <> d.first.pos),
{("," + chr(10)).join(grow)},
runs AS (SELECT * FROM g0 WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM runs),
r AS (SELECT doc_id, COUNT(*) AS n_runs, MAX(n) AS longest_run FROM runs GROUP BY 1),
m AS (SELECT l.*, gone.pos IS NOT NULL AS gone FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos),
g AS (SELECT *, pos - ROW_NUMBER() OVER (PARTITION BY doc_id, gone ORDER BY pos) AS island FROM m),
i AS (SELECT doc_id, MAX(n) AS longest FROM (SELECT doc_id, island, COUNT(*) AS n FROM g WHERE gone GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_removed, COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY 1)
SELECT d.doc_id, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_runs, 0) AS n_runs, CAST(COALESCE(longest_run, 0) AS BIGINT) AS longest_run, COALESCE(longest, 0) AS longest_gap,
  sha256(CASE WHEN n_removed > 0 AND NOT regexp_matches(kept, {_WORDS}) THEN '' ELSE COALESCE(kept, '') END) AS kept_sha256 FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id
"""


def quality(alpha: float = 0.03, delta: float = 0.05) -> str:
    rate, tests = alpha / len(RULES), len(RULES) * len(CUTOFFS)
    signals = {
        "symbol_share": "n_symbols / word_chars",
        "dup_line_share": "n_dup_lines / n_lines",
        "repeat_share": "n_repeat_words / n_words",
        "upper_share": "n_upper / n_letters",
        "long_word_share": "LEAST(1.0, word_chars / n_words / 40)",
    }
    # an empty denominator gives 0
    shares = " UNION ALL ".join(f"SELECT doc_id, stratum, '{r}' AS rule, CASE WHEN isfinite(x) THEN x ELSE 0 END AS x FROM (SELECT *, COALESCE(CAST({e} AS DOUBLE), 0) AS x FROM f)" for r, e in signals.items())
    return rf"""
WITH d AS (SELECT doc_id, COALESCE(lang, '') AS stratum, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), {_WORDS}) AS ws FROM documents),
tri AS (SELECT doc_id, s, COUNT(*) OVER (PARTITION BY doc_id, h) > 1 AS twice FROM (SELECT doc_id, s, array_to_string(ws[s:s + 2], ' ') AS h FROM d, LATERAL unnest(range(1, len(ws) - 1)) t(s))),
rep AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 3)) AS p FROM tri WHERE twice) GROUP BY 1),
f AS (SELECT d.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORDS}))) AS BIGINT) AS n_lines,
  n_lines - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORDS})))) AS n_dup_lines,
  COALESCE(rep.n, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
  (len(ws) < 50 OR 100 * COALESCE(rep.n, 0) > 50 * len(ws)) AS base_failed FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
s AS ({shares}),
told AS (SELECT doc_id, MIN(quality > 0) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING MIN(quality > 0) = MAX(quality > 0)),
sole AS (SELECT doc_id FROM (SELECT DISTINCT * FROM f) GROUP BY 1 HAVING COUNT(*) = 1),
g AS (SELECT DISTINCT s.*, good FROM s JOIN sole USING (doc_id) JOIN (SELECT DISTINCT doc_id FROM f WHERE NOT base_failed) USING (doc_id) JOIN told USING (doc_id)),
c AS (SELECT stratum, rule, cutoff, COUNT(*) FILTER (good) AS n, COUNT(*) FILTER (good AND x > cutoff) AS k, COUNT(*) FILTER (NOT good AND x > cutoff) AS caught FROM g, (SELECT unnest({list(CUTOFFS)}) AS cutoff) GROUP BY 1, 2, 3),
admitted AS (SELECT * FROM c WHERE k < n AND k <= n * {rate!r} AND caught > k AND
  list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({rate!r}) + (n - i) * ln(1 - {rate!r})))) <= {delta!r} / (GREATEST(1, (SELECT COUNT(DISTINCT stratum) FROM g)) * {tests})),
chosen AS (SELECT stratum, rule, cutoff FROM admitted QUALIFY ROW_NUMBER() OVER (PARTITION BY stratum, rule ORDER BY caught - k DESC, cutoff DESC) = 1),
bad AS (SELECT DISTINCT s.doc_id FROM s JOIN chosen USING (stratum, rule) WHERE s.x > chosen.cutoff)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept FROM f LEFT JOIN bad ON bad.doc_id = f.doc_id
"""


def resampling(buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20) -> str:
    found = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    # CRC-32 by its definition: a table of the 256 remainders, then one byte after the other; each word once
    return rf"""
WITH r AS (SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS v FROM range(256) t(i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM r),
d AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS row, doc_id, {found} AS ws FROM documents),
f AS MATERIALIZED (SELECT row, unnest(ws) AS w FROM d), b AS MATERIALIZED (SELECT unnest({found}) AS w FROM benchmark),
x AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM f UNION SELECT w FROM b)),
v AS MATERIALIZED (SELECT w, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)), lambda a, c: xor(t[xor(a, c) % 256 + 1], a // 256), 4294967295), 4294967295) % {buckets} AS bucket FROM x, tab),
s AS (SELECT bucket, COUNT(*) AS s FROM f JOIN v USING (w) GROUP BY 1), t AS (SELECT bucket, COUNT(*) AS t FROM b JOIN v USING (w) GROUP BY 1),
g AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln((COALESCE(t, 0) + 1.0::DOUBLE) * ((SELECT COUNT(*) FROM f) + {buckets}.0::DOUBLE) / ((s + 1.0::DOUBLE) * ((SELECT COUNT(*) FROM b) + {buckets}.0::DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT row, CAST(SUM(gain) AS BIGINT) AS weight FROM f JOIN v USING (w) JOIN g USING (bucket) GROUP BY 1),
o AS (SELECT doc_id, len(ws) AS n_features, COALESCE(weight, 0) AS weight, COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w ON w.row = d.row),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, COUNT(*) FILTER (n_features >= {least_words}) OVER () * {percent} // 100 AS drawn FROM o)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= {least_words} AND place <= drawn THEN place END AS rank FROM k
"""


def vector_codes(scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    # whole numbers in doubles: products and sums stay below 2**53
    assign = """a{i} AS MATERIALIZED (SELECT row, x.p, MIN({{'d': xx - 2 * list_inner_product(x.x, b.c) + list_inner_product(b.c, b.c), 'e': b.e}}) AS m FROM x JOIN b{i} b ON b.p = x.p GROUP BY 1, 2)"""
    update = """b{j} AS MATERIALIZED (SELECT b.p, b.e, COALESCE(m.c, b.c) AS c FROM b{i} b LEFT JOIN (SELECT p, e, list(q ORDER BY k) AS c FROM (SELECT p, e, k, floor(SUM(y) / COUNT(*)) AS q FROM (SELECT x.p, a.m.e AS e, unnest(x.x) AS y, unnest(range(len(x.x))) AS k FROM x JOIN a{i} a ON a.row = x.row AND a.p = x.p) GROUP BY 1, 2, 3) GROUP BY 1, 2) m ON m.p = b.p AND m.e = b.e)"""
    steps = ",\n".join(f"{assign.format(i=i)},\n{update.format(i=i, j=i + 1)}" for i in range(rounds))
    return f"""
WITH v AS MATERIALIZED (SELECT ROW_NUMBER() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {scale})) AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(embedding) > 0),
x AS MATERIALIZED (SELECT row, p, x, list_inner_product(x, x) AS xx FROM (SELECT row, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM v, range({parts}) t(p))),
b0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM x WHERE row <= {entries}),
{steps},
{assign.format(i=rounds)},
c AS (SELECT row, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(SUM(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM v JOIN c USING (row)
"""


ORACLE = {"op2_substrings": SUBSTRINGS, "op3_quality_rules": quality(), "op6_line_runs": lines(), "op11_resampling": resampling(), "op12_vector_codes": vector_codes()}
