"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from assaylake.llm.url_reputation import DEVIATIONS, LEAST_STRENGTH, LIMIT, MOST_STRENGTH, TWO_LABEL_SUFFIXES, Rule

MIX = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
    FROM documents),
sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
    FROM sized GROUP BY source),
-- sources by the level at which they are full; a level that fills k of them leaves the others unfilled at the right k
ranked AS (
    SELECT *, 3 * source_size AS cap,
           coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
           sum(w) OVER (ORDER BY 3 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
           sum(source_size) OVER () AS total, row_number() OVER (ORDER BY 3 * source_size / w, source) AS rn
    FROM sums),
levels AS (SELECT *, CAST(total - held AS DOUBLE) / CAST(open_w AS DOUBLE) AS level FROM ranked),
water AS (
    SELECT arg_min(level, rn) FILTER (WHERE cap > w * level) AS level FROM levels),
targets AS (
    SELECT source, source_size, CASE WHEN level IS NULL OR cap <= w * level THEN CAST(cap AS DOUBLE) ELSE w * level END AS target
    FROM ranked, water),
split AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
rest AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS rest FROM split),
running AS (
    SELECT d.doc_id, d.size, r.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken
FROM running"""


def licenses() -> str:
    """The license report; the rules are the same table, the matching and suppression are SQL's own."""
    from assaylake.llm.licenses import REACH, signature_rules

    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(f"({quoted(r.trigger)}, {quoted(r.pattern)}, {quoted(r.label)}, {r.tier}, {i}, CAST({r.confidence} AS DOUBLE))"
                        for i, r in enumerate(signature_rules()))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH rules(trigger, pattern, label, tier, seq, conf) AS (VALUES {values}),
d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS ws
    FROM documents),
places AS (
    SELECT rid, ws, i, ws[i + 1] AS w FROM (SELECT rid, ws, unnest(range(0, len(ws))) AS i FROM d)
    WHERE ws[i + 1] IN (SELECT trigger FROM rules)),
base AS (
    SELECT rid, i, CASE WHEN w = 'mit' AND ws[i + 2] = 'license' THEN 'mit'
                        WHEN w = 'apache' AND ws[i + 2] = 'license' THEN 'apache'
                        WHEN w = 'general' AND ws[i + 2] = 'public' AND ws[i + 3] = 'license' THEN 'gpl' END AS label
    FROM places),
ahead AS (SELECT rid, i, w, array_to_string(ws[i + 1:i + {REACH}], ' ') AS ctx FROM places),
found AS (
    SELECT rid, i AS s, i + len(string_split(trim(regexp_extract(ctx, pattern, 0)), ' ')) AS e, label, tier, seq, conf
    FROM ahead JOIN rules ON trigger = w AND regexp_matches(ctx, pattern)),
kept AS (
    SELECT * FROM found x WHERE NOT EXISTS (
        SELECT 1 FROM found y WHERE y.rid = x.rid AND y.s <= x.s AND y.e >= x.e AND (
            (y.e - y.s > x.e - x.s AND y.tier <= x.tier)
            OR (y.e - y.s = x.e - x.s AND (y.tier < x.tier OR (y.tier = x.tier AND y.seq < x.seq)))))),
named AS (
    SELECT rid, label, i, true AS is_base, CAST(NULL AS DOUBLE) AS conf FROM base WHERE label IS NOT NULL
    UNION ALL SELECT rid, label, s, false, conf FROM kept),
sums AS (
    SELECT rid, count(*) FILTER (WHERE is_base) AS n_base, min(i) FILTER (WHERE is_base) AS first_word, max(i) FILTER (WHERE is_base) AS last_word,
           list_sort(list_distinct(list(label) FILTER (WHERE is_base))) AS bl, list_sort(list_distinct(list(label))) AS al, max(conf) AS score
    FROM named GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(al, ','), '') AS labels,
       coalesce(score, 0.0) AS score
FROM d LEFT JOIN sums USING (rid)"""


CONTAMINATION = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents),
b AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark),
win AS (
    SELECT DISTINCT item, n, array_to_string(ws[k + 1:k + n], ' ') AS w
    FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(range(0, len(ws) - least(13, len(ws)) + 1)) AS k FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM win),
occ AS (
    SELECT rid, k, n, array_to_string(ws[k + 1:k + n], ' ') AS w
    FROM (SELECT rid, ws, n, unnest(range(0, len(ws) - n + 1)) AS k FROM d, lengths WHERE len(ws) >= n)),
hits AS (SELECT rid, k, n, item FROM occ JOIN win USING (n, w)),
words AS (SELECT rid, count(DISTINCT i) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS i FROM hits) GROUP BY rid),
items AS (SELECT rid, list_sort(list(DISTINCT item)) AS its FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(its), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(its, ','), '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def urls(rules: Sequence[Rule]) -> str:
    """The URL filter: rules and suffixes are the same lists; parsing, shrinkage and the bound are written out here."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(r.verdict)}, {quoted(r.host)}, {quoted(r.path)})" for r in rules)
    two = ", ".join(quoted(s) for s in TWO_LABEL_SUFFIXES)

    def level(name: str, members: str) -> str:
        even = "n * m * (1 - m)"
        return f"""
{name}_s AS (
    SELECT CASE WHEN coalesce(most, 0) = 0 THEN {LEAST_STRENGTH} WHEN seen <= binomial THEN {MOST_STRENGTH}
                ELSE greatest({LEAST_STRENGTH}, least({MOST_STRENGTH}, 1 / ((seen - binomial) / most) - 1)) END AS s
    FROM (SELECT sum((k - n * m) ** 2) AS seen, sum({even}) AS binomial, sum({even} * (n - 1)) AS most FROM {members})),
{name} AS (SELECT *, (s * m + k) / (s + n) AS mean, s + n AS weight FROM {members}, {name}_s)"""

    return rf"""
WITH cut AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
page AS (
    SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM cut),
good AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id),
shown AS (SELECT host, TRY_CAST(nullif(regexp_extract(path, '^/[^/]*/([0-9]+)', 1), '') AS BIGINT) AS doc_id FROM page),
marks AS (SELECT host, count(*) AS n, sum(bad::INT) AS k FROM shown JOIN good USING (doc_id) WHERE bad IS NOT NULL GROUP BY host),
parts AS (
    SELECT host, coalesce(n, 0) AS n, coalesce(k, 0) AS k, regexp_matches(host, '^[0-9.]+(:[0-9]*)?$') AS numeric,
           string_split(host, '.') AS l
    FROM (SELECT DISTINCT host FROM page) LEFT JOIN marks USING (host)),
suffixed AS (
    SELECT *, CASE WHEN numeric THEN host WHEN array_to_string(l[-2:], '.') IN ({two}) THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM parts),
named AS (
    SELECT host, n, k, suffix, CASE WHEN suffix = host THEN host ELSE array_to_string(l[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain FROM suffixed),
overall AS (SELECT coalesce(sum(k)::DOUBLE / nullif(sum(n), 0), 0.0) AS m FROM named),
suffix_in AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, any_value(m) AS m FROM named, overall GROUP BY suffix),
{level("suffix_out", "suffix_in")},
domain_in AS (
    SELECT d.domain, d.n, d.k, o.mean AS m
    FROM (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k FROM named GROUP BY domain, suffix) d JOIN suffix_out o USING (suffix)),
{level("domain_out", "domain_in")},
host_in AS (SELECT x.host, x.n::DOUBLE AS n, x.k::DOUBLE AS k, o.mean AS m FROM named x JOIN domain_out o USING (domain)),
{level("host_out", "host_in")},
known AS (SELECT host, n, k, mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (weight + 1)) > {LIMIT} AS bad FROM host_out),
rules(verdict, rule_host, rule_path) AS (VALUES {values}),
fits AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM page) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN w.bad THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(w.n AS BIGINT) AS n_labelled, CAST(w.k AS BIGINT) AS n_bad
FROM page p JOIN known w USING (host) LEFT JOIN fits f ON f.host = p.host AND f.path = p.path
"""


SPELLING = r"""
WITH crc(t) AS (  -- remainders of one byte, by eight steps of the polynomial
    SELECT list(r ORDER BY i) FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r
        FROM range(256) AS b(i))),
runs AS (
    SELECT id, run, count(*) AS k
    FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                 translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
          FROM documents)
    WHERE length(run) >= 6 GROUP BY id, run),
spelled AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS (
    SELECT id, run, k, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h
    FROM spelled, crc),
words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
without AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM gaps),
near AS (
    SELECT a.word AS word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON b.word = a.l || a.r
    UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON b.word = a.l || a.r),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top_n FROM near GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top_n >= 5 * w.n THEN b.top_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
named AS (
    SELECT f.*, m.form FROM formed f LEFT JOIN (
        SELECT f.word, min(x.near) AS form FROM formed f JOIN near x ON x.word = f.word AND x.near_n = f.form_n GROUP BY f.word) m USING (word)),
chain AS (
    WITH RECURSIVE walk AS (
        SELECT word, word AS here, 0 AS depth FROM named
        UNION ALL SELECT w.word, m.form, depth + 1 FROM walk w JOIN named m ON m.word = w.here WHERE m.form IS NOT NULL)
    SELECT word, arg_max(here, depth) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM named JOIN chain USING (word)
"""
