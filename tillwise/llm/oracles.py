"""DuckDB SQL of the numbered operators that SQL can express (parameters come from the operators)."""

from __future__ import annotations

import re

from tillwise.llm import centroids, chat, collocations, partenum, quality, secrets, urls

SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- 6: secrets ---------------------------------------------------------------------------

def _found(name: str, pattern: str) -> str:
    """Rows (rid, s, e, m) of the leftmost non-overlapping matches."""
    whole = _text(f"(?s)(.*?)({pattern})")
    return f"""
{name}0 AS (SELECT rid, regexp_extract_all(text, {whole}, 1) AS gaps, regexp_extract_all(text, {whole}, 2) AS hits FROM docs WHERE regexp_matches(text, {_text(pattern)})),
{name}1 AS (SELECT rid, unnest(range(1, len(hits) + 1)) AS i, gaps, hits FROM {name}0),
{name} AS (
  SELECT rid, hits[i] AS m, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))) AS BIGINT) AS e
  FROM {name}1
)"""


def secrets_sql() -> str:
    assign = secrets.ASSIGN + secrets.ASSIGNED
    parts = [_found("m_assign", assign), _found("m_access", secrets.ACCESS), _found("m_hex", secrets.HEX)]
    allowed = " OR ".join(f"regexp_matches(m, {_text(p)})" for p in secrets.ALLOWED[:-1])
    hot = []
    for name, (chars, width, bits, must) in secrets.CLASSES.items():
        terms = "[" + ", ".join(map(str, secrets.terms(width))) + "]"
        parts.append(_found(f"c_{name}", f"{chars}{{{width},}}"))
        parts.append(f"""
w_{name} AS (SELECT rid, s, m, unnest(range(0, length(m) - {width} + 1)) AS k FROM c_{name} WHERE regexp_matches(m, {_text(must)})),
h_{name} AS (
  SELECT rid, s, m, k FROM (
    SELECT rid, s, m, k, list_sum(list_transform(list_distinct(string_split(substr(m, CAST(k + 1 AS BIGINT), {width}), '')),
             lambda c: ({terms})[{width} - length(replace(substr(m, CAST(k + 1 AS BIGINT), {width}), c, '')) + 1])) AS total
    FROM w_{name}) WHERE total <= {secrets.hot_limit(width, bits)} AND NOT regexp_matches(substr(m, CAST(k + 1 AS BIGINT), {width}), {_text(secrets.WORDS)})
),
x_{name} AS (SELECT rid, s + min(k) AS s, s + max(k) + {width} AS e, substr(any_value(m), CAST(min(k) + 1 AS BIGINT), CAST(max(k) + {width} - min(k) AS BIGINT)) AS m FROM h_{name} GROUP BY rid, s)""")
        hot.append(f"SELECT rid, s, e FROM x_{name} WHERE NOT ({allowed})")
    sizes = f"length(regexp_extract(m, {_text('^' + secrets.ASSIGN + '(' + secrets.ASSIGNED + ')$')}, 1)) >= {secrets.ASSIGNED_MIN}"
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{','.join(p.strip() for p in parts)},
base AS (
  SELECT rid, s, e, 0 AS kind, 'assign' AS name FROM m_assign WHERE {sizes}
  UNION ALL SELECT rid, s, e, 1, 'access' FROM m_access UNION ALL SELECT rid, s, e, 2, 'hex' FROM m_hex
),
more AS (
  SELECT rid, s, e, 3 AS kind, 'entropy' AS name FROM ({' UNION '.join(hot)}) h
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = h.rid AND b.s <= h.s AND b.e >= h.e)
),
a AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, e, kind) AS told FROM base GROUP BY rid),
f AS (SELECT rid, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, e, kind) AS told FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(a.told, '')) AS base_sha256, coalesce(f.told, '') AS spans
FROM docs LEFT JOIN a USING (rid) LEFT JOIN f USING (rid)"""


# ---- 7: chat ------------------------------------------------------------------------------

def chat_sql() -> str:
    t = chat.TEMPLATE
    strings = [t["open"], t["split"], t["close"], *t["control"]]
    firsts = "".join("\\" + c for c in sorted({s[0] for s in strings}))
    rests = "|".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", s[1:]) for s in strings)
    esc = lambda c: f"regexp_replace({c}, {_text(f'([{firsts}])(\\\\*(?:{rests}))')}, '\\1\\\\\\2', 'g')"
    marks = sum(len(t[k]) for k in ("open", "split", "close"))
    loss = ", ".join(map(_text, t["loss"]))
    order = "ORDER BY turn NULLS FIRST, role, text"
    said = _text("</s>[INST] ok [/INST]")
    return f"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}
),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' {order}) AS told,
         coalesce(string_agg(text, '' {order}) FILTER (role IN ({loss})), '') AS loss, string_agg(role || ';', '' {order}) AS roles,
         CAST(sum({marks} + length({esc('role')}) + length({esc('text')})) AS BIGINT) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       regexp_full_match(roles, '(system;)?(user;assistant;)+') AS valid
FROM g"""


# ---- 8: urls ------------------------------------------------------------------------------

def urls_sql() -> str:
    lower, tidy = _LOWER.format("url"), f"regexp_replace({_LOWER.format('coalesce(url, {})'.format(_text('')))}, '[0-9]+', '0', 'g')"
    part = lambda pattern: f"regexp_extract(tidy, {_text(pattern)}, 1)"
    tagged = lambda tag, pattern, at: f"list_transform(list_filter(string_split_regex({part(pattern)}, {_text(at)}), lambda x: x <> ''), lambda x: {_text(tag)} || x)"
    names = f"list_transform(list_filter(list_transform(string_split({part('(?s)^.*?://[^?#]*\\?([^#]*)')}, '&'), lambda x: split_part(x, '=', 1)), lambda x: x <> ''), lambda x: 'query:' || x)"
    rule = "NULL"
    for h, p, _ in sorted(urls.RULES, key=lambda r: len(r[0] + r[1])):
        rule = f"CASE WHEN (host = {_text(h)} OR ends_with(host, {_text('.' + h)})) AND starts_with(path, {_text(p)}) THEN {_text(h + p)} ELSE {rule} END"
    verdict = "CASE rule " + " ".join(f"WHEN {_text(h + p)} THEN {_text(v)}" for h, p, v in urls.RULES) + " END"
    return f"""WITH p0 AS (SELECT page_id, url, {tidy} AS tidy, coalesce(regexp_extract({lower}, '(?s)^.*?://([^/?#]*)', 1), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
p AS (SELECT page_id, host, path, {rule} AS rule, CASE WHEN NOT contains(tidy, '://') THEN [] ELSE list_distinct(list_concat(
        {tagged('host:', '(?s)^.*?://([^/?#]*)', '[.]')}, {tagged('path:', '(?s)^.*?://[^/?#]*(/[^?#]*)', '[/.]')}, {names},
        CASE WHEN {part('(?s)^.*?://[^#]*#(.+)$')} <> '' THEN ['fragment'] ELSE [] END)) END AS tokens FROM p0),
seen AS (SELECT row_number() OVER () AS rid, tokens, coalesce(l.quality = 0 OR l.toxic = 1, l.quality = 0, l.toxic = 1, FALSE) AS bad FROM p JOIN labels l ON l.doc_id = p.page_id),
sets AS (SELECT list_filter(tokens, lambda x, i: (b >> (i - 1)) & 1 = 1) AS rule
  FROM (SELECT list_sort(tokens) AS tokens, unnest(range(1, CAST(2 ** len(tokens) AS BIGINT))) AS b FROM seen WHERE bad AND len(tokens) > 0)),
often AS (SELECT rule, count(*) AS n FROM sets GROUP BY rule HAVING count(*) >= {urls.MIN_PAGES}),
mined AS (SELECT o.rule FROM often o JOIN seen s ON list_has_all(s.tokens, o.rule) GROUP BY o.rule, o.n HAVING o.n / count(*) >= {urls.MIN_CONFIDENCE})
SELECT page_id, host, path, rule, coalesce({verdict}, CASE WHEN EXISTS (SELECT 1 FROM mined WHERE list_has_all(p.tokens, mined.rule)) THEN 'block' ELSE 'allow' END) AS verdict
FROM p"""


# ---- 9: quality ---------------------------------------------------------------------------

def quality_sql() -> str:
    sizes = sorted({3, *quality.MAX_RUN_SHARE})
    runs = ",\n".join(f"""
g{n} AS (SELECT rid, pos, array_to_string(words[pos: pos + {n - 1}], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - {n - 2})) AS pos FROM w WHERE len(words) >= {n})),
r{n} AS (SELECT rid, pos FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS c FROM g{n}) WHERE c > 1),
i{n} AS (SELECT DISTINCT rid, pos + k AS pos FROM r{n}, range({n}) t(k)),
n{n} AS (SELECT i.rid, count(*) AS covered, CAST(sum(length(w.words[i.pos])) AS BIGINT) AS chars FROM i{n} i JOIN w ON w.rid = i.rid GROUP BY i.rid)""".strip() for n in sizes)
    spans = "".join(f", coalesce(n{n}.chars, 0) AS dup_chars_{n}" for n in sorted(quality.MAX_RUN_SHARE))
    bad = " OR ".join([f"dup_line_chars > {quality.MAX_LINE_SHARE} * line_chars", *(f"dup_chars_{n} > {s} * word_chars" for n, s in quality.MAX_RUN_SHARE.items())])
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(string_split_regex(text, '{SPACE}+'), lambda x: x <> '') AS words FROM d),
{runs},
l0 AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
l1 AS (SELECT rid, line, count(*) AS c FROM l0 WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid, line),
l AS (SELECT rid, CAST(sum(c - 1) AS BIGINT) AS n_dup_lines, CAST(sum(length(line) * c) AS BIGINT) AS line_chars, CAST(sum(length(line) * (c - 1)) AS BIGINT) AS dup_line_chars FROM l1 GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n3.covered, 0) AS n_repeat_words, coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars{spans}
  FROM w LEFT JOIN l USING (rid) {' '.join(f'LEFT JOIN n{n} USING (rid)' for n in sizes)}
),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_WORDS_PCT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT ({bad}) AS kept FROM b"""


# ---- 11: collocations ---------------------------------------------------------------------

def collocations_sql() -> str:
    """All phrases counted and scored, none left out by a bound."""
    cut = "CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST({l} AS HUGEINT) * {r}) AS BIGINT)"
    return f"""WITH p AS (SELECT row_number() OVER () AS pid, lang, words FROM (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)) WHERE len(words) > 0),
t AS MATERIALIZED (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p),
f1 AS MATERIALIZED (SELECT lang, words[i] AS x, count(*) AS c FROM t GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, words[i] AS x, words[i + 1] AS y, count(*) AS c FROM t WHERE i < len(words) GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
f3 AS MATERIALIZED (SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z, count(*) AS c FROM t WHERE i < len(words) - 1 GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
s2 AS (SELECT a.lang, a.x || ' ' || a.y AS phrase, a.c AS a, u.c AS l, v.c AS r FROM f2 a JOIN f1 u ON u.lang = a.lang AND u.x = a.x JOIN f1 v ON v.lang = a.lang AND v.x = a.y
  WHERE NOT EXISTS (SELECT 1 FROM f3 b WHERE b.lang = a.lang AND b.x = a.x AND b.y = a.y AND 100 * b.c >= {collocations.DROP_PERCENT} * a.c)
    AND NOT EXISTS (SELECT 1 FROM f3 b WHERE b.lang = a.lang AND b.y = a.x AND b.z = a.y AND 100 * b.c >= {collocations.DROP_PERCENT} * a.c)),
s3 AS (SELECT b.lang, b.x || ' ' || b.y || ' ' || b.z AS phrase, b.c AS a, u.c AS l1, h.c AS r1, g.c AS l2, v.c AS r2
  FROM f3 b JOIN f1 u ON u.lang = b.lang AND u.x = b.x JOIN f2 h ON h.lang = b.lang AND h.x = b.y AND h.y = b.z
  JOIN f2 g ON g.lang = b.lang AND g.x = b.x AND g.y = b.y JOIN f1 v ON v.lang = b.lang AND v.x = b.z),
c3 AS (SELECT *, {cut.format(l="l1", r="r1")} AS k1, {cut.format(l="l2", r="r2")} AS k2 FROM s3),
every AS (
  SELECT lang, phrase, a, l, r, {cut.format(l="l", r="r")} AS score FROM s2
  UNION ALL SELECT lang, phrase, a, CASE WHEN k1 <= k2 THEN l1 ELSE l2 END, CASE WHEN k1 <= k2 THEN r1 ELSE r2 END, least(k1, k2) FROM c3),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every) JOIN n USING (lang)
WHERE rank <= {collocations.LIMIT}"""


# ---- 12: Jaccard join ---------------------------------------------------------------------

def jaccard_sql() -> str:
    """Every pair that shares a shingle; components by repeated least ids along the links."""
    w = partenum.SHINGLE_WORDS
    return f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '{SPACE}+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT rid, array_to_string(words[i: i + {w - 1}], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - {w - 2}, 2))) AS i FROM d WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
l AS MATERIALIZED (
  SELECT a.rid AS u, b.rid AS v FROM s a JOIN s b ON a.gram = b.gram AND a.rid <> b.rid JOIN n x ON x.rid = a.rid JOIN n y ON y.rid = b.rid
  GROUP BY a.rid, b.rid, x.n, y.n HAVING 100 * count(*) >= {partenum.PERCENT} * (x.n + y.n - count(*))),
r AS (SELECT rid, rid AS near FROM d UNION SELECT r.rid, l.v FROM r JOIN l ON l.u = r.near)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id FROM r JOIN d ON d.rid = r.rid JOIN d o ON o.rid = r.near LEFT JOIN n ON n.rid = d.rid GROUP BY d.rid, d.doc_id"""


# ---- 13: centroids ------------------------------------------------------------------------

def centroids_sql() -> str:
    """Lloyd's rounds with every vector compared with every centroid."""
    fits = f"len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMS}"
    rounds = []
    for t in range(centroids.ROUNDS + 1):
        rounds.append(f"""
d{t} AS (SELECT p.rid, c.c, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM p JOIN c{t} c ON c.j = p.j GROUP BY p.rid, c.c),
a{t} AS MATERIALIZED (SELECT rid, c, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS o FROM d{t}) WHERE o = 1)""")
        if t < centroids.ROUNDS:
            rounds.append(f"""
s{t} AS (SELECT a.c, p.j, CAST(sum(p.x) AS BIGINT) AS s, count(*) AS n FROM a{t} a JOIN p ON p.rid = a.rid GROUP BY a.c, p.j),
c{t + 1} AS MATERIALIZED (SELECT c.c, c.j, CASE WHEN s.n IS NULL THEN c.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS x FROM c{t} c LEFT JOIN s{t} s ON s.c = c.c AND s.j = c.j)""")
    last = centroids.ROUNDS
    return f"""WITH k AS (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) - 1 AS rid, vec_id, embedding FROM embeddings WHERE {fits}),
p AS MATERIALIZED (SELECT rid, j, CAST(floor({centroids.SCALE} * CAST(embedding[j] AS DOUBLE)) AS BIGINT) AS x FROM k, range(1, {centroids.DIMS} + 1) r(j)),
c0 AS (SELECT rid AS c, j, x FROM p WHERE rid < {centroids.CLUSTERS}),
{','.join(r.strip() for r in rounds)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS told FROM c{last} GROUP BY c),
i AS (SELECT c, CAST(sum(d) AS BIGINT) AS own FROM a{last} GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, i.own AS cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{last}) AS inertia, h.told AS centroid_sha256
FROM a{last} a JOIN k ON k.rid = a.rid JOIN h ON h.c = a.c JOIN i ON i.c = a.c"""


ORACLES = {
    "op6_secret_scans": secrets_sql(),
    "op7_chat_formatting": chat_sql(),
    "op8_url_filters": urls_sql(),
    "op9_quality_rules": quality_sql(),
    "op11_collocation_mining": collocations_sql(),
    "op12_ngram_jaccard_join": jaccard_sql(),
    "op13_centroid_clustering": centroids_sql(),
}
