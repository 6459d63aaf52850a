"""SQL that gives the rows of the queries, written for an engine with lists and window functions (DuckDB)."""

from __future__ import annotations

from .compression import ENTRIES, PARTS, SCALE
from .mixing import MAX_EPOCHS, SEED, WEIGHTS
from .quality import STOP_FORMS, SYMBOLS, THRESHOLDS
from .url_filter import RULES, TWO_PART_SUFFIXES, Reputation
from .vector_dedup import COSINE
from .words import BLANKS, LOWER, UPPER, WORD


def listed(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def _op4() -> str:
    settings = Reputation()
    fits = [f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
            f"THEN '{verdict} {host}{path}'"
            for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    low, high = 1 / (1 + settings.most_strength), 1 / (1 + settings.least_strength)

    def strength(level: str) -> str:
        return f"""(SELECT 1 / least(greatest(CASE WHEN sum(n - 1) > 0
            THEN (sum(n * (b / n - m) * (b / n - m) / (m * (1 - m))) - count(*)) / sum(n - 1) ELSE 0.0 END,
            {low}), {high}) - 1 AS {level}_strength FROM {level}s, overall WHERE n > 0)"""

    return f"""
WITH addressed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
labelled AS (SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS b
  FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(b), 0) AS b
  FROM addressed LEFT JOIN labelled USING (page_id) GROUP BY host),
ended AS (SELECT *, string_split(host, '.') AS parts, CASE
  WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({listed(TWO_PART_SUFFIXES)})
  THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS suffix FROM counted),
hosts AS (SELECT host, suffix, n, b, CASE WHEN regexp_matches(host, '^[0-9.:]+$') THEN host
  ELSE array_to_string(parts[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain FROM ended),
overall AS (SELECT (coalesce(sum(b), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS m FROM hosts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY domain, suffix),
suffixs AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY suffix),
strengths AS (SELECT * FROM {strength("host")}, {strength("domain")}, {strength("suffix")}),
by_suffix AS (SELECT suffix, (m * suffix_strength + b) / (n + suffix_strength) AS prior
  FROM suffixs, overall, strengths),
by_domain AS (SELECT domain, d.suffix, (prior * domain_strength + b) / (n + domain_strength) AS prior
  FROM domains d JOIN by_suffix s ON d.suffix = s.suffix, strengths),
means AS (SELECT host, n, (prior * host_strength + b) / (n + host_strength) AS mean, n + host_strength AS weight
  FROM hosts h JOIN by_domain d ON h.domain = d.domain AND h.suffix = d.suffix, strengths),
bounds AS (SELECT host, n,
  greatest(0.0, mean - {settings.bound_sds} * sqrt(mean * (1 - mean) / (weight + 1))) AS low FROM means),
ruled AS (SELECT *, CASE {" ".join(fits)} END AS fit FROM addressed)
SELECT page_id, r.host, path, string_split(fit, ' ')[2] AS rule,
  coalesce(string_split(fit, ' ')[1], CASE WHEN low > {settings.limit} THEN 'block' ELSE 'allow' END) AS verdict,
  round(low, 4) AS bad_low, CAST(n AS BIGINT) AS n_labelled
FROM ruled r JOIN bounds USING (host)"""


# Each measure of the rules, in SQL over the columns of `counted` below.
MEASURE_SQL = {
    "n_words": "n_words", "n_stop_words": "n_stop_words",
    "mean_word_chars": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END",
    "symbols_per_word": "CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END",
    "marks_per_word": "CASE WHEN n_words > 0 THEN n_marks / n_words ELSE 0 END",
    "stop_words_per_word": "CASE WHEN n_words > 0 THEN n_stop_places / n_words ELSE 0 END",
    "repeat_words_share": "CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END",
    "dup_lines_share": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END",
    "cut_lines_share": "CASE WHEN n_lines > 0 THEN n_cut_lines / n_lines ELSE 0 END",
    "listed_lines_share": "CASE WHEN n_lines > 0 THEN n_listed_lines / n_lines ELSE 0 END",
}


def _op5() -> str:
    failed = []
    for name, measure, least, most in THRESHOLDS:
        value = MEASURE_SQL[measure]
        tests = [f"({value}) < {least}"] * (least is not None) + [f"({value}) > {most}"] * (most is not None)
        failed.append(f"CASE WHEN {' OR '.join(tests)} THEN '{name}' END")
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, list_filter(string_split_regex(t, '{BLANKS}'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{BLANKS}', '', 'g') <> '') AS ls FROM numbered),
places AS (SELECT row, ws, unnest(range(1, len(ws) - 1)) AS i FROM split),
windows AS (SELECT row, i, count(*) OVER (PARTITION BY row, ws[i], ws[i + 1], ws[i + 2]) AS n FROM places),
covered AS (SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM windows, (VALUES (0), (1), (2)) AS k(k)
  WHERE n > 1 GROUP BY row),
counted AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '{BLANKS}', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
  length(t) - length(translate(t, '!?…', '')) AS n_marks, len(ls) AS n_lines,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…){BLANKS[:-1]}*$'))) AS n_cut_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '^{BLANKS[:-1]}*[-*•]'))) AS n_listed_lines,
  len(list_filter(ws, lambda x: x IN ({listed(STOP_FORMS)}))) AS n_stop_places,
  len(list_distinct(list_filter(ws, lambda x: x IN ({listed(STOP_FORMS)})))) AS n_stop_words,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM split LEFT JOIN covered USING (row)),
judged AS (SELECT *, concat_ws(',', {", ".join(failed)}) AS failed,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed = '' AS kept, failed FROM judged"""


_OP7 = f"""
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
best AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM digests JOIN best USING (text_sha256)"""


def _op10() -> str:
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} {weight} END AS w,
  {MAX_EPOCHS} * source_size AS cap FROM sources),
filled AS (SELECT *, cap * (sum(w) OVER () - coalesce(sum(w) OVER before, 0))
    < w * (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) AS clamped FROM weighed
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE
  (w * (sum(source_size) OVER () - coalesce(sum(cap) FILTER (clamped) OVER (), 0)))::DOUBLE
  / (sum(w) FILTER (NOT clamped) OVER ())::DOUBLE END AS target FROM filled),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats
  FROM targets),
placed AS (SELECT s.doc_id, size, source_size, target, repeats,
  floor(target - repeats * source_size + 0.5)::BIGINT - coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY md5('{SEED}|' || coalesce(s.doc_id::VARCHAR, '')), s.doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  (repeats * size + greatest(0, least(size, room)))::BIGINT AS taken FROM placed"""


def _op13() -> str:
    """Codebooks after two rounds, each round as a join of all parts with all entries."""
    def assigned(n: int) -> str:
        return f"""a{n} AS (SELECT r, p, any_value(x) AS x, arg_min(k, d * {ENTRIES} + k) AS k, min(d) AS d FROM (
  SELECT r, p, x, k, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts JOIN c{n} USING (p)) GROUP BY r, p)"""

    def moved(n: int) -> str:
        return f"""c{n + 1} AS (SELECT p, k, coalesce(m, c) AS c FROM c{n} LEFT JOIN (
  SELECT p, k, list(m ORDER BY i) AS m FROM (
    SELECT p, k, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM a{n}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS i) GROUP BY p, k, i) GROUP BY p, k) USING (p, k))"""

    return f"""
WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id, v) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS (SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
          FROM whole, (SELECT unnest(range({PARTS})) AS p)),
c0 AS (SELECT p, r - 1 AS k, x AS c FROM parts WHERE r <= {ENTRIES}),
{assigned(0)}, {moved(0)}, {assigned(1)}, {moved(1)}, {assigned(2)},
coded AS (SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) FROM c2) AS codebooks_sha256
FROM whole JOIN coded USING (r)"""


_OP12 = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= {COSINE}),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
named AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM named"""


ORACLES = {
    "op4_url_filter": _op4(),
    "op5_quality_rules": _op5(),
    "op7_exact_dedup": _OP7,
    "op10_source_mixing": _op10(),
    "op12_embedding_dedup": _OP12,
    "op13_vector_codes": _op13(),
}
