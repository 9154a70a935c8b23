"""DuckDB SQL of the results that SQL can express."""

from __future__ import annotations

from vigil.llm.quality import FALSE_COST, LADDER, MIN_WORDS, REPEAT_PERCENT, RULES

WORD = "'[^\\x20\\x09-\\x0D]+'"


def quality_features(docs: str = "documents") -> str:
    """doc_id, lang and the base features, by windows as rows."""
    return f"""
base AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM {docs}),
words AS (SELECT r, w, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM base),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM words WHERE i + 7 <= len(w)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(8) AS t(k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM base) WHERE regexp_matches(l, {WORD}) GROUP BY r),
features AS (
  SELECT base.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM base LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM features)"""


def quality(limit: float = 0.05, delta: float = 0.05) -> str:
    share = limit / len(RULES)
    scores = " UNION ALL ".join(
        f"SELECT r, lang, good, {i} AS rule, {s} AS s FROM labelled" for i, s in enumerate(RULES.values())
    )
    cuts = ", ".join(f"({j}, {c})" for j, c in enumerate(LADDER, start=1))
    exceeded = " OR ".join(
        f"coalesce({s} > (SELECT cutoff FROM best b WHERE b.lang IS NOT DISTINCT FROM f.lang AND b.rule = {i}), false)"
        for i, s in enumerate(RULES.values())
    )
    return f"""WITH {quality_features()},
marks AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
labelled AS (SELECT j.*, good FROM judged j JOIN marks USING (doc_id) WHERE NOT base_failed),
scores AS ({scores}),
rungs AS (SELECT * FROM (VALUES {cuts}) t(rung, cutoff)),
counts AS (
  SELECT lang, rule, rung, cutoff, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE NOT good) AS m,
         count(*) FILTER (WHERE good AND s > cutoff) AS k, count(*) FILTER (WHERE NOT good AND s > cutoff) AS hit
  FROM scores, rungs GROUP BY ALL),
strata AS (SELECT count(DISTINCT coalesce(lang, chr(0))) AS strata FROM scores),
terms AS (
  SELECT lang, rule, rung, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share})
                                  + (n - i) * ln(1 - {share}))) AS p
  FROM counts, range(0, 100000) AS t(i) WHERE i <= k AND k < n * {share} GROUP BY ALL),
tested AS (
  SELECT counts.*, coalesce(p <= {delta} / (strata * {len(RULES)}), false) AS ok
  FROM counts CROSS JOIN strata LEFT JOIN terms
  ON counts.lang IS NOT DISTINCT FROM terms.lang AND counts.rule = terms.rule AND counts.rung = terms.rung),
certified AS (
  SELECT *, hit / greatest(m, 1) - {FALSE_COST} * k / greatest(n, 1) AS gain FROM (
    SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY rung) AS so_far FROM tested) WHERE so_far),
best AS (SELECT lang, rule, arg_max(cutoff, (gain, -rung)) AS cutoff FROM certified WHERE gain > 0 GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({exceeded}) AS kept FROM judged f"""


def line_dedup_parts(docs: str, min_words: int = 50) -> str:
    """CTEs up to ``deduped`` (doc_id, n_lines, n_removed, text): every window of the
    least number of lines, compared by the lines themselves."""
    return f"""
ld AS (SELECT doc_id, text, string_split(text, chr(10)) AS all_lines,
       list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {WORD})) AS w FROM {docs}),
ll AS (SELECT doc_id, w, unnest(w) AS line, generate_subscripts(w, 1) AS pos FROM ld),
lc AS (SELECT doc_id, w, pos, len(regexp_extract_all(line, {WORD})) AS n,
       sum(len(regexp_extract_all(line, {WORD}))) OVER (PARTITION BY doc_id ORDER BY pos) AS c FROM ll),
lw AS (
  SELECT a.doc_id, a.w, a.pos AS s, min(b.pos) AS e FROM lc a JOIN lc b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + {min_words} AND b.c - a.c + a.n >= {min_words} GROUP BY ALL
  UNION
  SELECT b.doc_id, b.w, max(a.pos) AS s, b.pos AS e FROM lc a JOIN lc b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + {min_words} AND b.c - a.c + a.n >= {min_words} GROUP BY ALL),
lf AS (SELECT doc_id, s, e, first_value((doc_id, s)) OVER (PARTITION BY w[s:e] ORDER BY doc_id, s) AS f FROM lw),
lg AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM lf WHERE f <> (doc_id, s)),
ln AS (SELECT doc_id, count(*) AS n_removed FROM lg GROUP BY 1),
lk AS (SELECT doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS i FROM ld),
lp AS (SELECT *, CASE WHEN regexp_matches(line, {WORD}) THEN sum(CAST(regexp_matches(line, {WORD}) AS INT))
       OVER (PARTITION BY doc_id ORDER BY i) END AS pos FROM lk),
lt AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS t FROM (
       SELECT lp.*, lg.pos IS NOT NULL AS gone FROM lp LEFT JOIN lg ON lp.doc_id = lg.doc_id AND lp.pos = lg.pos) GROUP BY 1),
deduped AS (SELECT ld.doc_id, CAST(len(w) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN ld.text IS NULL THEN NULL ELSE t END AS text
       FROM ld LEFT JOIN ln USING (doc_id) LEFT JOIN lt USING (doc_id))"""


def line_dedup() -> str:
    return f"WITH {line_dedup_parts('documents')} SELECT doc_id, n_lines, n_removed, text FROM deduped"
