"""DuckDB SQL of the training-data queries that SQL can express.

Written with window functions and the gamma function, unlike the Spark plans
(arrays within a row, sums of probabilities term by term).
"""

from __future__ import annotations

from snapledger.llm.rules import LEAST_WORDS, LIMIT, MOST_REPEATED, RISK, RULES, STEPS

_SPACE = r"\x20\x09-\x0D"
_SHARE = f"CAST({LIMIT!r} AS DOUBLE)"
_RATES = {
    "symbols": f"CASE WHEN word_chars > 0 THEN {STEPS} * n_symbols // word_chars ELSE 0 END",
    "dup_lines": f"CASE WHEN n_lines > 0 THEN {STEPS} * n_dup_lines // n_lines ELSE 0 END",
    "repeats": f"CASE WHEN n_words > 0 THEN {STEPS} * n_repeat_words // n_words ELSE 0 END",
    "long_words": f"least({STEPS}, CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END)",
    "short_words": f"{STEPS} - least({STEPS}, CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END)",
}

QUALITY_RULES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN lang IS NULL THEN '!' ELSE '=' || lang END AS stratum,
         coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w
  FROM documents
),
windows AS (
  SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 2)
),
again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
covered AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY row),
lines AS (
  SELECT row, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^{_SPACE}]')] AS l FROM docs
),
measured AS (
  SELECT d.row, d.doc_id, d.stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[{_SPACE}]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d JOIN lines USING (row) LEFT JOIN covered c USING (row)
),
rated AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         {", ".join(f"{sql} AS {name}" for name, sql in _RATES.items())}
  FROM measured
),
told AS (
  SELECT doc_id, min(quality) = 1 AND max(coalesce(toxic, 0)) = 0 AS good, min(quality) = 0 AS bad,
         md5(CAST(doc_id AS VARCHAR))[1] >= '8' AS holdout
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
one AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY stratum, base_failed, {", ".join(RULES)}) = 1
),
judged AS (SELECT o.*, t.good, t.bad, t.holdout FROM one o JOIN told t ON o.doc_id = t.doc_id WHERE NOT base_failed),
each_rule AS ({" UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, {r} AS rate, good, bad, holdout FROM judged" for r in RULES)}),
steps AS (
  SELECT a.stratum, a.rule, a.rate,
         count(*) FILTER (b.good AND NOT b.holdout) AS tune_good, count(*) FILTER (b.bad AND NOT b.holdout) AS tune_bad,
         count(*) FILTER (b.good AND b.holdout) AS hold_good,
         count(*) FILTER (b.good AND NOT b.holdout AND b.rate > a.rate) AS tune_good_above,
         count(*) FILTER (b.bad AND NOT b.holdout AND b.rate > a.rate) AS tune_bad_above,
         count(*) FILTER (b.good AND b.holdout AND b.rate > a.rate) AS hold_good_above
  FROM (SELECT DISTINCT stratum, rule, rate FROM each_rule) a JOIN each_rule b ON a.stratum = b.stratum AND a.rule = b.rule
  GROUP BY ALL
),
tried AS (
  SELECT * FROM steps WHERE tune_good_above <= floor(tune_good * ({_SHARE} / {len(RULES)}))
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY rate) = 1
),
placed AS (SELECT stratum, rule FROM tried WHERE tune_bad_above * tune_good > tune_good_above * tune_bad),
tests AS (
  SELECT s.stratum, s.rule, any_value(s.hold_good) AS n, {_SHARE} / any_value(p.rules) AS share, CAST({RISK!r} AS DOUBLE) / any_value(p.tests) AS error
  FROM steps s JOIN (SELECT *, count(*) OVER (PARTITION BY stratum) AS rules, count(*) OVER () AS tests FROM placed) p USING (stratum, rule) GROUP BY s.stratum, s.rule
),
sums AS (
  SELECT stratum, rule, error, k, sum(exp(lgamma(n + 1) - CASE WHEN k > 0 THEN lgamma(k + 1) ELSE 0 END - lgamma(n - k + 1) + k * ln(share) + (n - k) * ln(1 - share)))
                            OVER (PARTITION BY stratum, rule ORDER BY k) AS p
  FROM (SELECT *, unnest(range(0, CAST(ceil(n * share) AS BIGINT))) AS k FROM tests WHERE n > 0)
),
bounded AS (SELECT stratum, rule, max(k) AS allowed FROM sums WHERE p <= error GROUP BY stratum, rule),
cuts AS (
  SELECT s.stratum, s.rule, min(s.rate) AS cut FROM steps s JOIN bounded b USING (stratum, rule)
  WHERE s.hold_good_above <= b.allowed GROUP BY s.stratum, s.rule
),
rejected AS (
  SELECT DISTINCT r.row FROM ({" UNION ALL ".join(f"SELECT row, stratum, '{r}' AS rule, {r} AS rate FROM rated" for r in RULES)}) r
  JOIN cuts c USING (stratum, rule) WHERE r.rate > c.cut
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row NOT IN (SELECT row FROM rejected) AS kept
FROM rated"""
