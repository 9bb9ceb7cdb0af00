"""DuckDB SQL of the registered queries of this subpackage that SQL can express.

The others (BPE, suffix automata, winnowed runs, components, token automata, HTML, bootstrapped contexts, hashed
signatures) are compared with brute-force versions in ``tests/llm``.
"""

from rosband.llm import mixing, quality

_WORDS = r"list_filter(regexp_split_to_array({0}, '[ \t-\r]+'), lambda x: x <> '')"
_TEXT = "coalesce(text, '')"

OP4 = f"""
WITH d AS (
  SELECT doc_id, {_TEXT} AS t, coalesce(source, '') AS host, coalesce(doc_id, 9223372036854775807) AS k,
         {_WORDS.format(_TEXT)} AS w
  FROM documents
), u AS (SELECT DISTINCT k, t, host, w FROM d),
win AS (
  SELECT k, t, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT k, t, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT DISTINCT k, t, w FROM u))
), again AS (SELECT k, t, i FROM (SELECT *, count(*) OVER (PARTITION BY k, t, s) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT k, t, count(DISTINCT p) AS n FROM (SELECT k, t, unnest(range(i, i + 8)) AS p FROM again) GROUP BY k, t
), raw AS (SELECT k, t, host, unnest(string_split(t, chr(10))) AS line FROM u),
wordy AS (
  SELECT *, array_to_string({_WORDS.format("regexp_replace(lower(line), '[0-9]+', '0', 'g')")}, ' ') AS norm,
         len({_WORDS.format("line")}) AS n
  FROM raw WHERE len({_WORDS.format("line")}) > 0
), dup AS (SELECT k, t, host, count(*) - count(DISTINCT line) AS n FROM wordy GROUP BY k, t, host),
carried AS (SELECT host, norm, count(DISTINCT t) AS n, min(k) AS first_k FROM wordy GROUP BY host, norm),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM u GROUP BY host),
above AS (
  SELECT c.host, c.norm, c.first_k FROM carried c JOIN hosts h USING (host)
  WHERE c.n > {quality.MIN_DOCS} AND (c.n > {quality.MAX_DOCS} OR c.n > CAST({quality.HOST_SHARE} AS DOUBLE) * h.n)
), gone AS (
  SELECT y.k, y.t, y.host, sum(y.n) AS n FROM wordy y JOIN above a ON y.host = a.host AND y.norm = a.norm AND y.k <> a.first_k
  GROUP BY y.k, y.t, y.host
), c AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(d.t, '[ \\t-\\r]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dup ON dup.k = d.k AND dup.t = d.t AND dup.host = d.host
  LEFT JOIN rep ON rep.k = d.k AND rep.t = d.t LEFT JOIN gone ON gone.k = d.k AND gone.t = d.t AND gone.host = d.host
), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT (removed_words > 0 AND n_words - removed_words < CAST({quality.KEEP_WORDS} AS DOUBLE) * n_words) AS kept
FROM b
"""


def _weight(level: str) -> str:
    """Weight of the node in column ``level``."""
    cases = " ".join(f"WHEN '{node}' THEN CAST({weight} AS DOUBLE)" for node, weight in mixing.WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE CAST(1.0 AS DOUBLE) END"


def _level(name: str, parents: list[str], level: str) -> str:
    """Budgets of the children ``level`` of the nodes in ``given_<name>``."""
    keys = ", ".join([*parents, level])
    on = " AND ".join(f"n.{p} = g.{p}" for p in parents) or "true"
    part = f"PARTITION BY {', '.join('n.' + p for p in parents)}" if parents else ""
    same = f"PARTITION BY {', '.join(parents)}" if parents else ""
    return f"""
n_{level} AS (SELECT {keys}, sum(capacity) AS capacity, {_weight(level)} AS weight FROM caps GROUP BY {keys}),
l_{level} AS (
  SELECT n.*, (g.given - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM n_{level} n JOIN given_{name} g ON {on}
  WINDOW w AS ({part} ORDER BY capacity / weight, {', '.join(f'n.{p}' for p in [*parents, level])})
),
given_{level} AS (
  SELECT {keys}, CASE WHEN capacity <= lev * weight THEN capacity
                      ELSE weight * max(CASE WHEN capacity > lev * weight THEN lev END) OVER ({same}) END AS given
  FROM l_{level}
)"""


OP9 = f"""
WITH rows_ AS (
  SELECT doc_id, md5({_TEXT}) AS h,
         'domain' || CAST(ascii(substr(md5(coalesce(source, '')), 1, 1)) % 4 AS VARCHAR) AS domain,
         coalesce(lang, '') AS language, coalesce(source, '') AS leaf_source,
         CAST(len({_WORDS.format(_TEXT)}) AS BIGINT) AS n_tokens
  FROM documents
), thin AS (
  SELECT doc_id, h, domain, language, leaf_source, any_value(n_tokens) AS own, count(*) AS rows_, any_value(n_tokens) * count(*) AS tok
  FROM rows_ GROUP BY doc_id, h, domain, language, leaf_source
), leaves AS (SELECT domain, language, leaf_source, sum(tok) AS tokens FROM thin GROUP BY ALL),
caps AS (SELECT *, CAST(tokens * {mixing.EPOCHS} AS DOUBLE) AS capacity FROM leaves),
given_root AS (
  SELECT least(floor(CAST(sum(tokens) AS DOUBLE) * CAST({mixing.BUDGET_SHARE} AS DOUBLE)), sum(capacity)) AS given FROM caps
),{_level("root", [], "domain")},{_level("domain", ["domain"], "language")},{_level("language", ["domain", "language"], "leaf_source")},
quota AS (
  SELECT l.*, CAST(floor(g.given) AS BIGINT) AS q FROM leaves l JOIN given_leaf_source g USING (domain, language, leaf_source)
), plan AS (
  SELECT *, CASE WHEN tokens > 0 THEN least({mixing.EPOCHS}, q // tokens) ELSE {mixing.EPOCHS} END AS whole FROM quota
), ordered AS (
  SELECT t.*, p.whole, p.q - p.whole * p.tokens AS rest, sum(t.tok) OVER (
           PARTITION BY t.domain, t.language, t.leaf_source
           ORDER BY md5('{mixing.SEED}:' || CAST(p.whole AS VARCHAR) || ':' || coalesce(CAST(t.doc_id AS VARCHAR), '')), t.h
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM thin t JOIN plan p USING (domain, language, leaf_source)
), taken AS (
  SELECT doc_id, domain, language, leaf_source, own AS n_tokens, rows_,
         CAST(whole + CASE WHEN whole < {mixing.EPOCHS} AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM ordered
)
SELECT doc_id, domain, language, leaf_source, n_tokens, copies FROM (SELECT *, unnest(range(0, rows_)) AS r FROM taken)
"""

SQL: dict[str, str] = {"op4_quality_rules": OP4, "op9_source_mix": OP9}
