"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from visitflow.llm import mixing

WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op3_topk_histogram"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, 65), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLES["op5_warc"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages
),
groups AS (
    SELECT payload, max(page_id) AS kept FROM payloads WHERE n >= 1000 GROUP BY payload
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN p.page_id < g.kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < g.kept THEN g.kept END AS refers_to
FROM payloads p LEFT JOIN groups g ON p.payload = g.payload AND p.n >= 1000
"""


def _weight(level: str) -> str:
    table = mixing.WEIGHTS[level]
    cases = "".join(f" WHEN '{k}' THEN {v}" for k, v in table.items() if k != "*")
    return f"CASE {level}{cases} ELSE {table['*']} END" if cases else str(table["*"])


def _pour(name: str, children: str, parent: str, budgets: str | None) -> str:
    """One level of the budget tree; see ``mixing._pour``."""
    keys = f"{parent}, " if parent else ""
    part = f"PARTITION BY {parent}" if parent else ""
    level = children.split(",")[-1].strip()
    source = f"JOIN {budgets} USING ({parent})" if budgets else "CROSS JOIN root"
    return f"""
{name}_nodes AS (
    SELECT {children}, weight, capacity, budget
    FROM (SELECT {children}, any_value(w_{level}) AS weight, sum(capacity) AS capacity FROM live GROUP BY {children}) {source}
),
{name}_line AS (
    SELECT *, sum(capacity) OVER line - capacity AS before,
           sum(weight) OVER (line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
    FROM {name}_nodes
    WINDOW line AS ({part} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {level})
),
{name}_dry AS (
    SELECT *, CAST(capacity AS DOUBLE) * CAST(left_weight AS DOUBLE)
              <= CAST(weight AS DOUBLE) * CAST(budget - before AS DOUBLE) AS dry
    FROM {name}_line
),
{name} AS (
    SELECT {children}, CASE WHEN dry THEN capacity ELSE least(capacity, CAST(floor(CAST(weight AS DOUBLE)
        * CAST(budget - sum(CASE WHEN dry THEN capacity ELSE 0 END) OVER ({part}) AS DOUBLE)
        / CAST(nullif(sum(CASE WHEN dry THEN 0 ELSE weight END) OVER ({part}), 0) AS DOUBLE)) AS HUGEINT)) END AS budget
    FROM {name}_dry
)"""


_DIGITS = "regexp_extract(coalesce(source, ''), '([0-9]+)', 1)"
_DOMAINS = ", ".join(f"'{d}'" for d in mixing.DOMAINS)

ORACLES["op6_mixing"] = f"""
WITH rows_ AS (
    SELECT doc_id,
        list_extract([{_DOMAINS}], CAST(coalesce(TRY_CAST(nullif(substr({_DIGITS}, 1, 9), '') AS BIGINT), 0) % {len(mixing.DOMAINS)} + 1 AS INTEGER)) AS domain,
        coalesce(lang, '{mixing.UNKNOWN}') AS lang, coalesce(source, '{mixing.UNKNOWN}') AS source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens,
        coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, '')) AS tail
    FROM documents
),
leaves AS (
    SELECT domain, lang, source, sum(n_tokens) AS tokens, {_weight("domain")} AS w_domain, {_weight("lang")} AS w_lang,
           {_weight("source")} AS w_source
    FROM rows_ GROUP BY domain, lang, source
),
live AS (
    SELECT *, tokens * {mixing.MAX_EPOCHS} AS capacity FROM leaves
    WHERE tokens > 0 AND w_domain > 0 AND w_lang > 0 AND w_source > 0
),
root AS (
    SELECT least(CAST(floor(CAST((SELECT sum(tokens) FROM leaves) AS DOUBLE) * CAST({mixing.TOTAL_SHARE} AS DOUBLE)) AS HUGEINT),
                 (SELECT sum(capacity) FROM live)) AS budget
),
{_pour("by_domain", "domain", "", None)},
{_pour("by_lang", "domain, lang", "domain", "by_domain")},
{_pour("by_source", "domain, lang, source", "domain, lang", "by_lang")},
plan AS (
    SELECT domain, lang, source, budget, CAST(budget // tokens AS INTEGER) AS full_epochs, budget % tokens AS rest
    FROM live JOIN by_source USING (domain, lang, source)
    WHERE budget > 0
),
keyed AS (
    SELECT *, md5('{mixing.SEED}|' || CAST(full_epochs + 1 AS VARCHAR) || '|' || tail) AS key
    FROM rows_ JOIN plan USING (domain, lang, source)
),
summed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed
),
counted AS (
    SELECT *, full_epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS epochs FROM summed
)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INTEGER) AS epoch
FROM (SELECT *, unnest(range(1, epochs + 1)) AS epoch FROM counted)
"""

ORACLES["op9_jaccard_join"] = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (
    SELECT d.doc_id, count(s.s) AS n FROM (SELECT doc_id FROM documents) d LEFT JOIN shingles s USING (doc_id) GROUP BY d.doc_id
),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 90 * (x.n + y.n - c)
),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, CAST(any_value(s.n) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM reach r JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({lower}, '{TERM}')) AS term FROM {table}"


ORACLES["op12_lexical"] = f"""
WITH postings AS (
    SELECT doc_id, term, count(*) AS tf FROM ({_terms("documents", "doc_id")}) GROUP BY doc_id, term
),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
normed AS (SELECT doc_id, 75 + ((25 * n * docs) // terms) AS m FROM lengths, corpus),
asked AS (SELECT item_id, term, count(*) AS times FROM ({_terms("benchmark", "item_id")}) GROUP BY item_id, term),
weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN weighed USING (term) JOIN postings USING (term) JOIN normed USING (doc_id)
    GROUP BY item_id, doc_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLES["op13_epsilon_grid"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size
    FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) >= 0.95 * a.size * b.size
),
reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r.other) AS component_id,
       r.vec_id = min(r.other) AS kept
FROM reach r LEFT JOIN counted c ON c.vec_id = r.vec_id GROUP BY r.vec_id
"""
