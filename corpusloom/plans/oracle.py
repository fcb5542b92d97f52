"""The same results in plain SQL, for an independent engine over the same tables.

Written from the definitions of the operators, not from their plans: whole
chains are spelled out as common table expressions.
"""

from corpusloom.functions.fixed_values import EXCLUDED_WORDS, FILTER_WORD_LINES, LANGUAGE_NAMES, STOP_WORDS, VOCABULARY_SIZE
from corpusloom.operators.graph import ROUNDS
from corpusloom.operators.language import FIT_DOCUMENTS
from corpusloom.plans.queries import EXCLUDED_HEAD, JOB, KEY_GROUPS, MONTH, SAMPLE_PATHS


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP = ", ".join(literal(w) for w in STOP_WORDS)
FILTERS = ", ".join(f"({literal(w)})" for w in FILTER_WORD_LINES)
EXCLUDES = ", ".join(f"({literal(w)})" for w in EXCLUDED_WORDS)
NAMES = ", ".join(f"({literal(c)}, {literal(n)})" for c, n in LANGUAGE_NAMES)


def words(text: str) -> str:
    """Tokens of a text column before stop words are removed, as a list."""
    blanked = f"lower(regexp_replace({text}, '[^-.a-zA-Z]', ' ', 'g'))"
    return f"list_filter(string_split({blanked}, ' '), lambda t: length(t) > 2)"


def kept(text: str) -> str:
    return f"list_filter({words(text)}, lambda t: t NOT IN ({STOP}))"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# Derived inputs

FILE_PATHS = """paths AS MATERIALIZED (
  SELECT '2015-' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') AS year_month,
         CASE WHEN page_id % 50 = 49 THEN '' ELSE url END AS file_path,
         CASE WHEN page_id % 3 = 0 THEN page_id % 5 END AS job_id
  FROM pages)"""

RECORDS = """records AS (
  SELECT '<urn:uuid:' || doc_id || '>' AS record_id, source AS file,
         'http://' || source || '.example.com/' || doc_id AS uri,
         '2015-07-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' 17:46:11.000000' AS warc_date,
         CASE WHEN doc_id % 10 = 9 THEN 'application/warc-fields' ELSE 'text/plain' END AS content_type,
         regexp_replace(text, '[\\r\\n]+$', '') AS text
  FROM documents)"""

PERIODS = """counts AS MATERIALIZED (
  SELECT CAST(substring(source, 4) AS INTEGER) AS period, lang, count(*) AS n
  FROM documents GROUP BY ALL)"""

MONTHLY = """files AS (
  SELECT '2015-' || lpad(CAST(CASE WHEN page_id % 3 = 0 THEN page_id % 12 ELSE page_id % 20 % 6 END + 1 AS VARCHAR), 2, '0') AS year_month,
         page_id % 20 AS job_id
  FROM pages WHERE page_id % 11 <> 0),
months AS (
  SELECT job_id, year_month FROM (SELECT job_id, year_month, count(*) AS n FROM files WHERE job_id <> 0 GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY n DESC, year_month) = 1),
monthly AS MATERIALIZED (
  SELECT year_month, lang, CAST(sum(n) AS BIGINT) AS n FROM named JOIN months USING (job_id) GROUP BY ALL)"""

NAMED = f"""names(lang, name) AS (VALUES {NAMES}),
named AS (
  SELECT CAST(substring(source, 4) AS BIGINT) AS job_id, name AS lang, count(*) AS n
  FROM documents JOIN names USING (lang) GROUP BY ALL)"""

# Vocabulary and weights of the English documents

EN = "en AS MATERIALIZED (SELECT doc_id, text FROM documents WHERE lang = 'en')"


def counted(name: str, source: str, ids: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {ids}, term, count(*) AS c
  FROM (SELECT {ids}, unnest({kept('text')}) AS term FROM {source}) GROUP BY ALL)"""


def weighted(name: str, tokens: str, ids: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT {ids}, idx, term, c, c / norm AS tf, c / norm * idf AS w
  FROM {tokens}
  JOIN (SELECT {ids}, sqrt(CAST(sum(c * c) AS DOUBLE)) AS norm FROM {tokens} GROUP BY ALL) USING ({ids})
  JOIN idf USING (term))"""


TOK = counted("tok", "en", "doc_id")
VOCABULARY = f"""vocabulary AS MATERIALIZED (
  SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx
  FROM (SELECT term, count(*) AS df FROM tok GROUP BY term ORDER BY df DESC, term LIMIT {VOCABULARY_SIZE}))"""
IDF = """idf AS MATERIALIZED (
  SELECT term, df, idx, ln(CAST((SELECT count(*) FROM en) + 1 AS DOUBLE) / (df + 1)) AS idf
  FROM vocabulary)"""
W = weighted("w", "tok", "doc_id")
WEIGHTS = [EN, TOK, VOCABULARY, IDF, W]

BENCHMARK_WORDS = f"extra AS (SELECT DISTINCT unnest({kept('text')}) AS term FROM benchmark)"
NOISE_WORDS = f"""noise AS (
  SELECT term FROM (SELECT DISTINCT conv_id, turn, unnest({kept('text')}) AS term FROM conversations)
  GROUP BY term ORDER BY count(*) DESC, term LIMIT {EXCLUDED_HEAD})"""
# The distinct above is per row: (conv_id, turn) is the key of conversations.

# One Lloyd step and the assignment after it

SIZE = """size AS (
  SELECT CAST(least(greatest(floor(sqrt((SELECT count(*) FROM en) // 2)), 2), 100) AS BIGINT) AS k)"""
SEEDS = """center0 AS MATERIALIZED (
  SELECT cluster_id, idx, term, w
  FROM w JOIN (
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS cluster_id
    FROM (SELECT DISTINCT doc_id FROM w WHERE w <> 0)) USING (doc_id)
  WHERE cluster_id < (SELECT k FROM size) AND w <> 0)"""


def assigned(name: str, docs: str, weights: str, ids: str, centers: str) -> str:
    return f"""{name} AS MATERIALIZED (
  WITH x AS (SELECT {ids}, sum(w * w) AS x2 FROM {weights} GROUP BY ALL),
  c AS (SELECT cluster_id, sum(w * w) AS c2 FROM {centers} GROUP BY ALL),
  dots AS (
    SELECT {ids}, cluster_id, sum(a.w * b.w) AS dot
    FROM {weights} a JOIN {centers} b USING (idx) GROUP BY ALL),
  scored AS (
    SELECT {ids}, cluster_id, c2, coalesce(x2, 0) AS x2, coalesce(dot, 0) AS dot,
           coalesce(x2, 0) - 2 * coalesce(dot, 0) + c2 AS d2
    FROM (SELECT {ids} FROM {docs}) CROSS JOIN c
    LEFT JOIN x USING ({ids}) LEFT JOIN dots USING ({ids}, cluster_id))
  SELECT {ids}, cluster_id, d2, dot / nullif(sqrt(x2 * c2), 0) AS cos_sim
  FROM scored
  QUALIFY row_number() OVER (PARTITION BY {ids} ORDER BY round(d2, 9), cluster_id) = 1)"""


FIRST = assigned("first", "en", "w", "doc_id", "center0")
CENTERS = """center AS MATERIALIZED (
  SELECT cluster_id, idx, term, sum(w) / any_value(n) AS w
  FROM w JOIN first USING (doc_id)
  JOIN (SELECT cluster_id, count(*) AS n FROM first GROUP BY ALL) USING (cluster_id)
  GROUP BY cluster_id, idx, term HAVING sum(w) <> 0)"""
FINAL = assigned("final", "en", "w", "doc_id", "center")
LLOYD = [*WEIGHTS, SIZE, SEEDS, FIRST, CENTERS]
CLUSTERED = [*LLOYD, FINAL]
SIZES = """sizes AS MATERIALIZED (
  SELECT cluster_id, count(doc_id) AS num_docs
  FROM (SELECT unnest(range(k)) AS cluster_id FROM size) LEFT JOIN final USING (cluster_id)
  GROUP BY cluster_id)"""
KEYWORDS = """keywords AS MATERIALIZED (
  SELECT cluster_id, term, w AS weight,
         row_number() OVER (PARTITION BY cluster_id ORDER BY round(w, 8) DESC, term) AS rank
  FROM center WHERE w > 0 QUALIFY rank <= 100)"""
TOPDOCS = """top AS MATERIALIZED (
  SELECT cluster_id, doc_id, cos_sim FROM final
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY round(cos_sim, 9) DESC NULLS LAST, doc_id) = 1)"""
LARGEST = "largest AS (SELECT * FROM sizes ORDER BY num_docs DESC, cluster_id LIMIT 100)"
REPORTED = "reported AS (SELECT * FROM sizes ORDER BY num_docs DESC, cluster_id LIMIT 20)"

# Graphs

JACCARD = """edges AS MATERIALIZED (
  WITH n AS (SELECT cluster_id, count(*) AS n FROM keywords GROUP BY ALL),
  shared AS (
    SELECT a.cluster_id AS src, b.cluster_id AS dst, CAST(count(*) AS DOUBLE) AS i
    FROM keywords a JOIN keywords b ON a.term = b.term AND a.cluster_id < b.cluster_id GROUP BY ALL)
  SELECT src, dst, i / (p.n + q.n - i) AS weight
  FROM shared JOIN n p ON p.cluster_id = src JOIN n q ON q.cluster_id = dst)"""
DOCUMENT_EDGES = """edges AS MATERIALIZED (
  SELECT doc_id AS src, -1 - idx AS dst, w AS weight FROM w WHERE w > 0)"""


def propagated(rounds: int = ROUNDS) -> list[str]:
    parts = [
        """links AS MATERIALIZED (
  SELECT src AS node, dst AS neighbour, weight FROM edges
  UNION ALL SELECT dst, src, weight FROM edges)""",
        "labels0 AS MATERIALIZED (SELECT DISTINCT node, node AS label FROM links)",
    ]
    for step in range(2 * rounds):
        second = f"substring(md5(node || '#{step // 2}'), 8, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f')"
        parts.append(f"""labels{step + 1} AS MATERIALIZED (
  WITH voted AS (
    SELECT links.node, l.label, round(sum(weight), 9) AS weight
    FROM links JOIN labels{step} l ON l.node = neighbour GROUP BY links.node, l.label),
  best AS (
    SELECT node, voted.label FROM voted JOIN labels{step} own USING (node)
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY weight DESC, voted.label <> own.label, voted.label) = 1)
  SELECT node, CASE WHEN ({second}) = {step % 2 == 1} THEN best.label ELSE own.label END AS label
  FROM labels{step} own JOIN best USING (node))""")
    parts.append(f"""labels AS MATERIALIZED (
  SELECT node, label, NOT EXISTS (
    SELECT 1 FROM labels{2 * rounds} a JOIN labels{2 * rounds - 2} b USING (node) WHERE a.label <> b.label) AS converged
  FROM labels{2 * rounds})""")
    return parts


MODULARITY = """whole AS (SELECT sum(weight) AS total FROM edges),
degrees AS (
  SELECT label, sum(weight) AS degree FROM links JOIN labels USING (node) GROUP BY label),
inside AS (
  SELECT a.label, sum(weight) AS inner_weight
  FROM edges JOIN labels a ON a.node = src JOIN labels b ON b.node = dst
  WHERE a.label = b.label GROUP BY a.label)"""

# Language model

def trigrams(train: str, scored: str) -> str:
    """Model of the rows that ``train`` selects, predictions for those of ``scored``."""
    return f"""grams AS MATERIALIZED (
  SELECT doc_id, lang, gram, count(*) AS c FROM (
    SELECT doc_id, lang, substring(t, unnest(range(1, length(t) - 1)), 3) AS gram
    FROM (SELECT doc_id, lang,
            CASE WHEN length(text) > 1400 THEN substring(text, 401, 1000) ELSE text END AS t
          FROM documents)) GROUP BY ALL),
trained AS MATERIALIZED (
  SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL AND {train} ORDER BY md5(text), lang LIMIT {FIT_DOCUMENTS}),
known AS MATERIALIZED (SELECT DISTINCT gram FROM grams JOIN trained USING (doc_id)),
langs AS (SELECT lang, count(*) AS docs FROM trained GROUP BY lang),
seen AS (SELECT t.lang, gram, sum(c) AS n FROM grams JOIN trained t USING (doc_id) GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM seen GROUP BY lang),
model AS MATERIALIZED (
  SELECT l.lang AS label, k.gram,
         ln(CAST(coalesce(s.n, 0) + 1 AS DOUBLE) / (t.n + (SELECT count(*) FROM known))) AS score
  FROM langs l CROSS JOIN known k JOIN totals t ON t.lang = l.lang
  LEFT JOIN seen s ON s.lang = l.lang AND s.gram = k.gram),
priors AS (
  SELECT lang AS label, ln(CAST(docs + 1 AS DOUBLE) /
         ((SELECT count(*) FROM trained) + (SELECT count(*) FROM langs))) AS prior
  FROM langs),
summed AS (
  SELECT doc_id, label, sum(c * score) AS score FROM grams JOIN model USING (gram) GROUP BY ALL),
predictions AS (
  SELECT d.doc_id, d.lang, p.label AS predicted
  FROM documents d CROSS JOIN priors p LEFT JOIN summed s ON s.doc_id = d.doc_id AND s.label = p.label
  WHERE {scored}
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY prior + coalesce(score, 0) DESC, p.label) = 1)"""


ORACLE = {
    "S1_crawl_documents": with_(RECORDS) + """
SELECT record_id AS doc_id, uri, warc_date, content_type, text FROM records WHERE content_type = 'text/plain'""",
    "S2_record_fields": with_(RECORDS) + "SELECT * FROM records",
    "S3_plain_text_records": with_(RECORDS)
    + "SELECT file, count(*) AS n FROM records WHERE content_type = 'text/plain' GROUP BY file",
    "S4_word_list": with_(BENCHMARK_WORDS) + "SELECT term FROM extra",
    "S5_backlog_new": with_(FILE_PATHS) + """
SELECT DISTINCT year_month, file_path FROM paths
EXCEPT SELECT year_month, file_path FROM paths WHERE job_id IS NOT NULL""",
    "S6_backlog_sample": with_(FILE_PATHS) + f"""
SELECT year_month, file_path FROM paths
WHERE year_month = '{MONTH}' AND file_path <> '' AND job_id IS NULL
ORDER BY md5(file_path || '#0'), file_path LIMIT {SAMPLE_PATHS}""",
    "S7_backlog_claim": with_(FILE_PATHS)
    + "SELECT year_month, file_path, coalesce(job_id, 200) AS job_id FROM paths",
    "J8_claimed_by_job": with_(FILE_PATHS) + """
SELECT year_month, coalesce(job_id, 200) AS job_id, count(*) AS n FROM paths GROUP BY ALL""",
    "S8_job_languages": with_(NAMED) + 'SELECT job_id, lang, n AS "count" FROM named',
    "S12_run_ledger": """
WITH run AS (
  SELECT user_id AS job_id, ts, event_id,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'STARTED' ELSE 'COMPLETED' END AS status,
         CASE event_type WHEN 'error' THEN props END AS err_text
  FROM events)
SELECT job_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start_ts,
       strftime(max(ts) FILTER (status <> 'STARTED'), '%Y-%m-%d %H:%M:%S.%f') AS end_ts,
       arg_max(status, row(ts, event_id)) AS job_status,
       arg_max(err_text, row(ts, event_id)) FILTER (status = 'ERROR') AS err_text
FROM run GROUP BY job_id""",
    "S13_key_violations": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows FROM ("
        f"SELECT {group} AS g, count(*) AS n FROM documents GROUP BY {group} HAVING count(*) > 1)"
        for name, group in KEY_GROUPS.items()
    ),
    "F1_english_documents": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'",
    "F2_keyword_documents": with_(BENCHMARK_WORDS) + f"""
SELECT doc_id FROM (SELECT doc_id, unnest({kept('text')}) AS term FROM documents)
WHERE term IN (SELECT term FROM extra WHERE length(term) > 5 AND (term LIKE '%.%' OR term LIKE '%-%')) GROUP BY doc_id HAVING count(*) >= 2""",
    "F2_shipped_filter_list": f"""
WITH listed AS (SELECT DISTINCT unnest({kept('w')}) AS term FROM (VALUES {FILTERS}) v(w))
SELECT doc_id, count(*) AS hits FROM (
  SELECT doc_id, unnest({kept('text')}) AS term FROM (
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' ' || lines[doc_id % {len(FILTER_WORD_LINES)} + 1] ELSE text END AS text
    FROM documents, (SELECT [{', '.join(map(literal, FILTER_WORD_LINES))}] AS lines)))
JOIN listed USING (term) GROUP BY doc_id""",
    "J4_shipped_exclude_list": f"""
WITH listed AS (SELECT DISTINCT unnest({kept('w')}) AS term FROM (VALUES {EXCLUDES}) v(w))
SELECT term, count(DISTINCT page_id) AS n
FROM (SELECT page_id, unnest({kept('html')}) AS term FROM pages)
WHERE term NOT IN (SELECT term FROM listed) GROUP BY term HAVING count(DISTINCT page_id) >= 5""",
    "F3_document_texts": "SELECT text FROM documents WHERE lang = 'en'",
    "F4_backlog_unclaimed": with_(FILE_PATHS) + f"""
SELECT year_month, file_path FROM paths
WHERE year_month = '{MONTH}' AND file_path <> '' AND job_id IS NULL""",
    "F5_job_rows": with_(NAMED) + f"SELECT job_id, lang, n FROM named WHERE job_id = {JOB} AND job_id <> 0",
    "F6_languages_present": "SELECT DISTINCT lang FROM documents",
    "F7_sampled_documents": """
SELECT doc_id, lang FROM documents
WHERE CAST('0x' || substring(md5(doc_id || '#0'), 1, 8) AS BIGINT) % 1000 < 100""",
    "P1_language_window": """
SELECT doc_id, CASE WHEN length(text) > 1400 THEN substring(text, 401, 1000) ELSE text END AS "window"
FROM documents""",
    "P2_tokens": f"""
SELECT doc_id, i - 1 AS pos, tokens[i] AS term
FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i
      FROM (SELECT doc_id, {kept('text')} AS tokens FROM documents))""",
    "P3_stop_words_removed": f"""
SELECT doc_id, len({words('text')}) - len({kept('text')}) AS removed, len({kept('text')}) AS kept FROM documents""",
    "P4_content_type": with_(RECORDS) + "SELECT content_type, count(*) AS n FROM records GROUP BY ALL",
    "P5_lower_vocabulary": """
SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{3,}'))) AS term FROM benchmark""",
    "P6_array_text": """
SELECT page_id, i - 1 AS pos, entries[i] AS entry
FROM (SELECT page_id, entries, unnest(range(1, len(entries) + 1)) AS i
      FROM (SELECT page_id, string_split(translate(url, ':/', ',,'), ',') AS entries FROM pages))""",
    "L1_language_predict": with_(trigrams("true", "true")) + "SELECT doc_id, lang, predicted FROM predictions",
    "L2_language_confusion": with_(trigrams("doc_id % 2 = 0", "d.doc_id % 2 = 1"))
    + "SELECT lang, predicted, count(*) AS n FROM predictions GROUP BY ALL",
    "J1_language_names": f"""
WITH names(lang, name) AS (VALUES {NAMES})
SELECT name AS lang, count(*) AS n FROM documents JOIN names USING (lang) GROUP BY name""",
    "A1_language_counts": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "R1_language_share_top10": with_(PERIODS) + """
SELECT period, lang, n, round(n / sum(n) OVER (PARTITION BY period), 6) AS share,
       row_number() OVER (PARTITION BY period ORDER BY n DESC, lang) AS rank
FROM counts QUALIFY rank <= 10""",
    "R2_language_share_trend": with_(PERIODS) + """
SELECT period, lang, round(share, 6) AS share,
       round(share - lag(share) OVER (PARTITION BY lang ORDER BY period), 6) AS change
FROM (SELECT p.period, l.lang, coalesce(c.n, 0) / p.total AS share
      FROM (SELECT period, CAST(sum(n) AS DOUBLE) AS total FROM counts GROUP BY period) p
      CROSS JOIN (SELECT DISTINCT lang FROM counts) l
      LEFT JOIN counts c ON c.period = p.period AND c.lang = l.lang)""",
    "R1_monthly_share_top10": with_(NAMED, MONTHLY) + """
SELECT year_month, lang, n, round(n / sum(n) OVER (PARTITION BY year_month), 6) AS share,
       row_number() OVER (PARTITION BY year_month ORDER BY n DESC, lang) AS rank
FROM monthly QUALIFY rank <= 10""",
    "R2_monthly_share_trend": with_(NAMED, MONTHLY) + """
SELECT year_month, lang, round(share, 6) AS share,
       round(share - lag(share) OVER (PARTITION BY lang ORDER BY year_month), 6) AS change
FROM (SELECT p.year_month, l.lang, coalesce(c.n, 0) / p.total AS share
      FROM (SELECT year_month, CAST(sum(n) AS DOUBLE) AS total FROM monthly GROUP BY year_month) p
      CROSS JOIN (SELECT DISTINCT lang FROM monthly) l
      LEFT JOIN monthly c ON c.year_month = p.year_month AND c.lang = l.lang)""",
    "K5_vocabulary_head": with_(EN, TOK, VOCABULARY) + "SELECT term, df FROM vocabulary",
    "K6_vocabulary_order": with_(EN, TOK, VOCABULARY) + "SELECT idx, term FROM vocabulary",
    "U1_vocabulary_union": with_(EN, TOK, VOCABULARY, BENCHMARK_WORDS)
    + "SELECT term FROM vocabulary UNION SELECT term FROM extra",
    "U2_vocabulary_distinct": f"SELECT DISTINCT unnest({kept('text')}) AS term FROM conversations",
    "U3_vocabulary_final": with_(EN, TOK, VOCABULARY, BENCHMARK_WORDS, NOISE_WORDS) + """
SELECT row_number() OVER (ORDER BY term) - 1 AS idx, term
FROM (SELECT term FROM vocabulary UNION SELECT term FROM extra)
WHERE term NOT IN (SELECT term FROM noise)""",
    "J4_vocabulary_minus_excluded": with_(EN, TOK, VOCABULARY, NOISE_WORDS)
    + "SELECT term FROM vocabulary WHERE term NOT IN (SELECT term FROM noise)",
    "A2_corpus_size": "SELECT count(*) AS documents FROM documents WHERE lang = 'en'",
    "A3_term_counts": with_(counted("tok", "documents", "doc_id")) + "SELECT doc_id, term, c FROM tok",
    "A4_document_norms": with_(counted("tok", "documents", "doc_id")) + """
SELECT doc_id, round(coalesce(sqrt(CAST(sum(c * c) AS DOUBLE)), 0), 6) AS norm
FROM documents LEFT JOIN tok USING (doc_id) GROUP BY doc_id""",
    "A5_idf": with_(EN, TOK, VOCABULARY, IDF) + "SELECT term, df, round(idf, 6) AS idf FROM idf",
    "J3_vocabulary_terms": with_(EN, TOK, VOCABULARY)
    + "SELECT doc_id, idx, term, c FROM tok JOIN vocabulary USING (term)",
    "M1_term_frequency": with_(*WEIGHTS) + "SELECT doc_id, term, round(tf, 6) AS tf FROM w",
    "M2_tfidf": with_(*WEIGHTS) + "SELECT doc_id, term, round(w, 6) AS w FROM w",
    "J2_document_vectors": with_(*WEIGHTS) + """
SELECT doc_id, any_value(length(text)) AS n_chars, count(term) FILTER (w <> 0) AS entries, round(coalesce(sum(w), 0), 6) AS total
FROM en LEFT JOIN w USING (doc_id) GROUP BY doc_id""",
    "M3_cluster_count": with_(EN, SIZE) + "SELECT (SELECT count(*) FROM en) AS documents, k FROM size",
    "M4_kmeans_fit": with_(EN, SIZE) + """
SELECT k, (SELECT count(*) FROM en) AS documents, CAST(0 AS BIGINT) AS misplaced, true AS settled FROM size""",
    "M5_lloyd_step": with_(*WEIGHTS, SIZE, SEEDS, FIRST)
    + "SELECT doc_id, cluster_id, round(d2, 6) AS d2 FROM first",
    "A8_centroids": with_(*LLOYD) + "SELECT cluster_id, term, round(w, 6) AS w FROM center",
    "M6_assignment": with_(*CLUSTERED) + "SELECT doc_id, cluster_id, round(d2, 6) AS d2 FROM final",
    "M7_cosine": with_(*CLUSTERED) + "SELECT doc_id, cluster_id, round(cos_sim, 6) AS cos_sim FROM final",
    "M8_fold_in": with_(
        *LLOYD,
        counted("new_tok", "conversations", "conv_id, turn"),
        weighted("new_w", "new_tok", "conv_id, turn"),
        assigned("scored_turns", "conversations", "new_w", "conv_id, turn", "center"),
    )
    + "SELECT conv_id, turn, cluster_id, round(d2, 6) AS d2, round(cos_sim, 6) AS cos_sim FROM scored_turns",
    "M8_saved_model": with_(
        *LLOYD,
        counted("new_tok", "conversations", "conv_id, turn"),
        weighted("new_w", "new_tok", "conv_id, turn"),
        assigned("scored_turns", "conversations", "new_w", "conv_id, turn", "center"),
    )
    + "SELECT conv_id, turn, cluster_id, round(d2, 6) AS d2, round(cos_sim, 6) AS cos_sim FROM scored_turns",
    "A6_cluster_sizes": with_(*CLUSTERED, SIZES) + "SELECT cluster_id, num_docs FROM sizes",
    "A7_top_documents": with_(*CLUSTERED, TOPDOCS)
    + "SELECT cluster_id, doc_id, round(cos_sim, 6) AS cos_sim FROM top",
    "K1_cluster_keywords": with_(*LLOYD, KEYWORDS)
    + "SELECT cluster_id, rank, term, round(weight, 6) AS weight FROM keywords",
    "K2_largest_clusters": with_(*CLUSTERED, SIZES, LARGEST) + "SELECT cluster_id, num_docs FROM largest",
    "J5_largest_with_topdocs": with_(*CLUSTERED, SIZES, LARGEST, TOPDOCS)
    + "SELECT cluster_id, num_docs, doc_id FROM largest JOIN top USING (cluster_id)",
    "S9_job_clusters": with_(*CLUSTERED, SIZES)
    + f"SELECT CAST({JOB} AS BIGINT) AS job_id, cluster_id, num_docs FROM sizes",
    "S10_cluster_keywords_table": with_(*LLOYD, KEYWORDS) + f"""
SELECT CAST({JOB} AS BIGINT) AS job_id, cluster_id, rank - 1 AS pos, term, round(weight, 6) AS weight FROM keywords""",
    "S11_cluster_topdocs_table": with_(*CLUSTERED, SIZES, LARGEST, TOPDOCS) + f"""
SELECT CAST({JOB} AS BIGINT) AS job_id, cluster_id, CAST(0 AS BIGINT) AS doc_order_id, doc_id,
       round(cos_sim, 6) AS cos_sim, text
FROM largest JOIN top USING (cluster_id) JOIN en USING (doc_id)""",
    "K3_report_keywords": with_(*CLUSTERED, SIZES, REPORTED, KEYWORDS) + """
SELECT cluster_id, num_docs, string_agg(term, ',' ORDER BY rank) AS keywords, round(max(weight), 6) AS top_weight
FROM reported JOIN keywords USING (cluster_id) GROUP BY ALL""",
    "J6_clusters_with_keywords": with_(*CLUSTERED, SIZES, KEYWORDS) + f"""
SELECT CAST({JOB} AS BIGINT) AS job_id, cluster_id, num_docs, count(*) AS n_keywords
FROM sizes JOIN keywords USING (cluster_id) GROUP BY ALL""",
    "K4_report_topdocs": with_(*CLUSTERED, SIZES, REPORTED, TOPDOCS) + """
SELECT cluster_id, num_docs, CAST(0 AS BIGINT) AS doc_order_id, doc_id, round(cos_sim, 6) AS cos_sim, text
FROM reported JOIN top USING (cluster_id) JOIN en USING (doc_id)""",
    "J7_clusters_with_topdocs": with_(*CLUSTERED, SIZES, TOPDOCS) + f"""
SELECT CAST({JOB} AS BIGINT) AS job_id, cluster_id, num_docs, doc_id FROM sizes JOIN top USING (cluster_id)""",
    "R3_cluster_jaccard": with_(*LLOYD, KEYWORDS, JACCARD) + "SELECT src, dst, round(weight, 6) AS weight FROM edges",
    "R4_cluster_communities": with_(*LLOYD, KEYWORDS, JACCARD, *propagated()) + "SELECT node, label, converged FROM labels",
    "R4_document_communities": with_(*WEIGHTS, DOCUMENT_EDGES, *propagated()) + "SELECT node, label, converged FROM labels",
    "R4_modular_communities": with_(*WEIGHTS, DOCUMENT_EDGES) + """
SELECT (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges)) AS nodes,
       round(sum(weight), 3) AS weight, true AS rises, true AS nests, true AS agrees, true AS whole
FROM edges""",
    "R5_modularity": with_(*WEIGHTS, DOCUMENT_EDGES, *propagated(), MODULARITY) + """
SELECT count(*) AS communities,
       round(sum(coalesce(inner_weight, 0) / total - power(degree / (2 * total), 2)), 6) AS modularity,
       (SELECT bool_and(converged) FROM labels) AS converged
FROM degrees LEFT JOIN inside USING (label) CROSS JOIN whole""",
    "R6_keyword_scale": with_(*LLOYD, KEYWORDS) + """
SELECT cluster_id, term, round(weight / max(weight) OVER (PARTITION BY cluster_id), 6) AS scale FROM keywords""",
}
