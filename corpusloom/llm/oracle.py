"""SQL for the registered queries that SQL can express."""

ORACLE = {
    "op7_host_reputation": r"""
WITH urls AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM urls
), outcomes AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id
), hosts AS (
    SELECT host, list_extract(string_split(host, '.'), -1) AS suffix,
        array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
        count(bad) AS n, coalesce(sum(bad), 0) AS bad
    FROM parts LEFT JOIN outcomes USING (page_id) GROUP BY host
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad,
        (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM hosts) AS mean
    FROM hosts GROUP BY suffix
), suffix_moments AS (
    SELECT sum((bad - n * mean) ** 2 / (mean * (1 - mean)) - n) AS excess, sum(n * (n - 1)) AS pairs FROM suffixes
), suffix_strength AS (
    SELECT CASE WHEN pairs > 0 THEN 1 / least(greatest(excess / pairs, 1 / 1000001.0), 1 / 1.5) - 1 ELSE 1000000.0 END AS m
    FROM suffix_moments
), suffix_means AS (
    SELECT suffix, (bad + m * mean) / (n + m) AS suffix_mean FROM suffixes, suffix_strength
), domains AS (
    SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(suffix_mean) AS mean
    FROM hosts JOIN suffix_means USING (suffix) GROUP BY domain
), domain_moments AS (
    SELECT sum((bad - n * mean) ** 2 / (mean * (1 - mean)) - n) AS excess, sum(n * (n - 1)) AS pairs FROM domains
), domain_strength AS (
    SELECT CASE WHEN pairs > 0 THEN 1 / least(greatest(excess / pairs, 1 / 1000001.0), 1 / 1.5) - 1 ELSE 1000000.0 END AS m
    FROM domain_moments
), domain_means AS (
    SELECT domain, (bad + m * mean) / (n + m) AS domain_mean FROM domains, domain_strength
), priors AS (
    SELECT host, n, bad, domain_mean AS mean FROM hosts JOIN domain_means USING (domain)
), host_moments AS (
    SELECT sum((bad - n * mean) ** 2 / (mean * (1 - mean)) - n) AS excess, sum(n * (n - 1)) AS pairs FROM priors
), host_strength AS (
    SELECT CASE WHEN pairs > 0 THEN 1 / least(greatest(excess / pairs, 1 / 1000001.0), 1 / 1.5) - 1 ELSE 1000000.0 END AS m
    FROM host_moments
), posterior AS (
    SELECT host, (bad + m * mean) / (n + m) AS rate, n + m AS total FROM priors, host_strength
), judged AS (
    SELECT page_id, host, path, rate, rate - 1.6448536269514722 * sqrt(rate * (1 - rate) / (total + 1)) AS bound,
        CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
        END AS rule
    FROM parts JOIN posterior USING (host)
)
SELECT page_id, host, path, rule,
    CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
        WHEN 'net/' THEN 'block' ELSE CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END END AS verdict,
    round(rate, 6) AS bad_rate, round(bound, 6) AS bad_bound
FROM judged
""",
    "op11_ranking": r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS row_no,
        list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
            lambda t : translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
    FROM documents
), sized AS (
    SELECT row_no, doc_id, coalesce(len(terms), 0) AS n FROM words
), totals AS (
    SELECT count(*) FILTER (n > 0) AS big_n, sum(n)::BIGINT AS big_l FROM sized
), held AS (
    SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM words) GROUP BY row_no, term
), wanted AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
            lambda t : translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
        FROM benchmark) GROUP BY item_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM held CROSS JOIN totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, big_n
), scored AS (
    SELECT item_id, row_no, doc_id,
        sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN sized USING (row_no) CROSS JOIN totals
    GROUP BY item_id, row_no, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 20
""",
}
