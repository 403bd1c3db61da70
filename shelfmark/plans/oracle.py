"""SQL equivalents of the queries, over the same tables.

The SQL never looks at a page: it works on the reviews from which the pages were written, so a
wrong extraction cannot agree with itself.
"""

from __future__ import annotations

BASE = "https://books.example.org"

# Reviews: one per event, see the derived tables.
REVIEWS = """
sizes AS (SELECT (SELECT count(*) FROM part) AS n_parts, (SELECT count(*) FROM documents) AS n_docs),
tiers AS (
  SELECT e.*, event_id // 3 AS third, event_id % 3 AS tier, n_parts - n_parts // 10 - 21 AS tail, n_docs
  FROM events e, sizes),
placed AS (
  SELECT *,
    CASE tier WHEN 0 THEN 0 WHEN 1 THEN 1 + third % 20 ELSE 21 + third % tail END AS book_no,
    CASE tier WHEN 0 THEN third WHEN 1 THEN third // 20 ELSE third // tail END AS seq
  FROM tiers),
rv AS (
  SELECT event_id AS no, book_no, CAST(seq // 30 + 1 AS BIGINT) AS page, seq % 30 AS place,
    CAST(user_id AS VARCHAR) AS user_id, 'reader ' || user_id AS user_name,
    CASE WHEN event_id % 13 <> 4 THEN CAST(floor(value / 4) AS INTEGER) % 7 END AS rating,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS upvotes,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date, d.text
  FROM placed JOIN documents d ON d.doc_id = event_id % n_docs)
"""

BOOKS = f"""
books AS (
  SELECT p_partkey AS book_no, CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_brand AS author,
    '{BASE}/book/show/' || p_partkey || '.Book_' || p_partkey AS plain_url,
    CASE p_partkey % 17 WHEN 5 THEN NULL WHEN 6 THEN ''
      WHEN 7 THEN '{BASE}/book/show/' || p_partkey || '.Book_' || p_partkey || '//'
      ELSE '{BASE}/book/show/' || p_partkey || '.Book_' || p_partkey END AS book_url
  FROM part)
"""

PAGE_COUNTS = """
counts AS (SELECT book_no, (count(*) + 29) // 30 AS page_count FROM rv GROUP BY book_no)
"""

# What the extraction must find, per shape: fields, then acceptance, then the place on the page.
# SHAPE is one of the five names, per row.
SHAPED = """
shaped AS (
  SELECT *, ['edges', 'entities', 'state', 'data', 'queries'][book_no % 5 + 1] AS mixed FROM rv),
fields AS (
  SELECT book_no, page, place, no, {shape} AS shape,
    CASE WHEN no % 11 = 3 THEN NULL
      WHEN {shape} IN ('edges', 'entities') THEN text
      ELSE '<i>' || replace(text, chr(10), '<br />') || '</i>' END AS review_text,
    CAST(rating AS DOUBLE) AS review_rating,
    CASE WHEN {shape} IN ('edges', 'entities')
      THEN CASE no % 5 WHEN 2 THEN '' WHEN 4 THEN 'r' || no ELSE user_id END
      ELSE CASE WHEN no % 3 < 2 THEN user_id ELSE '' END END AS found_id,
    CASE WHEN {shape} IN ('edges', 'entities')
      THEN CASE no % 5 WHEN 2 THEN NULL WHEN 4 THEN '' ELSE user_name END
      ELSE CASE WHEN no % 3 < 2 THEN user_name ELSE '' END END AS reviewer_name,
    CASE WHEN no % 3 < 2 THEN upvotes ELSE 0 END AS review_upvotes,
    date AS review_date,
    CASE WHEN no % 4 = 1 THEN '/review/show/' || no ELSE '' END AS review_url
  FROM shaped),
accepted AS (
  SELECT *, row_number() OVER (PARTITION BY book_no, page ORDER BY place) - 1 AS pos
  FROM fields
  WHERE CASE WHEN shape IN ('data', 'queries') THEN coalesce(review_text, '') <> '' AND found_id <> '' AND found_id <> '0'
    ELSE coalesce(review_text, '') <> '' OR coalesce(review_rating, 0) <> 0 END),
extracted AS (
  SELECT book_no, page, shape AS review_source, CAST(pos AS BIGINT) AS pos, review_text, review_rating,
    CASE WHEN found_id IN ('', '0') THEN 'unknown_' || pos ELSE found_id END AS reviewer_id,
    reviewer_name, review_upvotes, review_date, review_url
  FROM accepted)
"""

FLAT = f"""
{REVIEWS}, {BOOKS},
flat AS (
  SELECT no AS event_id, book_id, title, author, plain_url AS book_url, text AS review_text,
    CASE WHEN rating BETWEEN 1 AND 5 THEN rating END AS review_rating, user_id AS reviewer_id,
    user_name AS reviewer_name, upvotes AS review_upvotes, date AS review_date
  FROM rv JOIN books USING (book_no)),
damaged AS (
  SELECT no AS event_id, CASE WHEN no % 47 <> 13 THEN book_id END AS book_id, title, author,
    CASE WHEN no % 29 = 3 THEN NULL WHEN no % 29 = 4 THEN '' WHEN no % 31 = 5 THEN 'Mock review: ' || text
      WHEN no % 31 = 6 THEN text || ' (Mock review)' ELSE text END AS review_text,
    CASE WHEN no % 41 = 8 THEN rating + 0.5 ELSE rating END AS review_rating,
    CASE WHEN no % 37 = 7 THEN 'mock_user_' || user_id ELSE user_id END AS reviewer_id,
    CASE no % 43 WHEN 9 THEN date || 'Z' WHEN 10 THEN left(date, 10) WHEN 11 THEN NULL
      WHEN 12 THEN '2023-13-45T00:00:00' ELSE date END AS review_date
  FROM rv JOIN books USING (book_no))
"""

ISO = "coalesce(regexp_matches(review_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$'), false)"

BROKEN = {
    "mock_text_inside": "contains(review_text, 'Mock review')",
    "mock_text_start": "starts_with(review_text, 'Mock review')",
    "mock_user": "starts_with(reviewer_id, 'mock_user')",
    "null_book_id": "book_id IS NULL",
    "null_review_text": "review_text IS NULL",
    "null_review_rating": "review_rating IS NULL",
    "empty_text": "review_text IS NULL OR review_text = ''",
    "rating_range": "NOT coalesce(review_rating BETWEEN 1 AND 5, false)",
    "rating_whole": "review_rating IS NOT NULL AND review_rating NOT IN (1, 2, 3, 4, 5)",
    "date_form": f"NOT {ISO}",
}
NULLS = ["null_book_id", "null_review_text", "null_review_rating"]

# Search results: ten parts per book, the book itself among them.
RESULTS = """
results AS (
  SELECT b.book_no, b.place, p.p_partkey, p.p_name, p.p_brand
  FROM (SELECT p_partkey AS book_no, place, (p_partkey + ((place + p_partkey) % 10) * 37) % n AS p_partkey
        FROM part, range(10) r(place), (SELECT count(*) AS n FROM part)) b
  JOIN part p USING (p_partkey)),
asked AS (
  SELECT p_partkey AS book_no, CAST(p_partkey AS VARCHAR) AS book_id,
    left(p_name, p_partkey % length(p_name)) || substr(p_name, p_partkey % length(p_name) + 2) AS title,
    CASE WHEN p_partkey % 23 = 11 THEN NULL WHEN p_partkey % 5 = 3 THEN 'someone else' ELSE p_brand END AS author
  FROM part)
"""

CANDIDATES = f"""
candidates AS (
  SELECT book_no, place, p_name AS title, p_brand AS author, '{BASE}/book/show/' || p_partkey AS url,
    CAST(p_partkey AS VARCHAR) AS catalogue_id
  FROM results
  WHERE NOT (place = 3 AND book_no % 4 = 1) AND NOT (place = 5 AND book_no % 4 = 2))
"""

# Longest common subsequence by the textbook table, one row of it per step.
# Needs pairs(a, b) of lower-cased strings.
RATIOS = """
steps AS (
  SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0) AS cells FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda done, j: list_append(done,
      CASE WHEN substr(a, i + 1, 1) = substr(b, j, 1) THEN cells[j] + 1 ELSE greatest(cells[j + 1], done[-1]) END), [0])
  FROM steps WHERE i < length(a)),
ratios AS (
  SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100.0::DOUBLE
    ELSE (1.0::DOUBLE - (length(a) + length(b) - 2 * cells[-1])::DOUBLE / (length(a) + length(b))) * 100.0::DOUBLE END AS ratio
  FROM steps WHERE i = length(a))
"""


def _matches(candidates: str) -> str:
    """Best candidate per book: needs asked and {candidates}(book_no, place, title, author, url, id)."""
    return f"""
pairs AS (
  SELECT DISTINCT lower(q.title) AS a, lower(c.title) AS b FROM asked q JOIN {candidates} c USING (book_no)
  UNION
  SELECT DISTINCT lower(q.author), lower(c.author) FROM asked q JOIN {candidates} c USING (book_no)
  WHERE q.author IS NOT NULL),
{RATIOS},
scored AS (
  SELECT q.book_id, c.*, t.ratio * 0.6::DOUBLE + w.ratio * 0.4::DOUBLE AS score
  FROM asked q JOIN {candidates} c USING (book_no)
  JOIN ratios t ON t.a = lower(q.title) AND t.b = lower(c.title)
  JOIN ratios w ON w.a = lower(q.author) AND w.b = lower(c.author)),
best AS (
  SELECT * FROM scored WHERE score >= 70
  QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY score DESC, place) = 1)
"""


# Books with equal queries share one search page: the one written for the first of them.
SHARED = """
sharing AS (
  SELECT book_no, min(book_no) OVER (PARTITION BY title, author) AS page_no FROM asked WHERE author IS NOT NULL),
shared AS (
  SELECT s.book_no, c.place, c.title, c.author, c.url, c.catalogue_id
  FROM sharing s JOIN candidates c ON c.book_no = s.page_no)
"""

LINKED = f"""
WITH RECURSIVE {RESULTS}, {CANDIDATES}, {SHARED}, {_matches('shared')},
linked AS (
  SELECT q.book_id, q.title, q.author, b.url AS book_url FROM asked q LEFT JOIN best b USING (book_id))
"""


def _extraction(shape: str) -> str:
    return f"WITH {REVIEWS}, {SHAPED.format(shape=shape)} SELECT * FROM extracted"


def _suite(
    columns: str,
    empty: str | None,
    rules: dict[str, str],
    few_books: str | None = None,
    missing: int = 0,
    extra: int | None = None,
    broken: dict[str, str] = BROKEN,
    head: str = "",
    more: str = "",
) -> str:
    rows = [f"SELECT 'required_columns' AS rule, '{columns}' AS severity, CAST({missing} AS BIGINT) AS violations"]
    if extra is not None:
        rows.append(f"SELECT 'extra_columns', 'report', CAST({extra} AS BIGINT)")
    if empty:
        rows.append(f"SELECT 'not_empty', '{empty}', CAST(count(*) = 0 AS BIGINT) FROM damaged")
    for name, severity in rules.items():
        rows.append(f"SELECT '{name}', '{severity}', count(*) FILTER (WHERE {broken[name]}) FROM damaged")
    if few_books:
        rows.append(f"SELECT 'few_books', '{few_books}', CAST(count(DISTINCT book_id) < 2 AS BIGINT) FROM damaged")
    return f"{head or f'WITH {FLAT}'} SELECT *, violations = 0 AS passed{more} FROM ({' UNION ALL '.join(rows)})"


# A rating that is written as a word is there, but no number; a table read from CSV has no empty texts.
READ = {
    **BROKEN,
    "null_review_rating": "review_rating IS NULL AND event_id % 53 <> 14",
    "rating_range": "event_id % 53 = 14 OR NOT coalesce(review_rating BETWEEN 1 AND 5, false)",
    "rating_whole": "event_id % 53 = 14 OR (review_rating IS NOT NULL AND review_rating NOT IN (1, 2, 3, 4, 5))",
    "null_review_text": "review_text IS NULL OR review_text = ''",
}


def _rules(severity: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, severity)


PATH = "CASE WHEN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END"

# Longest rule first; permission before prohibition at equal length.
AGENT_POLICY = f"""
WITH rules(len, allow, pattern) AS (VALUES
  (3, false, '^/en'), (5, true, '^/en/1'), (8, false, '^/.*\\.html$'), (6, false, '^/es/.*7'), (6, true, '^/es/17')),
paths AS (SELECT page_id, {PATH} AS path FROM pages)
SELECT page_id, path, coalesce((
  SELECT allow FROM rules WHERE regexp_matches(path, pattern) ORDER BY len DESC, allow DESC LIMIT 1), true) AS allowed
FROM paths
"""

NEEDED = f"""
{REVIEWS}, {BOOKS}, {PAGE_COUNTS},
needed AS (
  SELECT book_no, book_id, page, rtrim(book_url, '/') || '/reviews' AS page_url,
    replace(replace(rtrim(book_url, '/') || '/reviews', 'https://', ''), '/', '_') || '_page=' || page AS page_key
  FROM books JOIN counts USING (book_no), unnest(range(1, page_count + 1)) t(page)
  WHERE coalesce(book_url, '') <> '')
"""

# Stored, and one of the page's copies was answered well.
ANSWERED = """(page + book_no) % 2 = 0 AND page % 7 <> 5
  AND ((page + 1) % 3 <> 0 OR (book_no % 3 >= 1 AND (page + 2) % 3 <> 0) OR (book_no % 3 = 2 AND (page + 3) % 3 <> 0))"""

# Reviews as the markup shows them.
MARKUP = f"""
boxes AS (
  SELECT book_no, page, row_number() OVER (PARTITION BY book_no, page ORDER BY place) - 1 AS pos,
    trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS review_text,
    CAST(CASE no % 4 WHEN 0 THEN rating WHEN 1 THEN rating + 0.5
      ELSE CASE WHEN rating BETWEEN 1 AND 5 THEN rating END END AS DOUBLE) AS review_rating,
    CASE WHEN no % 6 <> 5 THEN user_id END AS reviewer_id,
    CASE WHEN no % 6 <> 5 THEN user_name END AS reviewer_name,
    CASE WHEN no % 3 < 2 THEN upvotes ELSE 0 END AS review_upvotes,
    CAST(0 AS BIGINT) AS review_downvotes,
    CASE WHEN no % 5 < 3 THEN left(date, 10) || 'T00:00:00' END AS review_date,
    '{BASE}/review/show/' || CASE WHEN no % 5 = 0 THEN '' ELSE 'review_' END || no AS review_url,
    CASE no % 3 WHEN 0 THEN 'shelf ' || user_id || '|to read' WHEN 1 THEN 'shelf ' || user_id || '|owned' ELSE '' END AS shelves,
    CASE WHEN no % 4 = 0 THEN no % 9 ELSE 0 END AS comment_count,
    no % 5 = 3 AS date_unparsed
  FROM rv)
"""

QUARANTINE = f"""
WITH {REVIEWS}, {SHAPED.format(shape="mixed")},
all_pages AS (SELECT DISTINCT book_no, page, (book_no + page) % 8 AS kind FROM rv),
good AS (SELECT DISTINCT book_no, page FROM extracted)
SELECT book_no, page,
  CASE WHEN kind IN (0, 3) THEN 'bad_state' WHEN kind IN (1, 5) THEN 'no_state' ELSE 'no_reviews' END AS reason,
  kind NOT IN (1, 5) AS has_state
FROM all_pages LEFT JOIN good g USING (book_no, page) WHERE kind IN (0, 1, 2, 3, 5) OR g.page IS NULL"""

ORACLE: dict[str, str] = {
    "booklist_alias_required": """
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_brand AS author, CAST(p_size AS BIGINT) AS p_size,
  CAST(NULL AS VARCHAR) AS book_url FROM part""",
    "booklist_csv": """
SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name || ' "new", vol. 1' || chr(10) || p_type AS title,
  CASE WHEN p_partkey % 9 <> 4 THEN p_brand END AS author, CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "search_key_encoded": f"""
WITH asked AS (SELECT p_partkey, p_name || ' & sons* ~' || p_type || ' ' || p_brand AS q FROM part),
coded AS (SELECT *, 'q=' || replace(url_encode(q), '%20', '+') AS parameters FROM asked),
keyed AS (SELECT *, regexp_replace('{BASE}/search' || parameters, '[^A-Za-z0-9_-]', '_', 'g') AS k FROM coded)
SELECT p_partkey, q AS search_query, parameters,
  CASE WHEN length(k) > 200 THEN left(k, 190) || sha256('{BASE}/search' || parameters) ELSE k END AS search_key
FROM keyed""",
    "review_page_urls": f"WITH {BOOKS} SELECT book_id, rtrim(book_url, '/') || '/reviews' AS page_url FROM books",
    "page_key": r"""
WITH long AS (SELECT page_id, url, url || '/é ü' || repeat(url, page_id % 6) AS long FROM pages),
flat AS (SELECT *, regexp_replace(long || 'q=a+b', '[^\p{L}\p{N}_-]', '_', 'g') AS k FROM long)
SELECT page_id,
  CASE WHEN length(k) > 200 THEN left(k, 190) || sha256(long || 'q=a+b') ELSE k END AS flat_key,
  regexp_replace(replace(replace(long, 'https://', ''), 'http://', ''), '[\\/*?:"<>|]', '_', 'g') AS readable_key,
  regexp_replace(replace(replace(url, 'https://', ''), 'http://', ''), '[\\/*?:"<>|]', '_', 'g')
    || '_page=' || page_id || '_sort=new' AS readable_key_with_parameters
FROM flat""",
    "canonical_url": f"""
WITH given AS (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{BASE}' || regexp_replace(url, '^https?://[^/]+', '') ELSE url END AS given,
    {PATH} AS path FROM pages)
SELECT page_id, regexp_replace(given, '\\?.*$', '') AS url, path FROM given""",
    "id_from_url": """
SELECT page_id,
  nullif(regexp_extract(regexp_replace(url, '/(en|es)/', '/book/show/', 'g'), '/show/([0-9]+)', 1), '') AS catalogue_id,
  nullif(regexp_extract(regexp_replace(url, '/(de|fr)/', '/user/show/', 'g'), '/user/show/([0-9]+)', 1), '') AS user_id
FROM pages""",
    "author_clean": """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'bystander ' || p_brand ELSE p_brand END AS author FROM part""",
    "date_formats": """
WITH shown AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%b %-d, %Y')
    WHEN 1 THEN strftime(o_orderdate, '%B %d, %Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 3 THEN strftime(o_orderdate, '%Y-%-m-%-d') ELSE strftime(o_orderdate, '%d.%m.%Y') END AS shown, o_orderdate
  FROM orders)
SELECT o_orderkey, shown, CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' END AS iso
FROM shown""",
    "page_frontier": f"WITH {NEEDED} SELECT book_id, page, page_url, page_key FROM needed WHERE page <= 5",
    "page_frontier_odd_counts": f"""
WITH {BOOKS},
counted AS (SELECT *, CASE book_no % 4 WHEN 0 THEN 1200 WHEN 1 THEN 1200 WHEN 2 THEN least(book_no % 9 - 2, 1200) END AS n FROM books)
SELECT book_id, CAST(n AS BIGINT) AS n_pages, CAST(n AS BIGINT) AS last_page FROM counted
WHERE n >= 1 AND coalesce(book_url, '') <> ''""",
    "cache_hits": f"""
WITH {NEEDED} SELECT book_id, page, page_key FROM needed WHERE (page + book_no) % 2 = 0""",
    "cache_misses": f"""
WITH {NEEDED} SELECT book_id, page, page_key FROM needed WHERE (page + book_no) % 2 = 1""",
    "cache_misses_by_status": f"""
WITH {NEEDED} SELECT book_id, page, page_key FROM needed WHERE NOT ({ANSWERED})""",
    "cache_probe_bucketed": f"""
WITH {NEEDED} SELECT book_id, page, {ANSWERED} AS stored FROM needed""",
    "url_policy": f"""
SELECT page_id, {PATH} AS path,
  NOT ({PATH} LIKE '/fr/1%' OR {PATH} LIKE '/de%' OR {PATH} LIKE '/en%'
    OR starts_with({PATH}, '/*.html$') OR starts_with({PATH}, '/es/*7')) AS allowed
FROM pages""",
    "url_policy_agent": AGENT_POLICY,
    "url_policy_joined": AGENT_POLICY,
    "fuzzy_best_match": f"""
WITH RECURSIVE {RESULTS},
candidates AS (
  SELECT book_no, place, p_name AS title, p_brand AS author, CAST(p_partkey AS VARCHAR) AS catalogue_id FROM results),
{_matches('candidates')}
SELECT q.book_id, b.title AS match_title, b.author AS match_author, b.catalogue_id AS match_id, round(b.score, 6) AS score
FROM asked q LEFT JOIN best b USING (book_id)""",
    "catalogue_best_match": f"""
WITH RECURSIVE {RESULTS},
entries AS (
  SELECT p_name AS title, p_brand AS author, min(p_partkey) AS first FROM part GROUP BY ALL),
pairs AS (
  SELECT DISTINCT lower(q.title) AS a, lower(c.title) AS b FROM asked q, entries c
  UNION
  SELECT DISTINCT lower(q.author), lower(c.author) FROM asked q, entries c WHERE q.author IS NOT NULL),
{RATIOS},
wanted AS (SELECT DISTINCT title, author FROM asked WHERE author IS NOT NULL),
best AS (
  SELECT q.title, q.author, c.title AS match_title, c.author AS match_author, first,
    t.ratio * 0.6::DOUBLE + w.ratio * 0.4::DOUBLE AS score
  FROM wanted q CROSS JOIN entries c
  JOIN ratios t ON t.a = lower(q.title) AND t.b = lower(c.title)
  JOIN ratios w ON w.a = lower(q.author) AND w.b = lower(c.author)
  WHERE t.ratio * 0.6::DOUBLE + w.ratio * 0.4::DOUBLE >= 70
  QUALIFY row_number() OVER (PARTITION BY q.title, q.author ORDER BY score DESC, first) = 1)
SELECT q.book_id, match_title, match_author, CAST(first AS VARCHAR) AS match_id, round(score, 6) AS score
FROM asked q LEFT JOIN best b ON b.title = q.title AND b.author = q.author""",
    "linked_books": f"{LINKED} SELECT * FROM linked",
    "link_coverage": f"""
{LINKED} SELECT count(*) AS n_books, count(book_url) AS n_linked, round(100.0 * count(book_url) / count(*), 1) AS percentage
FROM linked""",
    "html_search_candidates": f"""
WITH {RESULTS}, {CANDIDATES}
SELECT book_no, row_number() OVER (PARTITION BY book_no ORDER BY place) - 1 AS pos, title, author, url, catalogue_id
FROM candidates""",
    "reviews_by_ref": _extraction("'edges'"),
    "reviews_all_entities": _extraction("'entities'"),
    "reviews_inline_state": _extraction("'state'"),
    "reviews_inline_data": _extraction("'data'"),
    "reviews_dehydrated": _extraction("'queries'"),
    "reviews_fallback_mix": _extraction("mixed"),
    "quarantine_pages": QUARANTINE,
    "quarantine_written": f"SELECT reason, book_no, count(*) AS n_pages FROM ({QUARANTINE}) GROUP BY ALL",
    "odd_state_reviews": f"""
WITH {REVIEWS}, {SHAPED.format(shape="mixed")}
SELECT book_no, page, pos, reviewer_id, reviewer_name, review_rating FROM extracted WHERE (book_no + page) % 8 IN (4, 6, 7)""",
    "page_count_json": f"""
WITH {REVIEWS}, {PAGE_COUNTS}, pages_of AS (SELECT DISTINCT book_no, page FROM rv)
SELECT book_no, page, ['edges', 'entities', 'state', 'data', 'queries'][book_no % 5 + 1] AS shape,
  CASE WHEN page = 1 OR book_no % 5 IN (0, 2, 4) THEN page_count ELSE 1 END AS page_count
FROM pages_of JOIN counts USING (book_no)""",
    "page_count_answers": f"""
WITH {REVIEWS}, {PAGE_COUNTS}, pages_of AS (SELECT DISTINCT book_no, page FROM rv)
SELECT book_no, page,
  CASE WHEN book_no % 7 NOT IN (3, 4) AND (page = 1 OR book_no % 5 IN (0, 2, 4)) THEN page_count ELSE 1 END AS page_count
FROM pages_of JOIN counts USING (book_no)""",
    "page_count_html": f"""
WITH {REVIEWS}
SELECT DISTINCT book_no, page, CASE WHEN book_no % 7 = 3 THEN 0 ELSE page END AS page_count FROM rv""",
    "html_review_fields": f"WITH {REVIEWS}, {MARKUP} SELECT * FROM boxes",
    "flat_reviews": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")}
SELECT book_id, title, author, book_url, page, pos, review_text,
  CAST(CASE WHEN review_rating BETWEEN 1 AND 5 THEN review_rating END AS BIGINT) AS review_rating,
  reviewer_id, reviewer_name, review_upvotes, review_date, review_url
FROM extracted JOIN books USING (book_no) WHERE coalesce(book_url, '') <> ''""",
    "flat_reviews_gaps": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")}
SELECT book_id, page, pos, reviewer_id
FROM extracted JOIN books USING (book_no) WHERE coalesce(book_url, '') <> '' AND page >= 2""",
    "answered_reviews": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")}
SELECT book_id, page, pos, reviewer_id,
  CAST(CASE WHEN review_rating BETWEEN 1 AND 5 THEN review_rating END AS BIGINT) AS review_rating
FROM extracted JOIN books USING (book_no) WHERE coalesce(book_url, '') <> '' AND (book_no + page) % 5 NOT IN (1, 2)""",
    "flat_markup_reviews": f"""
WITH {REVIEWS}, {BOOKS}, {MARKUP}
SELECT book_id, title, author, book_url, page, pos, review_text,
  CAST(CASE WHEN review_rating BETWEEN 1 AND 5 THEN trunc(review_rating) END AS BIGINT) AS review_rating, reviewer_id,
  reviewer_name, review_upvotes, review_downvotes, review_date, review_url, shelves, comment_count
FROM boxes JOIN books USING (book_no) WHERE coalesce(book_url, '') <> ''""",
    "markup_csv_round_trip": f"""
WITH {REVIEWS}, {BOOKS}, {MARKUP}
SELECT book_id, title, author, book_url, CAST(page AS VARCHAR) AS page, CAST(pos AS VARCHAR) AS pos,
  nullif(review_text, '') AS review_text,
  CAST(CASE WHEN review_rating BETWEEN 1 AND 5 THEN trunc(review_rating) END AS DOUBLE) AS review_rating, reviewer_id,
  reviewer_name, review_upvotes, review_downvotes, review_date, review_url, shelves, comment_count
FROM boxes JOIN books USING (book_no) WHERE coalesce(book_url, '') <> ''""",
    "linked_list_round_trip": f"""
WITH {BOOKS} SELECT book_id, title, author, nullif(book_url, '') AS book_url FROM books""",
    "empty_reviews_written": """
SELECT 'book_id,title,author,book_url,review_text,review_rating,reviewer_id,review_upvotes,review_date' AS header,
  CAST(count(*) AS BIGINT) AS n_rows FROM events WHERE event_id < 0""",
    "ordered_csv": f"""
WITH {FLAT} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unordered, CAST(0 AS BIGINT) AS n_overlapping FROM flat""",
    "list_order_written": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")},
listed AS (SELECT *, row_number() OVER (ORDER BY md5(book_id)) - 1 AS book_seq FROM books)
SELECT row_number() OVER (ORDER BY book_seq, page, pos) - 1 AS n, book_seq, book_id, page, pos, reviewer_id,
  md5(nullif(review_text, '')) AS digest
FROM extracted JOIN listed USING (book_no) WHERE coalesce(book_url, '') <> ''""",
    "reviews_per_book": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")},
held AS (SELECT DISTINCT book_no, page FROM rv),
wanted AS (
  SELECT b.*, h.page FROM books b LEFT JOIN held h ON h.book_no = b.book_no AND coalesce(book_url, '') <> '')
SELECT book_id, title, coalesce((w.page - 1) // 100, 0) AS chunk, count(e.pos) AS n_reviews,
  md5(coalesce(string_agg(e.reviewer_id, '|' ORDER BY e.page, e.pos), '')) AS reviewer_ids,
  md5(coalesce(string_agg(md5(e.review_text), '|' ORDER BY e.page, e.pos), '')) AS text_digests
FROM wanted w LEFT JOIN extracted e ON e.book_no = w.book_no AND e.page = w.page
GROUP BY w.book_no, book_id, title, coalesce((w.page - 1) // 100, 0)""",
    "nested_reviews": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")},
held AS (SELECT DISTINCT book_no, page FROM rv),
wanted AS (
  SELECT b.*, h.page FROM books b LEFT JOIN held h ON h.book_no = b.book_no AND coalesce(book_url, '') <> '')
SELECT book_id, title, author, w.page, count(e.pos) AS n_reviews,
  coalesce(string_agg(e.reviewer_id, '|' ORDER BY e.pos), '') AS reviewer_ids,
  coalesce(string_agg(md5(e.review_text), '|' ORDER BY e.pos), '') AS text_digests
FROM wanted w LEFT JOIN extracted e ON e.book_no = w.book_no AND e.page = w.page
GROUP BY ALL""",
    "single_book_reviews": f"""
WITH {REVIEWS}, {SHAPED.format(shape="mixed")}
SELECT page, pos, review_text, review_rating, reviewer_id, reviewer_name, review_upvotes, review_date, review_url
FROM extracted WHERE book_no = 0""",
    "incremental_reviews": f"""
WITH {REVIEWS}, {BOOKS}, {SHAPED.format(shape="mixed")}
SELECT page, review_source, pos, review_text,
  CAST(CASE WHEN review_rating BETWEEN 1 AND 5 THEN review_rating END AS BIGINT) AS review_rating,
  reviewer_id, reviewer_name, review_upvotes, review_date, review_url
FROM extracted""",
    "incremental_quarantine": f"SELECT reason, count(*) AS n_pages, count(*) AS n_different FROM ({QUARANTINE}) GROUP BY reason",
    "incremental_summary": f"""
WITH {REVIEWS}, {SHAPED.format(shape="mixed")}
SELECT CAST(3 AS BIGINT) AS n_deliveries, count(*) AS n_reviews,
  round(avg(CASE WHEN review_rating BETWEEN 1 AND 5 THEN trunc(review_rating) END), 2) AS avg_rating,
  count(DISTINCT book_no) AS books, count(DISTINCT reviewer_id) AS reviewers, true AS books_close, true AS reviewers_close
FROM extracted""",
    "csv_round_trip": f"""
WITH {FLAT} SELECT CAST(event_id AS VARCHAR) AS event_id, book_id, title, author, book_url, review_text,
  CAST(review_rating AS DOUBLE) AS review_rating, reviewer_id, reviewer_name, review_upvotes, review_date FROM flat""",
    "page_class": """
SELECT page_id,
  CASE WHEN page_id % 11 = 3 OR contains(lower(html), 'captcha') THEN 'captcha'
    WHEN page_id % 6 IN (2, 3, 4) THEN 'retryable' WHEN page_id % 6 = 0 THEN 'usable' ELSE 'other' END AS response_class,
  page_id % 11 = 3 OR contains(lower(html), 'captcha') AS captcha,
  page_id % 11 = 4 OR contains(html, 'No reviews yet') AS no_reviews
FROM pages""",
    "usable_pages": """
SELECT page_id, length(html) + CASE WHEN page_id % 11 = 4 THEN length('<p>No reviews yet</p>') ELSE 0 END AS n_chars
FROM pages WHERE page_id % 6 = 0 AND page_id % 11 <> 3 AND NOT contains(lower(html), 'captcha')""",
    "empty_pages": """
SELECT count(*) AS n_pages, count(*) FILTER (WHERE page_id % 11 = 4 OR contains(html, 'No reviews yet')) AS n_empty FROM pages""",
    "first_pages": r"""
SELECT regexp_replace(replace(replace(url, 'https://', ''), 'http://', ''), '[\\/*?:"<>|]', '_', 'g') AS page_key, page_id
FROM pages ORDER BY 1 LIMIT 10""",
    "latest_pages": r"""
WITH keyed AS (
  SELECT page_id, length(html) AS n_chars, CASE WHEN page_id % 3 = 0 THEN 'the same'
    ELSE regexp_replace(replace(replace(url, 'https://', ''), 'http://', ''), '[\\/*?:"<>|]', '_', 'g') END AS page_key
  FROM pages)
SELECT page_key, page_id, n_chars FROM keyed
QUALIFY row_number() OVER (PARTITION BY page_key
  ORDER BY CASE WHEN page_id % 5 <> 0 THEN page_id // 10 END DESC NULLS LAST, page_id DESC) = 1""",
    "saved_page_files": r"""
SELECT regexp_replace(replace(replace(url, 'https://', ''), 'http://', ''), '[\\/*?:"<>|]', '_', 'g') || '_page=' || page_id AS page_key,
  page_id AS page, md5(html) AS digest FROM pages""",
    "entity_profile": f"""
WITH {REVIEWS},
per_page AS (
  SELECT book_no, page, count(*) AS n_reviews,
    count(DISTINCT user_id) FILTER (WHERE no % 5 < 2) AS n_users,
    count(*) FILTER (WHERE no % 7 = 2 AND no % 11 <> 3) AS n_texts, min_by(no, place) AS first_no
  FROM rv GROUP BY book_no, page),
shown AS (
  SELECT p.*, r.*, CASE WHEN no % 11 = 3 THEN NULL WHEN no % 7 = 2 THEN '{{"__ref":"Text:' || no || '"}}' WHEN no % 2 = 0
    THEN '<i>' || replace(text, chr(10), '<br />') || '</i>' ELSE '' END AS shown
  FROM per_page p JOIN rv r ON r.no = p.first_no)
SELECT shown.book_no, shown.page, true AS has_state, 1 + n_reviews + n_users + n_texts AS n_entities, n_reviews,
  concat_ws(',', CASE WHEN no % 11 <> 3 AND no % 7 = 2 THEN 'text' END, '__typename', 'id',
    CASE WHEN no % 11 = 3 THEN 'text,body' WHEN no % 7 = 2 THEN NULL WHEN no % 2 = 0 THEN 'text' ELSE 'body' END,
    CASE WHEN rating IS NOT NULL THEN 'rating' END,
    CASE no % 3 WHEN 0 THEN 'likesCount' WHEN 1 THEN 'likes' END,
    CASE no % 2 WHEN 0 THEN 'createdAt' ELSE 'dateAdded' END,
    CASE WHEN no % 4 = 1 THEN 'url' END,
    CASE no % 5 WHEN 0 THEN 'creator,user' WHEN 1 THEN 'user' WHEN 2 THEN 'creator' WHEN 3 THEN 'userId,userName' END) AS first_fields,
  CASE WHEN length(shown) > 100 THEN left(shown, 100) || '...' ELSE shown END AS first_preview,
  CAST(rating AS VARCHAR) AS first_rating,
  CASE WHEN no % 5 = 1 THEN 'u' || user_id END AS first_user_id,
  CASE WHEN no % 5 = 1 THEN user_name END AS first_user_name
FROM shown""",
    "entity_types": f"""
WITH {REVIEWS},
linked AS (SELECT * FROM rv WHERE book_no % 5 < 2),
per_page AS (SELECT book_no, page, count(DISTINCT user_id) FILTER (WHERE no % 5 < 2) AS n_users FROM linked GROUP BY ALL)
SELECT 'ROOT_QUERY' AS entity_type, count(*) AS n_entities FROM per_page
UNION ALL SELECT 'Review', (SELECT count(*) FROM linked) + (SELECT count(*) FROM per_page WHERE book_no % 5 = 0)
UNION ALL SELECT 'User', CAST(sum(n_users) AS BIGINT) FROM per_page
UNION ALL SELECT 'Text', count(*) FROM linked WHERE no % 7 = 2 AND no % 11 <> 3""",
    "review_content": f"""
WITH {REVIEWS}
SELECT count(*) AS n_reviews, count(*) FILTER (WHERE no % 11 <> 3) AS n_with_text,
  count(*) FILTER (WHERE rating <> 0) AS n_with_rating FROM rv""",
    "quality_format": _suite("report", "report", _rules("report", *NULLS, "rating_range", "date_form"), extra=1),
    "quality_sample": _suite("fail", "report", _rules("fail", *NULLS, "rating_range", "date_form"), extra=1),
    "quality_read_csv": " UNION ALL ".join(
        "SELECT * FROM (" + _suite(*suite, broken=READ, more=f", '{name}' AS suite") + ")"
        for name, suite in {
            "sample": ("fail", "report", _rules("fail", *NULLS, "rating_range", "date_form"), None, 1, 2),
            "release": (
                "fail",
                "fail",
                {**_rules("fail", "mock_text_inside"), **_rules("warn", *NULLS, "empty_text", "rating_whole")},
                "warn",
                1,
            ),
        }.items()
    ),
    "quality_subset": _suite(
        "fail", None, _rules("fail", "mock_text_start", "mock_user", *NULLS, "rating_range", "date_form")
    ),
    "quality_release": _suite(
        "fail",
        "fail",
        {**_rules("fail", "mock_text_inside"), **_rules("warn", *NULLS, "empty_text", "rating_whole")},
        few_books="warn",
    ),
    "quality_report": _suite("report", "report", _rules("report", "mock_text_inside", *NULLS, "rating_whole")),
    "quality_contract": _suite("fail", "report", _rules("fail", *NULLS, "rating_range", "date_form")),
    "quality_violations": f"""
WITH {FLAT},
broken AS ({' UNION ALL '.join(
    f"SELECT '{name}' AS rule, event_id, CAST({column} AS VARCHAR) AS value FROM damaged WHERE {BROKEN[name]}"
    for name, column in {
        'mock_text_start': 'review_text', 'mock_user': 'reviewer_id', 'null_book_id': 'book_id',
        'null_review_text': 'review_text', 'null_review_rating': 'review_rating',
        'rating_range': 'CAST(review_rating AS DOUBLE)', 'date_form': 'review_date'}.items())})
SELECT rule, row_number() OVER (PARTITION BY rule ORDER BY event_id) AS n, value FROM broken
QUALIFY n <= 5""",
    "real_dates": f"""
WITH {FLAT}
SELECT count(*) FILTER (WHERE NOT {ISO}) AS wrong_form,
  count(*) FILTER (WHERE NOT {ISO} OR try_strptime(review_date, '%Y-%m-%dT%H:%M:%S') IS NULL) AS wrong_form_or_day
FROM damaged""",
    "review_summary": f"""
WITH {FLAT}
SELECT count(*) AS n_reviews, count(DISTINCT book_id) AS n_books, count(DISTINCT reviewer_id) AS n_reviewers,
  round(avg(review_rating), 2) AS avg_rating FROM flat""",
    "rating_distribution": f"""
WITH {FLAT}
SELECT CAST(review_rating AS BIGINT) AS review_rating, count(*) AS n_reviews,
  round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM flat), 1) AS percentage
FROM flat WHERE review_rating IS NOT NULL GROUP BY review_rating""",
    "review_coverage": f"""
WITH {FLAT}
SELECT (SELECT count(*) FROM part) AS n_books, count(DISTINCT book_id) AS books_with_reviews,
  round(100.0::DOUBLE * count(DISTINCT book_id) / (SELECT count(*) FROM part), 1) AS percentage, count(*) AS n_reviews,
  round(count(*)::DOUBLE / count(DISTINCT book_id), 1) AS reviews_per_book FROM flat""",
    "sample_reviews": f"""
WITH {FLAT}
SELECT event_id, title AS title_shown, author AS author_shown, reviewer_name AS reviewer_name_shown,
  reviewer_id AS reviewer_id_shown, coalesce(CAST(review_rating AS VARCHAR), 'Unknown') AS review_rating_shown,
  review_date AS review_date_shown, CAST(review_upvotes AS VARCHAR) AS review_upvotes_shown,
  CASE WHEN length(review_text) > 100 THEN left(review_text, 100) || '...' ELSE review_text END AS text_preview
FROM flat ORDER BY md5(event_id || '|0'), event_id LIMIT 5""",
    "first_reviews": f"""
WITH {FLAT} SELECT event_id, title, reviewer_id, CAST(review_rating AS BIGINT) AS review_rating
FROM flat ORDER BY event_id LIMIT 3""",
    "preview_reviews": f"""
WITH {FLAT}
SELECT event_id,
  CASE WHEN length(review_text) > 100 THEN left(review_text, 100) || '...' ELSE review_text END AS short,
  CASE WHEN length(review_text) > 500 THEN left(review_text, 500) || '...' ELSE review_text END AS long,
  coalesce(review_date, 'Unknown') AS date_shown
FROM damaged""",
    "page_title_links": r"""
WITH read AS (
  SELECT page_id, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw,
    regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading,
    regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a href="([^"]*)"', 1) AS links
  FROM pages)
SELECT page_id, replace(replace(replace(trim(raw), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title,
  len(links) AS n_nav_links,
  replace(array_to_string(links, ' '), '&amp;', '&') AS nav_links, trim(raw) = trim(heading) AS title_is_heading
FROM read""",
}

ORACLE["quality_while_writing"] = ORACLE["quality_release"]
