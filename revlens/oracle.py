"""The same queries as plain SQL, to be run by another engine on the same tables.

Names match the keys of ``revlens.queries.QUERIES``. The SQL is written on its own terms
(window functions, sorted lists) wherever the Spark side takes a different route.
"""

from __future__ import annotations

_ORDER_REVIEWS = """
reviews AS (
  SELECT CASE WHEN CAST(floor(l_quantity) AS BIGINT) <> 13
              THEN CAST(CAST(floor(l_quantity) AS BIGINT) % 11 AS DOUBLE) / 2 END AS rating,
         p_name AS title,
         CAST(l_partkey AS VARCHAR) AS asin,
         CASE WHEN o_custkey % 89 = 0 THEN '' WHEN o_custkey % 97 = 0 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 101 <> 0 THEN epoch_ms(o_orderdate) END AS timestamp,
         CASE WHEN o_orderkey % 101 <> 0 THEN o_orderdate END AS review_ts,
         CASE WHEN l_orderkey % 499 = 0 THEN 20000000
              ELSE CAST(l_linenumber - 1 AS BIGINT) * (l_suppkey % 20) END AS helpful_vote,
         l_returnflag <> 'R' AS verified_purchase,
         CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'book' ELSE 'video_game' END AS category,
         l_orderkey AS okey,
         l_linenumber AS lno
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey)"""

_FINE = (
    _ORDER_REVIEWS
    + """,
fine AS (
  SELECT * REPLACE (user_id || '-' || coalesce(CAST(year(review_ts) AS VARCHAR), '?') AS user_id,
                    concat(asin, '-', CAST(lno AS VARCHAR)) AS asin)
  FROM reviews)"""
)

_DOCUMENT_REVIEWS = """
docs AS (
  SELECT d.doc_id, CASE WHEN d.doc_id % 37 <> 0 THEN CAST(d.doc_id % 12 AS DOUBLE) / 2 END AS rating,
         d.source AS title, d.text AS text,
         CASE WHEN d.lang = 'en' THEN 'book' ELSE 'video_game' END AS category,
         CASE WHEN d.doc_id % 61 = 0 THEN d.doc_id + 10000000
              ELSE CAST(d.doc_id % 7 AS BIGINT) * (d.doc_id % 17) END AS helpful_vote,
         CASE WHEN d.doc_id % 9 <> 0 THEN CAST(d.doc_id % 4 AS INTEGER) ELSE 0 END AS image_count,
         l.quality = 1 AS verified_purchase
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_CALIBRATED = (
    _FINE
    + """,
averaged AS (
  SELECT *, count(rating) OVER (PARTITION BY user_id) AS user_reviews,
         floor(sum(rating) OVER (PARTITION BY user_id)
               / count(rating) OVER (PARTITION BY user_id) * 100 + 0.5) / 100 AS user_avg
  FROM fine),
hundredths AS (
  SELECT *, CASE WHEN rating IS NOT NULL THEN CAST(floor(greatest(1.0::DOUBLE,
              least(5.0::DOUBLE, rating + (3.0::DOUBLE - user_avg))) * 100 + 0.5) AS BIGINT) END AS cents
  FROM averaged WHERE user_reviews >= 3 AND user_id IS NOT NULL)"""
)

_DELTA = (
    _CALIBRATED
    + """,
before AS (
  SELECT asin, sum(rating) / count(rating) AS orig_avg, count(rating) AS "count"
  FROM fine GROUP BY asin),
after AS (
  SELECT asin, CAST(sum(cents) AS DOUBLE) / count(cents) / 100 AS calib_avg
  FROM hundredths GROUP BY asin),
delta AS (
  SELECT before.asin, orig_avg, calib_avg, calib_avg - orig_avg AS delta, "count"
  FROM before JOIN after ON before.asin = after.asin
  WHERE "count" > 5 AND calib_avg IS NOT NULL)"""
)

# The default stop words.
_STOP_WORDS = """
  'the', 'a', 'an', 'and', 'or', 'but', 'is', 'are', 'was', 'were', 'in', 'on', 'at', 'to', 'for',
  'of', 'with', 'by', 'from', 'as', 'this', 'that', 'it', 'be', 'have', 'has', 'had', 'do', 'does',
  'did', 'will', 'would', 'could', 'should', 'may', 'might', 'can'"""

_WORDS = (
    _DOCUMENT_REVIEWS
    + f""",
tokens AS (
  SELECT CAST(floor(rating) AS INTEGER) AS star,
         unnest(string_split(
           replace(replace(replace(replace(lower(text), '.', ''), '><br', ''), '/', ''), '-', ''),
           ' ')) AS word
  FROM docs WHERE floor(rating) BETWEEN 1 AND 5),
counts AS (
  SELECT star, word, count(*) AS n FROM tokens
  WHERE word NOT IN ('', '>') AND word NOT IN ({_STOP_WORDS})
  GROUP BY star, word),
ranked AS (
  SELECT star, word, n, sum(n) OVER (PARTITION BY star) AS total,
         row_number() OVER (PARTITION BY star ORDER BY n DESC, word) AS rank
  FROM counts),
top AS (
  SELECT star, CAST(rank AS INTEGER) AS rank, word, n,
         floor(CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * 100000 + 0.5) / 100000 AS freq
  FROM ranked WHERE rank <= 10)"""
)

# The same with the words of the benchmark as stop words.
_WORDS_LISTED = _WORDS.replace(
    f"({_STOP_WORDS})",
    """(
    SELECT unnest(string_split(lower(text), ' ')) FROM benchmark)""",
)

_LENGTH_BY_VOTES = """
per_vote AS (
  SELECT helpful_vote,
         floor(CAST(sum(length(text)) AS DOUBLE) / count(*) * 100 + 0.5) / 100 AS avg_length
  FROM docs GROUP BY helpful_vote)"""

_SAMPLE_ORDER = "md5(concat(CAST(doc_id AS VARCHAR), '|42'))"


def _stddev(value: str) -> str:
    n, s, q = f"count({value})", f"CAST(sum({value}) AS DOUBLE)", f"CAST(sum({value} * {value}) AS DOUBLE)"
    return f"sqrt({n} * {q} - {s} * {s}) / {n}"


_RATING_STATS = f"""
SELECT count(rating) AS n, sum(rating) / count(rating) AS avg_rating,
       {_stddev("rating")} AS stddev_rating, min(rating) AS min_rating, max(rating) AS max_rating"""

_CATEGORY_SUMMARY = f"""
WITH {_DOCUMENT_REVIEWS}
SELECT category, count(*) AS total_reviews,
       sum(rating) / count(rating) AS avg_rating,
       {_stddev("rating")} AS stddev_rating,
       CAST(sum(length(text)) AS DOUBLE) / count(*) AS avg_review_length,
       {_stddev("length(text)")} AS stddev_review_length,
       CAST(sum(length(title)) AS DOUBLE) / count(*) AS avg_title_length,
       CAST(sum(helpful_vote) AS DOUBLE) / count(*) AS avg_helpful_votes,
       CAST(sum(helpful_vote) AS BIGINT) AS total_helpful_votes,
       CAST(sum(CASE WHEN verified_purchase THEN 1 ELSE 0 END) AS BIGINT) AS verified_purchases,
       CAST(sum(image_count) AS DOUBLE) / count(*) AS avg_images_per_review
FROM docs GROUP BY category ORDER BY category"""

_QUARTILES = f"""
WITH {_DOCUMENT_REVIEWS},
sorted AS (
  SELECT category, list_sort(list(length(text))) AS lengths, count(*) AS n FROM docs GROUP BY category)
SELECT category,
       CAST(lengths[1] AS INTEGER) AS min_length,
       CAST(lengths[1 + n // 4] AS INTEGER) AS q1_length,
       CAST(lengths[1 + n // 2] AS INTEGER) AS median_length,
       CAST(lengths[1 + 3 * n // 4] AS INTEGER) AS q3_length,
       CAST(lengths[n] AS INTEGER) AS max_length
FROM sorted"""

_YEARLY = """
SELECT CAST(year(review_ts) AS INTEGER) AS year, sum(rating) / count(rating) AS avg_rating,
       count(rating) AS num_ratings
FROM reviews WHERE review_ts IS NOT NULL AND rating IS NOT NULL GROUP BY ALL ORDER BY 1"""

_BY_VOTES = """
SELECT helpful_vote, sum(rating) / count(rating) AS avg_rating, count(rating) AS n
FROM reviews WHERE verified_purchase GROUP BY helpful_vote"""


def _pivot(view: str) -> str:
    return f"""
SELECT rating, count(*) FILTER (WHERE category = 'book') AS book,
       count(*) FILTER (WHERE category = 'video_game') AS video_game
FROM {view} GROUP BY rating ORDER BY rating"""


def _helpful(view: str) -> str:
    return f"""
SELECT category, max(helpful_vote) AS max_votes,
       count(*) FILTER (WHERE helpful_vote > 0) AS reviews_with_votes
FROM {view} GROUP BY category"""


def _verified(view: str) -> str:
    return f"""
SELECT category, count(*) AS total, count(*) FILTER (WHERE verified_purchase) AS verified,
       count(*) - count(*) FILTER (WHERE verified_purchase) AS unverified,
       CAST(100 * count(*) FILTER (WHERE verified_purchase) AS DOUBLE) / count(*) AS verified_percent
FROM {view} GROUP BY category"""


_SQL: dict[str, str] = {
    "yearly_trend": f"WITH {_ORDER_REVIEWS} {_YEARLY}",
    "yearly_of_months": f"WITH {_ORDER_REVIEWS} {_YEARLY}",
    "monthly_trend": f"""
WITH {_ORDER_REVIEWS}
SELECT CAST(year(review_ts) AS INTEGER) AS year, CAST(month(review_ts) AS INTEGER) AS month,
       sum(rating) / count(rating) AS avg_rating, count(rating) AS num_ratings,
       strftime(min(review_ts), '%Y-%m') AS label,
       strftime(min(review_ts), '%Y-%m-01') AS month_start
FROM reviews WHERE review_ts IS NOT NULL AND rating IS NOT NULL
GROUP BY year(review_ts), month(review_ts) ORDER BY 1, 2""",
    "trend_total": f"""
WITH {_ORDER_REVIEWS} SELECT count(rating) AS total_ratings FROM reviews WHERE review_ts IS NOT NULL""",
    "rating_stats": f"WITH {_ORDER_REVIEWS} {_RATING_STATS} FROM reviews WHERE verified_purchase",
    "rating_by_votes": f"WITH {_ORDER_REVIEWS} {_BY_VOTES} ORDER BY helpful_vote",
    "rating_by_votes_head": f"WITH {_ORDER_REVIEWS} {_BY_VOTES} ORDER BY helpful_vote LIMIT 10",
    "rating_by_votes_capped": f"WITH {_ORDER_REVIEWS} {_BY_VOTES} HAVING helpful_vote <= 20 AND count(rating) > 0",
    "good_split": f"""
WITH {_ORDER_REVIEWS}
SELECT CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS is_good, count(*) AS n
FROM reviews WHERE verified_purchase AND rating IS NOT NULL GROUP BY 1""",
    "bad_split": f"""
WITH {_ORDER_REVIEWS}
SELECT CASE WHEN rating < 3 THEN 1 ELSE 0 END AS is_bad, count(*) AS n
FROM reviews WHERE rating IS NOT NULL GROUP BY 1""",
    "bad_split_verified": f"""
WITH {_ORDER_REVIEWS}
SELECT CASE WHEN rating < 3 THEN 1 ELSE 0 END AS is_bad, count(*) AS n
FROM reviews WHERE verified_purchase AND rating IS NOT NULL GROUP BY 1""",
    "good_share": f"""
WITH {_ORDER_REVIEWS},
counted AS (
  SELECT count(*) FILTER (WHERE rating >= 4) AS good, count(*) FILTER (WHERE rating < 4) AS not_good
  FROM reviews WHERE verified_purchase)
SELECT good, not_good, CAST(100 * good AS DOUBLE) / (good + not_good) AS good_percent,
       CAST(100 * not_good AS DOUBLE) / (good + not_good) AS not_good_percent
FROM counted""",
    "rating_pivot": f"WITH {_ORDER_REVIEWS} {_pivot('reviews')}",
    "rating_histogram": f"""
WITH {_ORDER_REVIEWS}
SELECT CAST(b.bin AS INTEGER) AS bin, b.bin - 0.5::DOUBLE AS low, b.bin + 0.5::DOUBLE AS high,
       count(r.rating) AS n
FROM range(1, 6) AS b(bin)
LEFT JOIN reviews r ON r.rating >= b.bin - 0.5
  AND (r.rating < b.bin + 0.5 OR (b.bin = 5 AND r.rating = 5.5))
GROUP BY b.bin""",
    "rating_histogram_eq": f"""
WITH {_ORDER_REVIEWS},
span AS (SELECT min(rating) AS low, max(rating) - min(rating) AS width FROM reviews),
bins AS (
  SELECT bin, low + width * (bin - 1) / 5 AS low, low + width * bin / 5 AS high
  FROM span, range(1, 6) AS b(bin))
SELECT CAST(bins.bin AS INTEGER) AS bin, bins.low AS low, bins.high AS high, count(r.rating) AS n
FROM bins LEFT JOIN reviews r
  ON r.rating >= bins.low AND (r.rating < bins.high OR (bins.bin = 5 AND r.rating = bins.high))
GROUP BY bins.bin, bins.low, bins.high""",
    "row_count": f"""
WITH {_ORDER_REVIEWS}
SELECT 'all' AS step, count(*) AS n FROM reviews
UNION ALL SELECT 'dated_and_rated', count(*) FROM reviews WHERE timestamp IS NOT NULL AND rating IS NOT NULL
UNION ALL SELECT 'verified', count(*) FROM reviews WHERE verified_purchase
UNION ALL SELECT 'good', count(*) FROM reviews WHERE rating >= 4""",
    "category_summary": _CATEGORY_SUMMARY,
    "profile_summary": _CATEGORY_SUMMARY,
    "profile_ratings": f"WITH {_DOCUMENT_REVIEWS} {_pivot('docs')}",
    "profile_quartiles": _QUARTILES,
    "profile_helpful": f"WITH {_DOCUMENT_REVIEWS} {_helpful('docs')}",
    "profile_verified": f"WITH {_DOCUMENT_REVIEWS} {_verified('docs')}",
    "category_union": f"""
WITH {_DOCUMENT_REVIEWS}
SELECT doc_id, rating, CASE WHEN category = 'book' THEN title END AS title, helpful_vote,
       CAST(verified_purchase AS VARCHAR) AS verified_purchase, category,
       CAST(length(text) AS INTEGER) AS text_length,
       CAST(CASE WHEN category = 'book' THEN length(title) ELSE 0 END AS INTEGER) AS title_length
FROM docs""",
    "helpful_by_category": f"WITH {_ORDER_REVIEWS} {_helpful('reviews')}",
    "verified_by_category": f"WITH {_ORDER_REVIEWS} {_verified('reviews')}",
    "verified_labels": f"""
WITH {_ORDER_REVIEWS}
SELECT CASE category WHEN 'book' THEN 'Book' WHEN 'video_game' THEN 'Video Game' END AS label,
       format('{{:,}}', count(*)) AS total_label,
       printf('%.1f%%', CAST(100 * count(*) FILTER (WHERE verified_purchase) AS DOUBLE) / count(*))
         AS percent_label
FROM reviews GROUP BY category""",
    "avg_length": f"""
WITH {_DOCUMENT_REVIEWS}
SELECT CAST(sum(length(text)) AS DOUBLE) / count(*) AS avg_length, count(*) AS n
FROM docs WHERE verified_purchase""",
    "length_by_rating": f"""
WITH {_DOCUMENT_REVIEWS}
SELECT rating, CAST(sum(length(text)) AS DOUBLE) / count(*) AS avg_length
FROM docs WHERE verified_purchase GROUP BY rating ORDER BY rating""",
    "length_by_star": f"""
WITH {_DOCUMENT_REVIEWS}
SELECT CAST(floor(rating) AS INTEGER) AS star,
       floor(CAST(sum(length(text)) AS DOUBLE) / count(*) * 100 + 0.5) / 100 AS avg_length
FROM docs WHERE floor(rating) BETWEEN 1 AND 5 GROUP BY 1 ORDER BY 1""",
    "length_by_votes": f"""
WITH {_DOCUMENT_REVIEWS}, {_LENGTH_BY_VOTES}
SELECT helpful_vote, avg_length FROM per_vote ORDER BY helpful_vote DESC""",
    "length_by_vote_band": f"""
WITH {_DOCUMENT_REVIEWS}, {_LENGTH_BY_VOTES},
bands(band, low, high) AS (
  VALUES ('Low', 0, 20), ('Medium-low', 20, 40), ('Medium', 40, 60), ('Medium-high', 60, 80),
         ('High', 80, NULL))
SELECT band, CAST(sum(CAST(floor(avg_length * 100 + 0.5) AS BIGINT)) AS DOUBLE)
             / count(avg_length) / 100 AS mean_of_means
FROM bands LEFT JOIN per_vote ON helpful_vote >= low AND (high IS NULL OR helpful_vote < high)
GROUP BY band""",
    "length_quartiles": _QUARTILES,
    "price_quartiles": """
WITH sorted AS (
  SELECT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'book' ELSE 'video_game' END AS category,
         list_sort(list(l_extendedprice)) AS prices, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE CAST(floor(l_quantity) AS BIGINT) <> 13 GROUP BY 1)
SELECT category, n, prices[1] AS min, prices[1 + n // 4] AS q1, prices[1 + n // 2] AS median,
       prices[1 + 3 * n // 4] AS q3, prices[n] AS max
FROM sorted""",
    "word_counts": f"WITH {_WORDS} SELECT star, word, n FROM counts",
    "top_words": f"WITH {_WORDS} SELECT star, rank, word, n, freq FROM top",
    "top_words_bounded": f"WITH {_WORDS} SELECT star, rank, word, n, freq FROM top",
    "top_words_listed": f"""
WITH {_WORDS_LISTED} SELECT star, rank, word, n, freq FROM top""",
    "top_word_max": f"WITH {_WORDS} SELECT max(freq) AS max_freq FROM top",
    "user_stats": f"""
WITH {_FINE}
SELECT user_id, floor(sum(rating) / count(rating) * 100 + 0.5) / 100 AS avg_rating,
       floor(CAST(sum(helpful_vote) AS DOUBLE) / count(helpful_vote) * 100 + 0.5) / 100 AS avg_helpfulness,
       count(rating) AS review_count
FROM fine GROUP BY user_id ORDER BY avg_helpfulness DESC, user_id""",
    "product_avg": f"""
WITH {_ORDER_REVIEWS}
SELECT asin, sum(rating) / count(rating) AS avg_rating, count(rating) AS n FROM reviews GROUP BY asin""",
    "product_avg_calibrated": f"""
WITH {_CALIBRATED}
SELECT asin, CAST(sum(cents) AS DOUBLE) / count(cents) AS avg_rating, count(cents) AS n
FROM hundredths GROUP BY asin""",
    "calibrated_reviews": f"""
WITH {_CALIBRATED}
SELECT rating, title, asin, user_id, timestamp, helpful_vote, verified_purchase, category, okey, lno,
       CAST(cents AS DOUBLE) / 100 AS calibrated_rating
FROM hundredths""",
    "product_delta": f"WITH {_DELTA} SELECT * FROM delta",
    "product_delta_steps": f"""
WITH {_DELTA}
SELECT 'joined' AS step, count(*) AS n FROM fine
UNION ALL SELECT 'rated', count(rating) FROM fine
UNION ALL SELECT 'of_known_users', count(*) FROM hundredths
UNION ALL SELECT 'products', count(DISTINCT asin) FROM fine
UNION ALL SELECT 'calibrated', count(calib_avg) FROM after
UNION ALL SELECT 'chosen', count(*) FROM delta""",
    "top_delta": f"""
WITH {_DELTA}
SELECT * FROM (SELECT * FROM delta ORDER BY abs(delta) DESC, asin LIMIT 30) ORDER BY orig_avg, asin""",
    "ingest_lenient": """
SELECT CASE WHEN event_id % 16 NOT IN (8, 9) THEN CAST(trunc(value) AS BIGINT) END AS rating, event_type AS title, '' AS text,
       CAST(event_id AS VARCHAR) AS asin, CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_id % 16 <> 7 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS timestamp,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS helpful_vote,
       CASE event_type WHEN 'purchase' THEN 'true' WHEN 'error' THEN NULL ELSE 'false' END
         AS verified_purchase
FROM events WHERE event_type <> 'signup' AND event_id % 16 NOT IN (2, 3, 4, 5, 6, 10)""",
    "ingest_rejects": """
SELECT event_id, CASE WHEN event_id % 16 = 6 THEN 'blank'
                      WHEN event_id % 16 = 5 AND event_type <> 'signup' THEN 'not an object' ELSE 'broken' END AS reason
FROM events WHERE event_type = 'signup' OR event_id % 16 IN (2, 3, 4, 5, 6, 10)""",
    "ingest_counts": """
WITH sorted AS (
  SELECT CASE WHEN event_id % 16 = 6 THEN 'blank' WHEN event_id % 16 = 5 AND event_type <> 'signup' THEN 'not an object'
              WHEN event_type = 'signup' OR event_id % 16 IN (2, 3, 4, 10) THEN 'broken' ELSE 'records' END AS what,
         event_id % 16 AS kind
  FROM events)
SELECT 'lines' AS what, count(*) AS n FROM sorted
UNION ALL SELECT w.what, count(sorted.what) FROM (VALUES ('records'), ('blank'), ('broken'), ('not an object')) w(what)
          LEFT JOIN sorted ON sorted.what = w.what GROUP BY w.what
UNION ALL SELECT 'failed_rating', count(*) FROM sorted WHERE what = 'records' AND kind IN (8, 9)
UNION ALL SELECT 'failed_timestamp', count(*) FROM sorted WHERE what = 'records' AND kind = 7
UNION ALL SELECT 'failed_helpful_vote', 0""",
    "ingest_strict": f"""
WITH {_DOCUMENT_REVIEWS}
SELECT doc_id, '' AS asin, '' AS parent_asin, title, text, coalesce(rating, 0) AS rating, CAST(0 AS BIGINT) AS timestamp,
       '' AS user_id, coalesce(verified_purchase, false) AS verified_purchase, helpful_vote,
       image_count
FROM docs""",
    "ingest_defaults": """
SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k,
       '' AS absent_text, CAST(0 AS DOUBLE) AS absent_number, false AS absent_flag
FROM events""",
    "head_n": """
SELECT event_id, user_id, event_type, value, props FROM events ORDER BY event_id LIMIT 5000""",
    "sample_exact": f"""
SELECT * FROM (SELECT doc_id, text, lang, source, n_chars FROM documents
               ORDER BY {_SAMPLE_ORDER} LIMIT 150)
ORDER BY doc_id""",
    "sample_lines": """
WITH lines AS (SELECT concat(event_type, ' ', CAST(user_id AS VARCHAR)) AS value FROM events),
counted AS (
  SELECT value, md5(concat('{"value":"', value, '"}')) AS code, count(*) AS copies FROM lines GROUP BY value),
placed AS (SELECT value, copies, sum(copies) OVER (ORDER BY code) AS up_to FROM counted),
draws AS (
  SELECT i, CAST('0x' || substr(md5(concat(CAST(i AS VARCHAR), '|42')), 1, 15) AS BIGINT) % (SELECT count(*) FROM events) AS place
  FROM range(2000) r(i)),
chosen AS (SELECT place FROM draws GROUP BY place ORDER BY min(i) LIMIT 150)
SELECT value FROM chosen JOIN placed ON place >= up_to - copies AND place < up_to ORDER BY value""",
    "sample_fraction": """
SELECT event_id, user_id, event_type, value, props FROM events
WHERE substr(md5(concat(CAST(event_id AS VARCHAR), '|42')), 1, 8) < '028f5c28'""",
    "sample_rating_stats": f"""
WITH {_DOCUMENT_REVIEWS},
sample AS (SELECT * FROM docs ORDER BY {_SAMPLE_ORDER} LIMIT 150)
{_RATING_STATS} FROM sample WHERE verified_purchase""",
}


def oracle_queries() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _SQL.items()}
