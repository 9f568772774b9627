"""Checking SQL for the registered queries, for a second engine over the same tables.

Each text is written against the tables (or against the adapters' SQL) without using the
library's own expressions. Averages are rounded half up in integer arithmetic.
"""

from __future__ import annotations

from shelfwise.schemas import NA_TOKENS
from shelfwise.sources.adapters import DATES_SQL, GAMES_SQL, LISTINGS_SQL, MEDIA_SQL, REVIEWS_SQL

_VIEWS = {n: n for n in ("part", "lineitem", "supplier", "orders", "conversations", "pages")}
GAMES = f"games AS ({GAMES_SQL.format(**_VIEWS)})"
LISTINGS = f"listings AS ({LISTINGS_SQL.format(**_VIEWS)})"
DATES = f"dates AS ({DATES_SQL.format(**_VIEWS)})"
REVIEWS = f"reviews AS ({REVIEWS_SQL.format(**_VIEWS)})"
MEDIA = f"media AS ({MEDIA_SQL.format(**_VIEWS)})"
PAIRS = "pairs AS (SELECT DISTINCT id AS game_id, UNNEST(string_split(game_title, ' ')) AS genre_name FROM games)"
GENRES = "genres AS (SELECT DISTINCT genre_name FROM pairs UNION ALL SELECT 'unassigned')"
GENRE_MODEL = f"{GAMES}, {PAIRS}, {GENRES}"
AS_OF = "DATE '1998-06-30'"

SPACE = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def ratio(total: str, n: str, digits: int) -> str:
    """total / n rounded half up, for non-negative integers."""
    scale = 10**digits
    t, k = f"CAST({total} AS BIGINT)", f"CAST({n} AS BIGINT)"
    return f"CASE WHEN {k} > 0 THEN CAST(({2 * scale} * {t} + {k}) // (2 * {k}) AS DOUBLE) / {scale} END"


def mean(column: str, digits: int) -> str:
    return ratio(f"SUM({column})", f"COUNT({column})", digits)


def mean_price(column: str) -> str:
    """Mean of a cents column in whole units, rounded to cents."""
    return f"({ratio(f'SUM({column})', f'COUNT({column})', 0)}) / 100"


def position(order: str) -> str:
    return f"CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INT) AS position"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def present(x: str) -> str:
    tokens = ", ".join("'" + t + "'" for t in NA_TOKENS)
    return f"(CASE WHEN {x} IN ({tokens}) THEN NULL ELSE {x} END)"


def clean(x: str) -> str:
    noise = rf"(?:&nbsp;|&amp;|&lt;|&gt;|&quot;|\\[nrt]|[{SPACE}\x{{200b}}])+"
    return (
        f"(CASE WHEN {strip(x)} IN ('N/A', '', 'n/a', 'NA') THEN NULL "
        f"ELSE NULLIF(TRIM(regexp_replace({x}, '{noise}', ' ', 'g')), '') END)"
    )


def flat(x: str) -> str:
    body = f"regexp_replace(replace({x}, chr(13), ''), '[\\n\\t]', ' ', 'g')"
    return f"(CASE WHEN {x} IS NULL OR {x} IN ('', 'N/A') THEN 'N/A' ELSE {strip(body)} END)"


def title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1:1]) || lower(w[2:])), '')"


def key(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, '[^\\p{{L}}\\p{{N}}_{SPACE}]', '', 'g')"


def price(x: str, us: bool = False) -> str:
    bare = f"regexp_replace(lower({strip(x)}), '[€$£¥]', '', 'g')"
    if us:
        plain = f"replace({bare}, ',', '')"
    else:
        plain = (
            f"CASE WHEN contains({bare}, ',') AND contains({bare}, '.') "
            f"THEN replace(replace({bare}, '.', ''), ',', '.') ELSE replace({bare}, ',', '.') END"
        )
    return (
        f"(CASE WHEN {x} = 'N/A' THEN NULL WHEN contains(lower({x}), 'free') THEN 0.0 "
        f"ELSE TRY_CAST(regexp_extract({plain}, '\\d+\\.?\\d*') AS DOUBLE) END)"
    )


def rating(x: str, source: str) -> str:
    v = f"TRY_CAST({x} AS DECIMAL(18,6))"
    return f"""(CASE
      WHEN {source} = 'instant_gaming' AND {v} BETWEEN 0 AND 10 THEN CAST(ROUND({v} * 10, 1) AS DOUBLE)
      WHEN {source} = 'GOG' AND {v} BETWEEN 0 AND 5 THEN CAST(ROUND({v} * 20, 1) AS DOUBLE)
      WHEN {source} = 'Steam' AND {v} BETWEEN 0 AND 100 THEN CAST(ROUND({v}, 1) AS DOUBLE) END)"""


def genre_list(x: str) -> str:
    parts = f"list_transform(regexp_split_to_array({x}, '[,;|]'), lambda g: trim(g))"
    kept = f"list_filter({parts}, lambda g: length(g) > 1)"
    return f"NULLIF(array_to_string(list_transform({kept}, lambda g: {title('g')}), ', '), '')"


def discount(x: str) -> str:
    return f"TRY_CAST(replace(replace({x}, '%', ''), '-', '') AS DOUBLE)"


# original_raw always has two decimals and discounts are whole numbers, so cents are exact.
_REDUCED = (
    "CASE WHEN disc > 0 THEN CAST((2 * CAST(ROUND(orig * 100) AS BIGINT) * (100 - CAST(disc AS BIGINT)) + 100) // 200 "
    "AS DOUBLE) / 100 END"
)

# The listings conformed to the unified columns; ids stand for arrival order.
CONFORMED = f"""{LISTINGS}, {DATES}, real_dates AS (
 SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 5 THEN make_date(EXTRACT(YEAR FROM o_orderdate), 1, 1)
  WHEN 6 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS release_date FROM orders),
typed AS (
 SELECT l.id, data_source, {clean(present('title_raw'))} AS game_title, release_date,
  {rating(present('rating_raw'), 'data_source')} AS rating,
  CASE WHEN data_source <> 'Steam' THEN {present('review_count_raw')} END AS review_count,
  {price(present('price_raw'))} AS cur, {price(present('original_raw'))} AS orig, {discount(present('discount_raw'))} AS disc,
  {genre_list(clean(present('genres_raw')))} AS genres,
  CASE WHEN lower({strip(present('platforms_raw'))}) IN ('', 'n/a', 'none', 'null') THEN NULL
   ELSE {strip(present('platforms_raw'))} END AS platform,
  {clean(present('developer_raw'))} AS developer, {clean(present('publisher_raw'))} AS publisher,
  CASE WHEN data_source <> 'Steam' THEN {clean(present('description_raw'))} END AS description,
  CASE WHEN data_source = 'GOG' THEN {present('status_raw')} END AS release_status,
  {present('url_raw')} AS game_url
 FROM listings l LEFT JOIN real_dates d ON d.id = l.id),
conformed AS (
 SELECT data_source, game_title, release_date, rating, review_count, COALESCE(cur, {_REDUCED}, orig) AS discounted_price,
  orig AS original_price, disc AS discount_percentage, genres, platform, developer, publisher, description,
  release_status, game_url, id AS ingest_ord
 FROM typed WHERE game_title IS NOT NULL
 QUALIFY ROW_NUMBER() OVER (PARTITION BY data_source, game_url ORDER BY id) = 1)"""

_SCORE = (
    "CAST(rating IS NOT NULL AS INT) * 3 + CAST(release_date IS NOT NULL AS INT) + CAST(developer IS NOT NULL AS INT) "
    "+ CAST(publisher IS NOT NULL AS INT) + CAST(genres IS NOT NULL AS INT) + CAST(description IS NOT NULL AS INT)"
)
MASTER = f"""{CONFORMED}, master AS (
 SELECT * EXCLUDE (ingest_ord) FROM conformed
 QUALIFY ROW_NUMBER() OVER (PARTITION BY {key('game_title')} ORDER BY {_SCORE} DESC,
  CASE data_source WHEN 'Steam' THEN 1 WHEN 'instant_gaming' THEN 2 ELSE 3 END,
  game_url ASC NULLS LAST, ingest_ord) = 1)"""

_TEXTS = ("data_source", "game_title", "genres", "platform", "developer", "publisher", "description", "release_status", "game_url")
_NUMBERS = ("rating", "discounted_price", "original_price", "discount_percentage")


def unknowns(columns=_TEXTS) -> str:
    return " + ".join(f"CAST({c} = 'Unknown' AS INT)" for c in columns)


def fill(source: str, name: str, review_count: bool) -> str:
    """Critical rows of ``source`` with placeholders, as CTE ``name``."""
    columns = [f"COALESCE({c}, 'Unknown') AS {c}" for c in _TEXTS] + [f"COALESCE({c}, 0) AS {c}" for c in _NUMBERS]
    if review_count:
        number = "TRY_CAST(regexp_extract(replace(review_count, ',', ''), '(\\d+)', 1) AS DOUBLE)"
        columns.append(f"COALESCE({number}, 0) AS review_count")
    return (
        f"{name} AS (SELECT release_date, {', '.join(columns)} FROM {source} "
        "WHERE rating IS NOT NULL AND release_date IS NOT NULL)"
    )


_DERIVED_DISCOUNT = """CASE WHEN {o} > 0 AND {d} > 0 THEN
  CASE WHEN {d} > {o} THEN 0 ELSE CAST((20000 * (CAST(ROUND({o} * 100000) AS HUGEINT) - CAST(ROUND({d} * 100000) AS HUGEINT))
   + CAST(ROUND({o} * 100000) AS HUGEINT)) // (2 * CAST(ROUND({o} * 100000) AS HUGEINT)) AS DOUBLE) / 100 END
  WHEN {c} < 0 THEN 0 ELSE {c} END"""
FINAL = f"""{MASTER}, {fill('master', 'filled', True)}, final AS (
 SELECT data_source, game_title, release_date, rating, review_count, discounted_price, original_price,
  {_DERIVED_DISCOUNT.format(o='original_price', d='discounted_price', c='discount_percentage')} AS discount_percentage,
  genres, platform, developer, publisher, description,
  CASE WHEN release_date <= {AS_OF} THEN 'Released' ELSE 'Upcoming' END AS release_status, game_url
 FROM filled WHERE {unknowns()} <= 3 AND NOT (developer = 'Unknown' AND publisher = 'Unknown'))"""

_LOADED = f"""{FINAL}, loaded AS (
 SELECT ROW_NUMBER() OVER (ORDER BY game_title, data_source, game_url, release_date) AS id, data_source, game_title, release_date,
  NULLIF(CAST(trunc(rating) AS INT), 0) AS rating, NULLIF(CAST(review_count AS BIGINT), 0) AS review_count,
  NULLIF(CAST(CAST(discounted_price AS DECIMAL(12,2)) AS DOUBLE), 0) AS discounted_price,
  NULLIF(CAST(CAST(original_price AS DECIMAL(12,2)) AS DOUBLE), 0) AS original_price,
  NULLIF(discount_percentage, 0) AS discount_percentage, platform, developer, publisher, release_status, game_url, genres
 FROM final)"""


def tall(source: str, columns, condition, value: str, total: bool = False, label: str = "field") -> str:
    """UNION ALL of counts of a condition per column."""
    extra = ", COUNT(*) AS total" if total else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {label}, COUNT(*) FILTER (WHERE {condition(c)}) AS {value}{extra} FROM {source}" for c in columns
    )


ORACLES: dict[str, str] = {}

# --------------------------------------------------------------------------
# Business and market questions.
# --------------------------------------------------------------------------
ORACLES["bq1_top_rated"] = f"""WITH {GAMES}, popular AS (SELECT * FROM games WHERE review_count > 1000)
SELECT {position('rating DESC, review_count DESC, id')}, game_title, rating, review_count FROM popular
WHERE rating = (SELECT MAX(rating) FROM popular) ORDER BY rating DESC, review_count DESC, id LIMIT 5"""
ORACLES["bq2_top_performers"] = f"""WITH {GAMES}
SELECT {position('rating DESC, review_count DESC, id')}, game_title, rating, review_count, data_source, platform
FROM games WHERE rating >= 85 AND review_count >= 50 ORDER BY rating DESC, review_count DESC, id LIMIT 10"""
ORACLES["bq3_hidden_gems"] = f"""WITH {GAMES}
SELECT {position('rating DESC, id')}, game_title, rating, review_count, data_source, developer
FROM games WHERE rating >= 85 AND review_count < 20 ORDER BY rating DESC, id LIMIT 10"""
ORACLES["bq4_consistent_publishers"] = f"""WITH {GAMES}, s AS (
 SELECT publisher, {mean('rating', 2)} AS avg_rating, COUNT(*) AS total_games, MIN(rating) AS min_rating,
  MAX(rating) AS max_rating FROM games WHERE publisher <> '' AND rating IS NOT NULL GROUP BY publisher HAVING COUNT(*) >= 5)
SELECT *, {position('avg_rating DESC, publisher')} FROM s ORDER BY avg_rating DESC, publisher LIMIT 10"""
ORACLES["bq5_platform_pricing"] = f"""WITH {GAMES}, s AS (
 SELECT platform, CAST(SUM(disc_cents) AS BIGINT) AS t, COUNT(*) AS game_count FROM games WHERE disc_cents > 0 GROUP BY platform)
SELECT platform, ({ratio('t', 'game_count', 0)}) / 100 AS avg_discounted_price, game_count FROM s
WHERE t / game_count = (SELECT MAX(t / game_count) FROM s)"""
ORACLES["bq6_discount_deals"] = f"""WITH {GAMES}
SELECT {position('discount_percentage DESC, rating DESC, id')}, game_title, rating, orig_cents / 100 AS original_price,
 disc_cents / 100 AS discounted_price, CAST(discount_percentage AS DOUBLE) AS discount_percentage, platform,
 (orig_cents - disc_cents) / 100 AS savings
FROM games WHERE rating >= 80 AND discount_percentage >= 50 AND disc_cents IS NOT NULL
ORDER BY discount_percentage DESC, rating DESC, id LIMIT 10"""
_GENRE_PRICE = f"""g AS (
 SELECT genre_name, {mean_price('orig_cents')} AS avg_price, COUNT(DISTINCT id) AS game_count, {mean('rating', 2)} AS avg_rating
 FROM pairs JOIN games ON id = game_id WHERE orig_cents > 0 GROUP BY genre_name)"""
ORACLES["bq7_genre_price"] = f"""WITH {GENRE_MODEL}, {_GENRE_PRICE}
SELECT {position('avg_price DESC, genre_name')}, * FROM g WHERE game_count >= 10 ORDER BY avg_price DESC, genre_name LIMIT 10"""
ORACLES["bq8_developer_efficiency"] = f"""WITH {GAMES}, s AS (
 SELECT developer, COUNT(*) AS total_games, {mean('rating', 2)} AS avg_rating, CAST(SUM(review_count) AS BIGINT) AS total_reviews,
  {mean_price('orig_cents')} AS avg_price
 FROM games WHERE developer <> '' AND rating IS NOT NULL GROUP BY developer HAVING COUNT(*) >= 3)
SELECT *, {position('avg_rating DESC, total_games, developer')} FROM s ORDER BY avg_rating DESC, total_games, developer LIMIT 10"""


def _cross_platform(source: str, minimum: int) -> str:
    return f"""s AS (
 SELECT game_title, COUNT(DISTINCT platform) AS platform_count,
  array_to_string(list_sort(list_distinct(list(platform))), ',') AS platforms,
  CAST(SUM(rating) AS BIGINT) / COUNT(rating) AS avg_rating, CAST(SUM(review_count) AS BIGINT) / COUNT(review_count) AS avg_reviews
 FROM {source} WHERE platform <> '' GROUP BY game_title HAVING COUNT(DISTINCT platform) > {minimum})
SELECT *, {position('platform_count DESC, avg_rating DESC NULLS LAST, game_title')} FROM s
ORDER BY platform_count DESC, avg_rating DESC NULLS LAST, game_title LIMIT 10"""


ORACLES["bq9_cross_platform"] = f"WITH {GAMES}, {_cross_platform('games', 1)}"
ORACLES["bq9_cross_platform_lists"] = f"""WITH {GAMES}, listed AS (
 SELECT game_title, rating, review_count, UNNEST([platform, publisher]) AS platform FROM games),
{_cross_platform('listed', 6)}"""
ORACLES["bq10_genre_reviews"] = f"""WITH {GENRE_MODEL}, s AS (
 SELECT genre_name, COUNT(DISTINCT id) AS game_count, CAST(SUM(review_count) AS BIGINT) AS total_reviews,
  {mean('rating', 2)} AS avg_rating, {mean('review_count', 0)} AS avg_reviews_per_game
 FROM pairs JOIN games ON id = game_id WHERE review_count IS NOT NULL GROUP BY genre_name HAVING COUNT(DISTINCT id) >= 5)
SELECT *, {position('total_reviews DESC, genre_name')} FROM s ORDER BY total_reviews DESC, genre_name LIMIT 10"""
ORACLES["price_by_genre"] = f"""WITH {GENRE_MODEL}, {_GENRE_PRICE}, ranked AS (
 SELECT genre_name, avg_price, game_count, ROW_NUMBER() OVER (ORDER BY avg_price DESC, genre_name) AS hi,
  ROW_NUMBER() OVER (ORDER BY avg_price, genre_name) AS lo FROM g)
SELECT genre_name, avg_price, game_count, CAST(hi AS INT) AS position, 'highest' AS side FROM ranked WHERE hi <= 10
UNION ALL SELECT genre_name, avg_price, game_count, CAST(lo AS INT), 'lowest' FROM ranked WHERE lo <= 10"""
ORACLES["discount_by_genre_source"] = f"""WITH {GENRE_MODEL}
SELECT genre_name, data_source, COUNT(*) AS games_on_sale, {mean_price('discount_percentage * 100')} AS avg_discount,
 CAST(MAX(discount_percentage) AS DOUBLE) AS max_discount
FROM pairs JOIN games ON id = game_id WHERE discount_percentage > 0 GROUP BY genre_name, data_source"""
ORACLES["bq7_known"] = ORACLES["bq7_genre_price"].replace("WHERE game_count", "WHERE genre_name <> 'ring' AND game_count")
ORACLES["bq10_known"] = ORACLES["bq10_genre_reviews"].replace("WHERE review_count", "WHERE genre_name <> 'ring' AND review_count")
ORACLES["price_by_genre_known"] = ORACLES["price_by_genre"].replace("AS lo FROM g)", "AS lo FROM g WHERE genre_name <> 'ring')")
ORACLES["discount_by_genre_source_known"] = ORACLES["discount_by_genre_source"].replace(
    "WHERE discount", "WHERE genre_name <> 'ring' AND discount"
)
ORACLES["bq9_known"] = f"WITH {GAMES}, known AS (SELECT * FROM games WHERE id % 3 <> 0), {_cross_platform('known', 1)}"
_ANSWERS = {
    "bq1_top_rated": (["game_title"], ["rating", "review_count"]),
    "bq2_top_performers": (["game_title", "data_source", "platform"], ["rating", "review_count"]),
    "bq3_hidden_gems": (["game_title", "data_source", "developer"], ["rating", "review_count"]),
    "bq4_consistent_publishers": (["publisher"], ["avg_rating", "total_games", "min_rating", "max_rating"]),
    "bq5_platform_pricing": (["platform"], ["avg_discounted_price", "game_count"]),
    "bq6_discount_deals": (
        ["game_title", "platform"], ["rating", "original_price", "discounted_price", "discount_percentage", "savings"],
    ),
    "bq8_developer_efficiency": (["developer"], ["total_games", "avg_rating", "total_reviews", "avg_price"]),
    "bq9_cross_platform": (["game_title", "platforms"], ["platform_count", "avg_rating", "avg_reviews"]),
    "bq7_genre_price": (["genre_name"], ["avg_price", "game_count", "avg_rating"]),
    "bq10_genre_reviews": (["genre_name"], ["game_count", "total_reviews", "avg_rating", "avg_reviews_per_game"]),
}
ORACLES["price_rating_corr"] = f"""WITH {GAMES}
SELECT COUNT(*) AS n, ROUND(CORR(disc_cents / 100, rating), 6) AS price_rating_corr FROM games
WHERE disc_cents IS NOT NULL AND rating IS NOT NULL"""
ORACLES["value_by_price_bucket"] = f"""WITH {GAMES}, s AS (
 SELECT CAST(LEAST(disc_cents // 10000 + 1, 11) AS INT) AS price_bucket, COUNT(*) AS games, {mean('rating', 2)} AS avg_rating
 FROM games WHERE disc_cents IS NOT NULL AND rating IS NOT NULL GROUP BY 1)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY avg_rating DESC, price_bucket) AS INT) AS value_rank FROM s"""
ORACLES["rating_gap"] = f"""WITH {CONFORMED}, per_source AS (
 SELECT {key('game_title')} AS title_key, data_source,
  CAST(ROUND(100 * ({ratio('SUM(CAST(ROUND(rating * 10) AS BIGINT))', 'COUNT(rating) * 10', 2)})) AS BIGINT) AS h
 FROM conformed WHERE rating IS NOT NULL GROUP BY 1, 2),
gaps AS (SELECT title_key, MAX({{'h': h, 's': data_source}}) AS t, MIN({{'h': h, 's': data_source}}) AS b, COUNT(*) AS n
 FROM per_source GROUP BY title_key)
SELECT title_key, t.s AS high_source, b.s AS low_source, t.h / 100 AS high_rating, b.h / 100 AS low_rating,
 (t.h - b.h) / 100 AS gap FROM gaps WHERE n > 1 ORDER BY gap DESC, title_key LIMIT 10"""
ORACLES["publisher_stability"] = f"""WITH {GAMES}
SELECT publisher, COUNT(*) AS total_games, {mean('rating', 2)} AS avg_rating,
 ROUND(SQRT(CAST(COUNT(*) * SUM(rating * rating) - SUM(rating) * SUM(rating) AS DOUBLE)) / COUNT(*), 4) AS rating_stddev
FROM games WHERE publisher <> '' AND rating IS NOT NULL GROUP BY publisher HAVING COUNT(*) >= 5"""
ORACLES["feature_lift"] = f"""WITH {GAMES}, rated AS (SELECT * FROM games WHERE rating IS NOT NULL),
f AS (SELECT DISTINCT id, rating, UNNEST(list_append(string_split(game_title, ' '), platform)) AS feature FROM rated),
o AS (SELECT {ratio('SUM(rating) * 100', 'COUNT(*)', 0)} AS a FROM rated),
s AS (SELECT feature, COUNT(*) AS games, {ratio('SUM(rating) * 100', 'COUNT(*)', 0)} AS own FROM f GROUP BY feature HAVING COUNT(*) >= 3)
SELECT feature, games, own / 100 AS avg_rating, a / 100 AS overall_rating, (own - a) / 100 AS lift FROM s, o"""


def _release_stats(key_sql: str, where: str) -> str:
    return f"""SELECT {key_sql}, COUNT(*) AS games, {mean_price('orig_cents')} AS avg_original_price,
 {mean_price('disc_cents')} AS avg_discounted_price, {mean('rating', 2)} AS avg_rating FROM spread WHERE {where} GROUP BY 1"""


_AGE = f"({AS_OF} - release_date)"
_SPREAD = f"""{GAMES}, spread AS (SELECT * REPLACE (CASE WHEN rating IS NOT NULL
 THEN release_date + CAST(id * 13 % 2500 AS INT) END AS release_date) FROM games)"""
ORACLES["new_vs_catalog"] = f"""WITH {_SPREAD} """ + _release_stats(
    f"""CASE WHEN release_date IS NULL THEN 'Unknown' WHEN {_AGE} < 0 THEN 'unreleased' WHEN {_AGE} < 365 THEN '0-1 years'
 WHEN {_AGE} < 1095 THEN '1-3 years' WHEN {_AGE} < 1825 THEN '3-5 years' ELSE '5+ years' END AS age_class""", "TRUE")
ORACLES["release_years"] = f"WITH {_SPREAD} " + _release_stats(
    "CAST(EXTRACT(YEAR FROM release_date) AS INT) AS release_year", "release_date IS NOT NULL")
ORACLES["top_rated_games"] = f"""WITH {GAMES} SELECT id, game_title, rating, review_count, developer, platform FROM games
WHERE rating IS NOT NULL AND review_count > 100 ORDER BY rating DESC, review_count DESC, id LIMIT 10"""
ORACLES["adhoc_sql"] = f"""WITH {GAMES} SELECT data_source, COUNT(*) AS n, MAX(rating) AS best FROM games
WHERE rating >= 50 AND platform <> 'PROMO' GROUP BY data_source"""

# --------------------------------------------------------------------------
# Relational model, lookups, reviews.
# --------------------------------------------------------------------------
ORACLES["genre_dim"] = f"""WITH {GAMES}, {PAIRS}
SELECT ROW_NUMBER() OVER (ORDER BY genre_name) AS id, genre_name FROM (SELECT DISTINCT genre_name FROM pairs)"""
ORACLES["genre_bridge"] = f"""WITH {GAMES}, {PAIRS}, dim AS (
 SELECT ROW_NUMBER() OVER (ORDER BY genre_name) AS genre_id, genre_name FROM (SELECT DISTINCT genre_name FROM pairs))
SELECT game_id, genre_id FROM pairs JOIN dim USING (genre_name)"""
ORACLES["games_by_genre"] = f"""WITH {GAMES}, {PAIRS}
SELECT id, game_title, rating, platform FROM games JOIN pairs ON id = game_id WHERE genre_name = 'ring' ORDER BY id LIMIT 10"""
ORACLES["games_with_genres"] = f"""WITH {GAMES}, {PAIRS}
SELECT id, game_title, string_agg(genre_name, '|' ORDER BY genre_name) AS genre_names
FROM games JOIN pairs ON id = game_id GROUP BY id, game_title"""
ORACLES["genre_distribution"] = f"""WITH {GENRE_MODEL}
SELECT g.genre_name, COUNT(p.game_id) AS game_count FROM genres g LEFT JOIN pairs p ON p.genre_name = g.genre_name
GROUP BY g.genre_name"""
_COUNTS = f"""SELECT 'games' AS {{0}}, COUNT(*) AS n{{1}} FROM games UNION ALL SELECT 'genres', COUNT(*){{1}} FROM genres
UNION ALL SELECT 'game_genres', COUNT(*){{1}} FROM pairs UNION ALL SELECT 'user_reviews', COUNT(*){{1}} FROM reviews"""
_REGISTERED = f"""files AS (
 SELECT CAST(regexp_extract(path, '/game_([0-9]+)_', 1) AS BIGINT) AS game_id,
  CASE WHEN contains(path, '/videos/') THEN 'video' ELSE 'image' END AS media_type,
  regexp_extract(path, '/game_[0-9]+_(.*)$', 1) AS file_name, path AS file_path, length AS file_size FROM media),
registered AS (SELECT * FROM files WHERE game_id IN (SELECT id FROM games))"""
ORACLES["table_counts"] = f"WITH {GENRE_MODEL}, {REVIEWS} " + _COUNTS.format("table_name", "")
_MEDIA_STATS = "SELECT media_type{0}, COUNT(*) AS {1}, CAST(COALESCE(SUM(file_size), 0) AS BIGINT) AS bytes FROM registered GROUP BY media_type"
ORACLES["database_stats"] = (
    f"WITH {GENRE_MODEL}, {REVIEWS}, {MEDIA}, {_REGISTERED} " + _COUNTS.format("item", ", CAST(NULL AS BIGINT) AS bytes")
    + " UNION ALL " + _MEDIA_STATS.format(" AS item", "n")
)
ORACLES["media_stats"] = f"WITH {GAMES}, {MEDIA}, {_REGISTERED} " + _MEDIA_STATS.format("", "files")
ORACLES["media_files"] = f"WITH {GAMES}, {MEDIA}, {_REGISTERED} SELECT * FROM registered"
ORACLES["developer_stats"] = f"""WITH {GAMES}
SELECT developer, COUNT(*) AS game_count, CAST(SUM(rating) AS BIGINT) / NULLIF(COUNT(rating), 0) AS avg_rating, CAST(SUM(review_count) AS BIGINT) AS total_reviews,
 MIN(release_date) AS first_release, MAX(release_date) AS latest_release FROM games GROUP BY developer"""
ORACLES["entity_reviews"] = f"""WITH {REVIEWS}
SELECT game_id, user_name, rating, review_text, helpful_count, review_date FROM reviews"""
ORACLES["find_by_title"] = f"""WITH {GAMES}
(SELECT 'exact' AS kind, id, game_title FROM games WHERE game_title = 'cold ring' ORDER BY id LIMIT 1)
UNION ALL (SELECT 'partial', id, game_title FROM games WHERE contains(lower(game_title), 'd rin') ORDER BY id LIMIT 1)
UNION ALL (SELECT 'literal', id, game_title FROM games WHERE contains(game_title, '%ring') ORDER BY id LIMIT 1)"""
ORACLES["find_by_titles"] = f"WITH {GAMES} SELECT MIN(id) AS id, game_title FROM games GROUP BY game_title"
ORACLES["find_by_title_parts"] = f"""WITH {GAMES}, wanted AS (
 SELECT DISTINCT UNNEST([upper(substr(p_name, 3, 6)), p_name, substr(p_name, 1, 2), 'no ' || p_name]) AS wanted FROM part),
titles AS (SELECT game_title, MIN(id) AS id FROM games GROUP BY game_title)
SELECT wanted, id, game_title FROM wanted JOIN titles ON game_title ILIKE '%' || wanted || '%'
QUALIFY ROW_NUMBER() OVER (PARTITION BY wanted ORDER BY game_title <> wanted, id) = 1"""
ORACLES["append_reviews_valid"] = f"""WITH {GAMES}, {REVIEWS}
SELECT id, game_id, user_name, rating, review_text, COALESCE(helpful_count, 0) AS helpful_count, review_date FROM reviews
WHERE (rating BETWEEN 0 AND 100 OR rating IS NULL) AND user_name IS NOT NULL AND game_id IN (SELECT id FROM games)"""
ORACLES["append_reviews_rejected"] = f"""WITH {GAMES}, {REVIEWS}
SELECT r.id, game_id, r.rating, CASE WHEN r.rating NOT BETWEEN 0 AND 100 THEN 'rating out of range'
 WHEN user_name IS NULL THEN 'user name missing' ELSE 'unknown game' END AS reason
FROM reviews r LEFT JOIN games g ON g.id = game_id
WHERE r.rating NOT BETWEEN 0 AND 100 OR user_name IS NULL OR g.id IS NULL"""
ORACLES["model_games"] = f"WITH {_LOADED} SELECT * EXCLUDE (genres, id) FROM loaded"
_RULES = [
    *(f"{t}.id {r}" for t in ("games", "genres", "game_genres", "media_files", "user_reviews") for r in ("not null", "unique")),
    "games.game_title not null", "genres.genre_name not null", "genres.genre_name unique", "game_genres pair unique",
    "game_genres.game_id references games", "game_genres.genre_id references genres",
    "media_files.game_id references games", "user_reviews.game_id references games", "user_reviews.user_name not null",
    "user_reviews.rating in range", "games.created_at not null", "media_files.uploaded_at not null", "user_reviews.review_date not null",
]
ORACLES["audit_stored_model"] = f"SELECT UNNEST({_RULES}) AS rule, 0 AS violations"
ORACLES["append_twice"] = f"""WITH {GAMES}, {REVIEWS}
SELECT game_id, user_name, rating, review_text, COALESCE(helpful_count, 0) AS helpful_count, CAST(review_date AS TIMESTAMP) AS review_date FROM reviews
WHERE (rating BETWEEN 0 AND 100 OR rating IS NULL) AND user_name IS NOT NULL AND game_id IN (SELECT id FROM games)"""
ORACLES["cascade_rewrite"] = f"""WITH {GENRE_MODEL}, {REVIEWS}, {MEDIA}, {_REGISTERED}, kept AS (SELECT id FROM games WHERE rating < 80 OR rating IS NULL)
SELECT 'games' AS item, COUNT(*) AS n FROM kept UNION ALL SELECT 'genres', COUNT(*) FROM genres
UNION ALL SELECT 'game_genres', COUNT(*) FROM pairs WHERE game_id IN (SELECT id FROM kept)
UNION ALL SELECT 'media_files', COUNT(*) FROM registered WHERE game_id IN (SELECT id FROM kept)
UNION ALL SELECT 'user_reviews', COUNT(*) FROM reviews
 WHERE (rating BETWEEN 0 AND 100 OR rating IS NULL) AND user_name IS NOT NULL AND game_id IN (SELECT id FROM kept)
UNION ALL SELECT 'violations', 0"""
ORACLES["media_file_scan"] = f"""WITH {GAMES}, files AS (
 SELECT n_nationkey * 7 AS game_id, CASE WHEN n_nationkey % 3 = 0 THEN 'video' ELSE 'image' END AS media_type, 'list.txt' AS file_name,
  CAST(SUM(strlen(s_name) + 1) AS BIGINT) AS file_size FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_nationkey)
SELECT * FROM files WHERE game_id IN (SELECT id FROM games)"""
ORACLES["bucketed_genre_price"] = ORACLES["bq7_genre_price"]
ORACLES["model_genres"] = f"""WITH {_LOADED}, links AS (
 SELECT DISTINCT id, trim(UNNEST(string_split(genres, ','))) AS genre_name FROM loaded)
SELECT genre_name, COUNT(*) AS game_count FROM links WHERE genre_name <> '' GROUP BY genre_name"""
ORACLES["model_second_load"] = f"""{ORACLES["model_genres"]}
UNION ALL SELECT 'all games', COUNT(*) FROM loaded UNION ALL SELECT 'violations', 0"""
_BROKEN = f"""{GAMES}, broken AS (SELECT id, game_title, rating FROM games
 UNION ALL SELECT id, NULL, rating + 3 FROM games WHERE rating > 95)"""
ORACLES["audit_not_null"] = f"""WITH {_BROKEN} SELECT id, 'game_title' AS column_name FROM broken WHERE game_title IS NULL
UNION ALL SELECT id, 'rating' FROM broken WHERE rating IS NULL"""
ORACLES["audit_unique"] = f"WITH {_BROKEN} SELECT id, COUNT(*) AS n FROM broken GROUP BY id HAVING COUNT(*) > 1"
ORACLES["audit_check"] = f"WITH {_BROKEN} SELECT * FROM broken WHERE rating > 100 OR rating < 0"
ORACLES["audit_fk"] = f"WITH {GAMES}, {REVIEWS} SELECT game_id, id FROM reviews WHERE game_id NOT IN (SELECT id FROM games)"
ORACLES["cascade_delete"] = f"WITH {GAMES}, {REVIEWS} SELECT game_id, id FROM reviews WHERE game_id IN (SELECT id FROM games)"
ORACLES["audit_catalogue"] = f"""WITH {GAMES}, {REVIEWS}
SELECT 'games.game_title not null' AS rule, COUNT(*) FILTER (WHERE game_title IS NULL) AS violations FROM games
UNION ALL SELECT 'games.id unique', COUNT(*) - COUNT(DISTINCT id) FROM games
UNION ALL SELECT 'genres.genre_name not null', 0
UNION ALL SELECT 'genres.genre_name unique', 0
UNION ALL SELECT 'game_genres pair unique', COUNT(*) FROM (SELECT game_id FROM reviews GROUP BY game_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'game_genres.game_id references games', COUNT(*) FROM reviews WHERE game_id NOT IN (SELECT id FROM games)
UNION ALL SELECT 'game_genres.genre_id references genres', COUNT(*) FROM reviews"""


# --------------------------------------------------------------------------
# Scalar functions.
# --------------------------------------------------------------------------

def _on_listings(columns: str) -> str:
    return f"WITH {LISTINGS} SELECT id, {columns} FROM listings"


ORACLES["norm_rating"] = _on_listings(f"{rating('rating_raw', 'data_source')} AS rating")
ORACLES["norm_price"] = _on_listings(f"{price('price_raw')} AS price, {price('price_raw', us=True)} AS price_us")
ORACLES["clean_platform"] = _on_listings(
    "CASE WHEN lower(trim(platforms_raw)) IN ('', 'n/a', 'none', 'null') THEN NULL ELSE trim(platforms_raw) END AS platform")
ORACLES["discount_number"] = _on_listings(f"{discount('discount_raw')} AS discount")
ORACLES["final_price"] = f"""WITH {LISTINGS}, t AS (
 SELECT id, {price('original_raw')} AS orig, {discount('discount_raw')} AS disc,
  CASE WHEN id % 3 = 0 THEN {price('price_raw')} END AS cur FROM listings)
SELECT id, COALESCE(cur, {_REDUCED}, orig) AS final_price FROM t"""
ORACLES["review_count"] = _on_listings(
    "TRY_CAST(regexp_extract(replace(review_count_raw, ',', ''), '(\\d+)', 1) AS DOUBLE) AS review_count")
_CONTAINS = "contains(lower(review_text), '{}')"
ORACLES["text_rating_score"] = _on_listings("""CASE id % 10 WHEN 0 THEN 95 WHEN 1 THEN 85 WHEN 2 THEN 75 WHEN 3 THEN 75
 WHEN 4 THEN 50 WHEN 5 THEN 30 WHEN 6 THEN 25 WHEN 7 THEN 25 WHEN 8 THEN 25 END AS score,
 CASE id % 10 WHEN 0 THEN 95 WHEN 1 THEN 85 WHEN 2 THEN 70 WHEN 3 THEN 75 WHEN 4 THEN 50 WHEN 5 THEN 30 WHEN 6 THEN 25
 WHEN 7 THEN 15 WHEN 8 THEN 5 END AS strict_score""")
ORACLES["review_pct"] = _on_listings("TRY_CAST(regexp_extract(review_text, '(\\d+)%', 1) AS INT) AS pct")
ORACLES["id_from_url"] = _on_listings("NULLIF(regexp_extract(url_raw, '/(\\d+)-', 1), '') AS product_id")
ORACLES["currency_sign"] = _on_listings("NULLIF(regexp_extract(price_raw, '[€$£¥₹₽]'), '') AS currency")
ORACLES["price_display"] = _on_listings("""CASE WHEN id % 2 = 0 AND original_raw <> 'N/A' THEN original_raw
 WHEN contains(price_raw, 'Free') THEN 'Free' ELSE price_raw END AS shown""")
ORACLES["genres_list"] = _on_listings(f"{genre_list('genres_raw')} AS genres")
ORACLES["player_flags"] = _on_listings("""CASE WHEN contains(lower(title_raw), 'ring') THEN 'Yes' ELSE 'No' END AS multiplayer,
 CASE WHEN contains(lower(title_raw), 'cold') THEN 'Yes' ELSE 'No' END AS singleplayer""")
ORACLES["platform_flags"] = _on_listings("""CASE platforms_raw WHEN 'none' THEN 'N/A' ELSE trim(platforms_raw) END AS platforms,
 CASE platforms_raw WHEN 'none' THEN 'N/A' ELSE trim(platforms_raw) END AS icon_platforms""")
ORACLES["list_text"] = _on_listings("""regexp_replace(replace(genres_raw, '|x;', '|'), ', ', '|', 'g') AS pipe,
 CASE WHEN contains(genres_raw, '|x;') THEN 'x' ELSE 'N/A' END AS comma""")
ORACLES["edition_text"] = _on_listings("""CASE data_source
 WHEN 'Steam' THEN CONCAT(split_part(genres_raw, ', ', 1), ': ', price_raw)
 WHEN 'instant_gaming' THEN CONCAT(genres_raw, ': ', price_raw)
 ELSE CONCAT(split_part(genres_raw, '|', 1), ': ', price_raw, '|', split_part(genres_raw, ';', 2), ': ', original_raw) END AS editions""")
ORACLES["user_tags"] = _on_listings("""COALESCE(NULLIF(array_to_string(list_filter(list_transform(
 (string_split(CONCAT(title_raw, ' ... x'), ' '))[1:3], lambda t: trim(t)), lambda t: t NOT IN ('', '...')), '|'), ''), 'N/A') AS tags""")
ORACLES["savings"] = f"""WITH {GAMES} SELECT id, CASE WHEN disc_cents <> 0 THEN (orig_cents - disc_cents) / 100 ELSE 0 END AS savings
FROM games"""
_LABEL = """labels_ AS (SELECT id, CONCAT(CASE WHEN id % 2 = 0 THEN CONCAT('-', CAST(id % 90 AS VARCHAR), '% ') ELSE ' ' END,
 price_raw, ' ', original_raw) AS t FROM listings),
parts AS (SELECT id, contains(lower(t), 'free') AS free, regexp_extract(t, '-(\\d+)%', 1) AS d,
 list_transform(regexp_extract_all(t, '[€$£¥]\\s*[\\d,]+\\.?\\d*'), lambda p: trim(p)) AS a FROM labels_),
firsts AS (SELECT id, free, d, a[1] AS f, a[2] AS s,
 TRY_CAST(replace(a[1][2:], ',', '') AS DOUBLE) AS fv, TRY_CAST(replace(a[2][2:], ',', '') AS DOUBLE) AS sv FROM parts)"""
ORACLES["parse_price_text"] = f"""WITH {LISTINGS}, {_LABEL}
SELECT id, CASE WHEN free THEN 'Free' ELSE COALESCE(f, 'N/A') END AS price,
 CASE WHEN free THEN 'N/A' ELSE COALESCE(s, 'N/A') END AS original_price,
 CASE WHEN free OR d = '' THEN 'N/A' ELSE d || '%' END AS discount_percentage,
 CASE WHEN free THEN 'Free' WHEN sv < fv THEN s ELSE COALESCE(f, 'N/A') END AS low_price,
 CASE WHEN free THEN 'N/A' WHEN sv < fv THEN f ELSE COALESCE(s, 'N/A') END AS high_price FROM firsts"""
_REAL_DATE = """CASE o_orderkey % 7 WHEN 5 THEN make_date(EXTRACT(YEAR FROM o_orderdate), 1, 1) WHEN 6 THEN NULL
 ELSE CAST(o_orderdate AS DATE) END"""
ORACLES["norm_date"] = f"SELECT o_orderkey AS id, {_REAL_DATE} AS release_date, {_REAL_DATE} AS spaced_date FROM orders"
ORACLES["release_status"] = f"""SELECT o_orderkey AS id, CASE WHEN ({_REAL_DATE}) <= {AS_OF} THEN 'Released'
 WHEN ({_REAL_DATE}) > {AS_OF} THEN 'Upcoming' ELSE 'Unknown' END AS release_status FROM orders"""
ORACLES["counts_in_text"] = _on_listings("""CAST(id AS VARCHAR) AS bracketed,
 NULLIF(regexp_extract(CONCAT(title_raw, ': ', rating_raw, '/5'), '[\\d.]+'), '') AS score,
 CAST(id AS VARCHAR) AS reviews, CAST(id AS VARCHAR) AS app""")
_NOISY = """noisy AS (SELECT doc_id, CONCAT(' &nbsp;', replace(text, '. ', '. ' || chr(8203) || '&amp;\\n'), '\\r &quot;') AS t
 FROM documents)"""
ORACLES["clean_text"] = f"WITH {_NOISY} SELECT doc_id, {clean('t')} AS clean FROM noisy"
ORACLES["flat_text"] = f"SELECT doc_id, {flat('(chr(13) || chr(10) || text)')} AS flat FROM documents"
ORACLES["title_norm"] = f"SELECT doc_id, {key('text')} AS title_key FROM documents"
_BLANKS = "regexp_replace(regexp_replace(text, '[\\x00-\\x08\\x0B-\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '[ \\t]+', ' ', 'g')"
_NORMAL_FIRST = "'\" q \" ™ ® © x — ' || chr(771) || ' —TM fi 1⁄2'"
_REPAIR_FIRST = """'" q " TM ® © x '' '' fi 1⁄2'"""
ORACLES["fix_encoding"] = f"""SELECT doc_id, CONCAT({_NORMAL_FIRST}, {_BLANKS}, {_NORMAL_FIRST}) AS fixed,
 CONCAT({_REPAIR_FIRST}, {_BLANKS}, {_REPAIR_FIRST}) AS repaired_first FROM documents"""
_RISKY = """risky AS (SELECT doc_id, ' <a>:"b/\\|?*' || chr(7) || ' ' || text AS t FROM documents)"""
ORACLES["safe_name"] = f"""WITH {_RISKY} SELECT doc_id, left(regexp_replace(t, '[<>:"/\\\\|?*]', '', 'g'), 50) AS short_name,
 left({strip("regexp_replace(t, '[<>:" + chr(34) + "/\\\\|?*\\x00-\\x1F]', '', 'g')")}, 80) AS long_name FROM risky"""


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'))"


ORACLES["description_clean"] = f"""WITH d AS (SELECT doc_id, {strip('text')} AS body, CONCAT(lang, ' ', source, ': ', text) AS meta,
 CASE doc_id % 3 WHEN 2 THEN '' WHEN 0 THEN {squeeze('text')}
  ELSE {squeeze(f"regexp_replace({strip('text')} || '....', '[.][.][.]+$', '')")} END AS t,
 CASE doc_id % 3 WHEN 0 THEN length({strip("text || '  Originally released in 1999'")}) WHEN 1 THEN length({strip("text || '....'")}) ELSE 0 END AS n
 FROM documents)
SELECT doc_id, CASE WHEN n > 50 AND length(t) > 50 THEN left(t, 1000) WHEN length({strip('meta')}) > 50 THEN left({strip('meta')}, 1000)
 ELSE 'N/A' END AS description FROM d"""
ORACLES["requirements_text"] = f"""SELECT doc_id, left({strip('text')}, 300) AS short,
 array_to_string(list_transform(string_split(text, chr(10)), lambda w: {flat('w')}), ' | ') AS listed FROM documents"""
LINKS = """hrefs AS (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS a FROM pages),
links AS (SELECT page_id, url, CAST(i - 1 AS INT) AS position, a[i] AS href
 FROM (SELECT *, UNNEST(range(1, len(a) + 1)) AS i FROM hrefs))"""
ORACLES["absolute_url"] = f"""WITH {LINKS} SELECT page_id, position,
 CASE WHEN position % 3 = 0 THEN 'https://cdn.example.com' || href WHEN starts_with(href, '//') THEN 'https:' || href
 WHEN starts_with(href, '/') THEN 'https://host.example' || href ELSE href END AS link FROM links"""
ORACLES["image_sizes"] = f"""WITH {LINKS} SELECT page_id, position, href || '.1920x1080.jpg' AS full_size,
 href || '_1024.jpg?x=-1024.png' AS large, 'png' AS image_ext, '.mp4' AS video_ext FROM links"""
ORACLES["slug_title"] = f"""WITH {LINKS}, s AS (SELECT page_id, position,
 trim(replace(regexp_replace(href, '[^A-Za-z0-9]', '_', 'g'), '_', ' ')) AS w, regexp_replace(href, '[^A-Za-z0-9]', '_', 'g') AS raw FROM links)
SELECT page_id, position, {title("(replace(raw, '_', ' ') || ' two parts')")} AS title FROM s"""
ORACLES["status_prefix"] = f"""WITH {LISTINGS}, t AS (SELECT id,
 CASE WHEN id % 4 = 0 THEN 'SOON' WHEN id % 4 = 1 THEN 'PRE-ORDER' ELSE COALESCE(status_raw, '') END AS tag,
 CASE WHEN id % 8 = 0 THEN 'SOON ' || title_raw ELSE title_raw END AS title FROM listings)
SELECT id, tag, CASE WHEN tag <> '' AND NOT starts_with(title, tag) THEN tag || '   ' || title ELSE title END AS title FROM t"""

# --------------------------------------------------------------------------
# Conforming, filters, deduplication, cleaning.
# --------------------------------------------------------------------------
ORACLES["conform_union"] = f"WITH {CONFORMED} SELECT * FROM conformed"
ORACLES["column_mapping"] = f"""WITH {LISTINGS} SELECT {present('url_raw')} AS game_url, {present('rating_raw')} AS rating_raw,
 {present('price_raw')} AS current_price_raw, genres_raw AS genres, data_source FROM listings WHERE data_source = 'instant_gaming'"""
ORACLES["csv_mixed_headers"] = f"WITH {LISTINGS} SELECT CAST(id AS VARCHAR) AS id, {present('title_raw')} AS title_raw, genres_raw FROM listings"
ORACLES["csv_line_breaks"] = f"""SELECT CAST(doc_id AS VARCHAR) AS id, {present("replace(text, chr(13), ' ')")} AS text,
 '5" ' || chr(10) || ', "' || source || '",' || chr(10) || chr(10) AS note FROM documents"""
ORACLES["csv_replacing"] = f"""WITH {LISTINGS} SELECT title_raw || ' ' || chr(65533) || ', "' || chr(65533) || '"' || chr(10) || chr(65533) AS title,
 CAST(id AS VARCHAR) AS id FROM listings"""
ORACLES["csv_round_trip"] = f"""WITH {LISTINGS} SELECT title_raw || ' é, "ü"' || chr(10) || 'ß' AS title, CAST(id AS VARCHAR) AS id,
 genres_raw, url_raw AS url FROM listings"""
ORACLES["stored_model"] = ORACLES["bq7_genre_price"]
ORACLES["url_dedup"] = f"""WITH {LISTINGS} SELECT MIN(id) AS id, data_source, url_raw AS game_url FROM listings
GROUP BY data_source, url_raw"""
ORACLES["url_dedup_keep_null"] = f"""WITH {LISTINGS} SELECT MIN(id) AS id, url_raw AS game_url FROM listings
WHERE url_raw IS NOT NULL GROUP BY url_raw UNION ALL SELECT id, NULL FROM listings WHERE url_raw IS NULL"""
_SEEN = "seen AS (SELECT href, page_id, position FROM links QUALIFY ROW_NUMBER() OVER (PARTITION BY href ORDER BY page_id, position) = 1)"
ORACLES["seen_dedup"] = f"WITH {LINKS}, {_SEEN} SELECT * FROM seen"
ORACLES["seen_over_runs"] = ORACLES["seen_dedup"]
ORACLES["capped_records"] = f"WITH {LINKS}, {_SEEN} SELECT page_id, position, href FROM seen ORDER BY page_id, position LIMIT 700"
ORACLES["preview"] = f"WITH {GAMES} SELECT id, game_title, rating FROM games ORDER BY id LIMIT 5"
ORACLES["smart_dedup"] = f"WITH {MASTER} SELECT * FROM master"
_ENTRIES = """words AS (SELECT *, ['Gift Card', 'V-Points', 'expansion pack', 'Deluxe Upgrade', 'Season Pass', 'dlc'][id % 6 + 1] AS w FROM listings),
entries AS (SELECT id, COALESCE(url_raw, 'N/A') AS url, CASE WHEN id % 4 = 0 THEN title_raw || ' ' || w ELSE title_raw END AS title,
 CASE WHEN id % 5 = 0 THEN w END AS badge FROM words)"""
ORACLES["keyword_filter"] = f"""WITH {LISTINGS}, {_ENTRIES} SELECT id, title FROM entries
WHERE NOT regexp_matches(lower(title), 'gift card|points|gems|credits|wallet|season pass')"""
ORACLES["add_on_filter"] = f"""WITH {LISTINGS}, {_ENTRIES} SELECT id, title FROM entries
WHERE NOT (id % 4 = 0 AND id % 6 IN (2, 3, 4, 5)) AND NOT COALESCE(lower(badge) IN ('expansion pack', 'dlc'), FALSE)"""
ORACLES["link_filter"] = f"WITH {LISTINGS} SELECT id, url_raw AS url FROM listings WHERE url_raw IS NOT NULL"
ORACLES["media_filter"] = f"WITH {LISTINGS} SELECT id FROM listings WHERE id % 3 = 0 OR id % 4 = 0"
ORACLES["array_distinct_top"] = """WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[ \\n]+') AS a FROM documents),
e AS (SELECT doc_id, UNNEST(a) AS x, UNNEST(range(len(a))) AS i FROM w),
f AS (SELECT doc_id, x, MIN(i) AS i FROM e GROUP BY doc_id, x),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f)
SELECT doc_id, string_agg(x, ' ' ORDER BY i) FILTER (WHERE k <= 10) AS words, CAST(COUNT(*) AS INT) AS n FROM r GROUP BY doc_id"""
ORACLES["impute"] = f"WITH {CONFORMED}, {fill('conformed', 'filled', False)} SELECT * FROM filled"
_ALL_FILLED = ", ".join(f"COALESCE({c}, 'Unknown') AS {c}" for c in (*_TEXTS, "review_count"))
ORACLES["unknown_filter"] = f"""WITH {CONFORMED}, f AS (SELECT ingest_ord, {_ALL_FILLED} FROM conformed)
SELECT ingest_ord, game_title, developer, publisher FROM f
WHERE {unknowns((*_TEXTS, 'review_count'))} <= 2 AND NOT (developer = 'Unknown' AND publisher = 'Unknown')"""
ORACLES["discount_recompute"] = f"""WITH {LISTINGS}, t AS (
 SELECT id, {price('original_raw')} AS o, {price('price_raw')} AS d, {discount('discount_raw')} AS c FROM listings)
SELECT id, {_DERIVED_DISCOUNT.format(o='o', d='d', c='c')} AS discount FROM t"""
ORACLES["clean_catalog"] = f"WITH {FINAL} SELECT * FROM final"


# --------------------------------------------------------------------------
# Quality reports.
# --------------------------------------------------------------------------

def pct(part: str, whole: str) -> str:
    return ratio(f"100 * ({part})", whole, 1)


_ALL = "COUNT(*)"
ORACLES["quality_sources"] = f"""WITH {MASTER}, s AS (SELECT data_source, COUNT(*) AS n FROM master GROUP BY data_source)
SELECT data_source, n, {pct('n', '(SELECT SUM(n) FROM s)')} AS pct FROM s"""
ORACLES["quality_ratings"] = f"""WITH {MASTER} SELECT COUNT(*) AS total, COUNT(rating) AS rated, COUNT(*) - COUNT(rating) AS unrated,
 {pct('COUNT(rating)', _ALL)} AS rated_pct, {pct('COUNT(*) - COUNT(rating)', _ALL)} AS unrated_pct,
 {ratio('SUM(CAST(ROUND(rating * 10) AS BIGINT))', 'COUNT(rating) * 10', 1)} AS avg_rating,
 MIN(rating) AS min_rating, MAX(rating) AS max_rating FROM master"""
ORACLES["quality_prices"] = f"""WITH {MASTER}, p AS (SELECT discounted_price AS d,
 CASE WHEN discounted_price > 0 THEN CAST(ROUND(discounted_price * 100) AS BIGINT) END AS c FROM master)
SELECT COUNT(*) AS total, COUNT(d) AS priced, {pct('COUNT(d)', _ALL)} AS priced_pct, COUNT(*) FILTER (WHERE d = 0) AS free,
 COUNT(*) FILTER (WHERE d > 0) AS paid, {mean_price('c')} AS avg_paid_price FROM p"""
ORACLES["quality_dates"] = f"""WITH {MASTER} SELECT COUNT(*) AS total, COUNT(release_date) AS dated,
 COUNT(*) - COUNT(release_date) AS undated, {pct('COUNT(release_date)', _ALL)} AS dated_pct,
 {pct('COUNT(*) - COUNT(release_date)', _ALL)} AS undated_pct FROM master"""
_FIELDS = ("game_title", "rating", "release_date", "genres", "platform", "developer", "publisher", "description", "game_url")
ORACLES["field_completeness"] = f"""WITH {MASTER}, t AS ({tall('master', _FIELDS, lambda c: f'{c} IS NOT NULL', 'filled', True)})
SELECT field, filled, total, {pct('filled', 'total')} AS pct, CASE WHEN filled * 100 >= 80 * total THEN '✓'
 WHEN filled * 100 >= 50 * total THEN '⚠' ELSE '✗' END AS status FROM t"""
_UNIFIED = (
    "data_source", "game_title", "release_date", "rating", "review_count", "discounted_price", "original_price",
    "discount_percentage", "genres", "platform", "developer", "publisher", "description", "release_status", "game_url",
)
ORACLES["missing_by_column"] = f"""WITH {MASTER}, m AS (SELECT * REPLACE (NULLIF(regexp_extract(replace(review_count, ',', ''), '(\\d+)', 1), '') AS review_count) FROM master),
t AS ({tall('m', _UNIFIED, lambda c: f'{c} IS NULL', 'missing')}) SELECT * FROM t WHERE missing > 0"""
ORACLES["unknown_by_column"] = f"""WITH {FINAL},
u AS ({tall('final', _TEXTS, lambda c: f"{c} = 'Unknown'", 'n')}),
z AS ({tall('final', (*_NUMBERS, 'review_count'), lambda c: f'{c} = 0', 'n')})
SELECT field, 'unknown' AS kind, n FROM u WHERE n > 0 UNION ALL SELECT field, 'zero', n FROM z WHERE n > 0"""
_STEP = """SELECT {0} AS step_no, '{1}' AS step, b AS rows_before, a AS rows_after, b - a AS dropped, {2} AS retained_pct FROM (
 SELECT COUNT(*) FILTER (WHERE {3}) AS b, COUNT(*) FILTER (WHERE {4}) AS a, COUNT(*) AS t FROM f)"""
ORACLES["step_retention"] = f"""WITH {CONFORMED}, p AS (SELECT release_date, rating,
 {', '.join(f"COALESCE({c}, 'Unknown') AS {c}" for c in _TEXTS)} FROM conformed),
f AS (SELECT rating IS NOT NULL AND release_date IS NOT NULL AS c1, {unknowns()} <= 3 AS c2,
 NOT (developer = 'Unknown' AND publisher = 'Unknown') AS c3 FROM p)
""" + " UNION ALL ".join([
    _STEP.format(1, "has_critical", pct("a", "t"), "TRUE", "c1"),
    _STEP.format(2, "mostly_known", pct("a", "t"), "c1", "c1 AND c2"),
    _STEP.format(3, "known_maker", pct("a", "t"), "c1 AND c2", "c1 AND c2 AND c3"),
])

# --------------------------------------------------------------------------
# Pages and media.
# --------------------------------------------------------------------------
ORACLES["page_fields"] = f"""WITH p AS (SELECT *, array_to_string(list_transform(
 regexp_extract_all(html, '(?s)<p>(.*?)(?:</p>|<br>)', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')), ' ') AS b FROM pages)
SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1,
 regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS host,
 regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, {clean('b')} AS body FROM p"""
ORACLES["page_links"] = f"""WITH {LINKS} SELECT page_id, position, href, CASE WHEN starts_with(href, '//') THEN 'https:' || href
 WHEN starts_with(href, '/') THEN regexp_extract(url, '^https?://[^/?#]+') || href ELSE href END AS link FROM links"""


def _manifest(header: str, screenshots: int, videos: int, image: str, stream: str) -> str:
    return f"""WITH {LINKS},
shots AS (SELECT page_id, position, href || ['.PNG', '.webp', '.jpg'][page_id % 3 + 1] AS u, {image} AS e FROM links),
vids AS (SELECT page_id, position, href || ['.mp4', '.m3u8', '.webm'][position % 3 + 1] AS u, ['.mp4', '{stream}', '.webm'][position % 3 + 1] AS e
 FROM links WHERE position < {videos})
SELECT page_id AS id, 'header' AS media_type, 1 AS idx, '{header}' AS file_name, url || '/cover.jpg' AS media_url FROM pages WHERE page_id % 4 <> 0
UNION ALL SELECT page_id, 'image', position + 1, CONCAT('screenshot_', CAST(position + 1 AS VARCHAR), '.', e), u FROM shots WHERE position < {screenshots}
UNION ALL SELECT page_id, 'video', position + 1, CONCAT('video_', CAST(position + 1 AS VARCHAR), e), u FROM vids"""


ORACLES["media_manifest"] = _manifest("header.jpg", 5, 3, "'jpg'", ".txt")
ORACLES["media_manifest_b"] = _manifest("cover.jpg", 10, 0, "['png', 'webp', 'jpg'][page_id % 3 + 1]", "")
ORACLES["media_manifest_c"] = _manifest("header.jpg", 10, 5, "'jpg'", ".webm")
_DIRECT = ["movie_max_vp9.webm", "movie480_vp9.webm", "movie_max.webm", "movie480.webm", "movie_max.mp4", "movie480.mp4"]
ORACLES["video_candidates"] = f"""SELECT page_id, CONCAT('https://video.cdn/store_trailers/', page_id, '/movie_max_vp9.webm https://video.cdn/',
 page_id, '/dash.mpd https://video.cdn/b/', page_id, '/movie_max_vp9.webm') AS videos,
 array_to_string(list_transform({_DIRECT}, lambda n: CONCAT('https://v/', page_id, '/', n)), ' ') AS direct FROM pages"""

# Listing entries as the rendered pages show them, one per link in arrival order.
_ITEMS = """items AS (SELECT *, id // 25 AS page_id, trim(title_raw) AS shown,
 CASE WHEN id % 10 = 7 THEN id - id % 60 + id % 3 ELSE id END AS app FROM listings)"""
_DETAIL = "d AS (SELECT id AS app, developer_raw, publisher_raw, original_raw FROM listings WHERE data_source = '{}' AND developer_raw IS NOT NULL)"
_FIRST = "QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY page_id, position) = 1"


def _na(x: str) -> str:
    return f"COALESCE({x}, 'N/A')"


_STORE_A = f"""{LISTINGS}, {_ITEMS}, {_DETAIL.format('Steam')}, e AS (
 SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY id) - 1 AS INT) AS position,
  CONCAT('https://store.steampowered.com/app/', app, '/x/') AS url FROM items WHERE data_source = 'Steam'),
k AS (SELECT * FROM e {_FIRST}),
r AS (SELECT k.*, d.developer_raw AS dev, d.publisher_raw AS pub FROM k JOIN d USING (app)),
records_a AS (SELECT url, page_id, position, shown AS title, CONCAT(id % 28 + 1, ' Oct, 2025') AS release_date,
 CASE WHEN id % 5 = 0 THEN original_raw ELSE 'N/A' END AS original_price,
 CASE WHEN id % 5 = 0 THEN CONCAT('$', id, '.99') WHEN contains(price_raw, 'Free') THEN 'Free' ELSE price_raw END AS price,
 CASE WHEN id % 5 = 0 THEN CONCAT('-', id % 90, '%') ELSE 'N/A' END AS discount_percentage, review_text AS review_summary,
 CASE id % 10 WHEN 0 THEN 95 WHEN 1 THEN 85 WHEN 2 THEN 75 WHEN 3 THEN 75 WHEN 4 THEN 50 WHEN 5 THEN 30 WHEN 6 THEN 25
  WHEN 7 THEN 25 WHEN 8 THEN 25 END AS rating_score,
 TRY_CAST(regexp_extract(review_text, '(\\d+)%', 1) AS INT) AS rating_percentage,
 CASE WHEN id % 4 = 0 THEN 'Windows, Linux' WHEN id % 2 = 0 THEN 'Windows' ELSE 'N/A' END AS platforms,
 CONCAT('Action, Type & ', app) AS genres, dev AS developer, pub AS publisher,
 CASE WHEN app % 2 = 0 THEN 'Single-player, Online Multi-player, Cloud' ELSE 'Single-player, Cloud' END AS categories,
 CASE WHEN app % 2 = 0 THEN 'Yes' ELSE 'No' END AS multiplayer, 'Yes' AS singleplayer,
 CONCAT('OS: ', app, ' RAM') AS system_requirements_windows, CONCAT('https://cdn.steam/', app, '/header.jpg') AS header_image,
 CASE WHEN app % 5 = 0 THEN '' ELSE CONCAT('https://steam.cdn/', app, '/ss1.1920x1080.jpg ; https://steam.cdn/', app, '/ss2.jpg') END AS screenshots,
 CASE WHEN app % 4 = 1 THEN CONCAT('https://video.cdn/store_trailers/', app, '/movie_max_vp9.webm ; https://video.cdn/', app, '/dash.mpd')
  ELSE CONCAT('https://cdn.akamai.steamstatic.com/steam/apps/', app, '/movie480.webm') END AS videos FROM r)"""
ORACLES["store_page_records_a"] = f"WITH {_STORE_A} SELECT * FROM records_a"
ORACLES["store_page_records_b"] = f"""WITH {LISTINGS}, {_ITEMS}, {_DETAIL.format('instant_gaming')}, e AS (
 SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY id) - 1 AS INT) AS position,
  CONCAT('https://www.instant-gaming.com/en/', app, '-item/') AS url FROM items WHERE data_source = 'instant_gaming'),
k AS (SELECT * FROM e WHERE id % 31 <> 0 AND id % 37 <> 0 {_FIRST}),
r AS (SELECT k.*, d.app AS found, d.developer_raw AS dev, d.publisher_raw AS pub, d.original_raw AS o FROM k LEFT JOIN d USING (app))
SELECT url, page_id, position, shown AS title, {_na('dev')} AS developer, {_na('pub')} AS publisher,
 CASE WHEN found IS NULL THEN 'N/A' ELSE 'PC' END AS platforms, CASE WHEN found IS NULL THEN 'N/A' ELSE 'Action' END AS genre,
 CASE WHEN found IS NULL THEN 'N/A' ELSE '30 October 2025' END AS release_date,
 CASE WHEN found IS NULL THEN 'N/A' WHEN app % 2 = 0 THEN CONCAT('Line one of ', app) ELSE CONCAT('Fallback text ', app) END AS description,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT(app, '.99€') END AS current_price, {_na('o')} AS original_price,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT('-', app % 90, '%') END AS discount_percentage,
 CASE WHEN found IS NULL THEN 'N/A' ELSE '€' END AS currency, CASE WHEN found IS NULL THEN 'N/A' ELSE 'In stock' END AS stock_status,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT(app % 10, '.5') END AS ig_rating,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT(app, ' reviews') END AS review_count,
 CASE WHEN found IS NULL THEN 'N/A' ELSE 'Mixed (12)' END AS steam_recent_reviews,
 CASE WHEN found IS NULL THEN 'N/A' ELSE 'Very Positive' END AS steam_all_reviews,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CAST(app AS VARCHAR) END AS steam_review_count, 'N/A' AS video_url,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT('https://img/', app, '.jpg') END AS header_image,
 CASE WHEN found IS NULL THEN '' ELSE CONCAT('https://img/', app, '/1.png ; https://img/', app, '/2.webp') END AS screenshots,
 CASE WHEN found IS NULL THEN '' ELSE CONCAT('RPG ; Tag ', app) END AS user_tags, CASE WHEN found IS NULL THEN '' ELSE 'Co-op' END AS game_features,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT('OS: 10 | RAM: ', app) END AS system_requirements_min, 'N/A' AS system_requirements_rec,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CAST(app AS VARCHAR) END AS product_id,
 CASE WHEN found IS NULL THEN '' ELSE CONCAT('Standard: ', app, '€') END AS editions FROM r"""
_STORE_C = f"""{LISTINGS}, {_ITEMS}, {_DETAIL.format('GOG')}, e AS (
 SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY id) - 1 AS INT) AS position,
  CONCAT('https://www.gog.com/en/game/item_', app) AS url, CASE WHEN id % 12 = 2 AND id % 23 <> 0 THEN 'SOON' ELSE '' END AS tag,
  CASE WHEN id % 29 = 0 THEN shown || ' Season Pass' WHEN id % 10 = 1 THEN CONCAT('Item ', app) ELSE shown END AS name
 FROM items WHERE data_source = 'GOG'),
o AS (SELECT * FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY page_id, url ORDER BY position) = 1),
k AS (SELECT * FROM o WHERE id % 29 <> 0 AND id % 23 <> 0 {_FIRST}),
r AS (SELECT k.*, d.app AS found, d.developer_raw AS dev, d.publisher_raw AS pub FROM k LEFT JOIN d USING (app)),
records_c AS (SELECT url, page_id, position, CASE WHEN tag = '' THEN name ELSE 'SOON   ' || name END AS title,
 CASE WHEN id % 7 = 0 THEN 'Free' WHEN id % 2 = 0 THEN CONCAT('$', id, '.99') ELSE CONCAT('$ ', id, '.49') END AS price,
 CASE WHEN id % 7 = 0 THEN 'N/A' WHEN id % 2 = 0 THEN '$9.99' ELSE 'N/A' END AS original_price,
 CASE WHEN id % 7 = 0 THEN 'N/A' WHEN id % 2 = 0 THEN '50%' ELSE 'N/A' END AS discount_percentage, tag AS status_tag,
 CASE WHEN found IS NULL THEN 'N/A' WHEN app % 2 = 0 THEN CONCAT(app % 5, '.6') ELSE CONCAT(app % 5, '.1') END AS rating,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CAST(app AS VARCHAR) END AS rating_count,
 CASE WHEN found IS NULL THEN 'N/A' ELSE 'October 30, 2025' END AS release_date,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT('Action, Item ', app) END AS genres,
 CASE WHEN found IS NULL THEN 'N/A' WHEN app % 2 = 0 THEN 'Windows, Linux' ELSE 'Windows, Mac' END AS platforms,
 {_na('dev')} AS developer, {_na('pub')} AS publisher,
 CASE WHEN found IS NULL THEN 'N/A' WHEN app % 3 = 1 THEN CONCAT('A long enough description of item number ', app, ' from the page head.')
  ELSE CONCAT('The long summary of the item with the number ', app, ' which goes on.') END AS description,
 CASE WHEN found IS NULL THEN '' ELSE CONCAT('https://img.cdn/', app, '/screenshots/a_1024.jpg ; https://www.gog.com/img/', app, '/screenshots/b-1024.png') END AS screenshots,
 CASE WHEN found IS NULL THEN '' ELSE CONCAT('https://v.cdn/', app, '.mp4') END AS videos,
 CASE WHEN found IS NULL THEN 'N/A' ELSE CONCAT('https://img.cdn/', app, '.jpg') END AS header_image FROM r)"""
ORACLES["store_page_records_c"] = f"WITH {_STORE_C} SELECT * FROM records_c"
ORACLES["crawl_statistics"] = f"""WITH {_STORE_A} SELECT COUNT(*) AS total, COUNT(*) AS single_player,
 COUNT(*) FILTER (WHERE multiplayer = 'Yes') AS multi_player, COUNT(*) FILTER (WHERE price = 'Free') AS free,
 COUNT(*) FILTER (WHERE discount_percentage <> 'N/A') AS on_sale, COUNT(*) FILTER (WHERE screenshots <> '') AS with_screenshots,
 COUNT(*) FILTER (WHERE videos <> '') AS with_videos, COUNT(rating_score) AS rated, {mean('rating_score', 1)} AS avg_score,
 MAX(rating_score) AS max_score, MIN(rating_score) AS min_score FROM records_a"""
_LONG = {"description": 100, "screenshots": 10, "videos": 10}
ORACLES["crawl_completeness"] = f"""WITH {_STORE_C}, t AS ({tall(
    'records_c', ('rating', 'rating_count', 'genres', 'platforms', 'developer', 'publisher', *_LONG),
    lambda c: f"{c} <> 'N/A' AND length({c}) > {_LONG.get(c, 0)}", 'filled', True)})
SELECT field, filled, total, {pct('filled', 'total')} AS pct FROM t"""


def _cells(question: str, texts: list[str], numbers: list[str]) -> str:
    place = "1" if question == "bq5_platform_pricing" else "position"
    cells = [f"{{'field': '{c}', 'text': CAST({c} AS VARCHAR), 'number': CAST(NULL AS DOUBLE)}}" for c in texts]
    cells += [f"{{'field': '{c}', 'text': CAST(NULL AS VARCHAR), 'number': CAST({c} AS DOUBLE)}}" for c in numbers]
    return f"""SELECT '{question}' AS question, CAST({place} AS INT) AS position, c.field AS field, c.text AS text, c.number AS number
FROM (SELECT *, UNNEST([{', '.join(cells)}]) AS c FROM ({ORACLES[question]}))"""


ORACLES["all_questions"] = " UNION ALL ".join(_cells(q, *columns) for q, columns in _ANSWERS.items())


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
