"""DuckDB oracle SQL, one statement per query key.

Written independently of the Spark code: the adapters' projections are
repeated as CTEs over the pre-registered driver views, and each operator's
semantics is spelled out in plain SQL (window ``row_number`` for dedup and
ranking, joins for merges, ``count``/``filter`` for rules).
"""

from __future__ import annotations

RUN_TS = "2024-02-01 00:00:00"
PREV_TS = "2024-01-01 00:00:00"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
NORM = r"regexp_replace(trim(lower({0})), '[^a-z0-9\s]', '', 'g')"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{NULL_TOKEN}')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def norm(e: str) -> str:
    return NORM.format(e)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ raw inputs


def raw_diary(src: str = "events", name: str = "raw_diary", rating_override: str | None = None) -> str:
    rating = ("CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 19 = 0 THEN '3.' "
              "WHEN event_id % 61 = 0 THEN '9' WHEN event_id % 53 = 0 THEN '-1' "
              "ELSE CAST((CAST(floor(value) AS BIGINT) % 10 + 1) / 2.0::DOUBLE AS VARCHAR) END")
    if rating_override:
        rating = f"CASE WHEN {rating_override[0]} THEN '{rating_override[1]}' ELSE {rating} END"
    return f"""{name} AS (
  SELECT event_id,
    CASE WHEN event_id % 37 = 0 THEN strftime(ts, '%Y/%m/%d')
         WHEN event_id % 43 = 0 THEN '2023-02-29'
         ELSE strftime(ts, '%Y-%m-%d') END AS "Date",
    CASE WHEN event_id % 29 = 0 THEN '   ' WHEN event_id % 31 = 0 THEN NULL
         ELSE 'Film ' || CAST(user_id AS VARCHAR) END AS "Name",
    CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(1950 + user_id % 50 AS VARCHAR) END AS "Year",
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'https://boxd.it/' || CAST(user_id AS VARCHAR) END
      AS "Letterboxd URI",
    {rating} AS "Rating",
    CASE WHEN event_type = 'error' THEN NULL
         ELSE (['Yes','yes','TRUE','1','No','YES'])[CAST(event_id % 6 AS INTEGER) + 1] END AS "Rewatch",
    CASE WHEN event_id % 47 = 0 THEN '' WHEN event_id % 59 = 0 THEN NULL
         ELSE event_type || ', k' || json_extract_string(props, '$.k') END AS "Tags",
    CASE WHEN event_id % 41 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS "Watched Date"
  FROM {src})"""


def parsed_date(e: str) -> str:
    return f"CAST(try_strptime({e}, '%Y-%m-%d') AS DATE)"


def safe_year(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, '^\\d{{4}}$') THEN TRY_CAST({e} AS INTEGER) END"


def safe_rating(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, '^\\d+\\.?\\d*$') THEN TRY_CAST({e} AS FLOAT) END"


def silver_diary(raw: str = "raw_diary", name: str = "silver_diary", ts: str = RUN_TS) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY letterboxd_uri, watched_date ORDER BY event_id DESC) AS rn
    FROM (
      SELECT event_id, "Name" AS movie_title, "Letterboxd URI" AS letterboxd_uri,
        {parsed_date('"Date"')} AS diary_date,
        {parsed_date('"Watched Date"')} AS watched_date,
        {safe_year('"Year"')} AS movie_year,
        {safe_rating('"Rating"')} AS my_rating,
        "Rewatch" IN ('Yes', 'yes', 'TRUE', '1') AS is_rewatch,
        {norm('"Name"')} AS movie_title_normalized,
        string_split("Tags", ',') AS tags,
        TIMESTAMP '{ts}' AS _silver_updated_at
      FROM {raw}) x
    WHERE letterboxd_uri IS NOT NULL AND movie_title IS NOT NULL AND trim(movie_title) <> '') y
  WHERE rn = 1)"""


def raw_ratings(src: str = "lineitem", name: str = "raw_ratings", rating_override=None) -> str:
    rating = "CAST(ceil(l_quantity / 5) / 2.0::DOUBLE AS VARCHAR)"
    if rating_override:
        rating = f"CASE WHEN {rating_override[0]} THEN '{rating_override[1]}' ELSE {rating} END"
    return f"""{name} AS (
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS "Date",
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'Film ' || CAST(l_partkey AS VARCHAR) END AS "Name",
    CAST(1950 + l_partkey % 50 AS VARCHAR) AS "Year",
    'https://boxd.it/' || CAST(l_partkey AS VARCHAR) AS "Letterboxd URI",
    {rating} AS "Rating"
  FROM {src})"""


def silver_ratings(raw: str = "raw_ratings", name: str = "silver_ratings", ts: str = RUN_TS) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY letterboxd_uri, rating_date
                                 ORDER BY l_orderkey DESC, l_linenumber DESC, my_rating DESC NULLS LAST) AS rn
    FROM (
      SELECT l_orderkey, l_linenumber, "Name" AS movie_title, "Letterboxd URI" AS letterboxd_uri,
        {parsed_date('"Date"')} AS rating_date,
        {safe_year('"Year"')} AS movie_year,
        {safe_rating('"Rating"')} AS my_rating,
        TIMESTAMP '{ts}' AS _silver_updated_at
      FROM {raw}) x
    WHERE letterboxd_uri IS NOT NULL) y
  WHERE rn = 1)"""


SILVER_WATCHED = """silver_watched AS (
  SELECT 'https://boxd.it/' || CAST(p_partkey AS VARCHAR) AS letterboxd_uri, p_name AS movie_title,
         CAST(1950 + p_size AS INTEGER) AS movie_year, DATE '2024-01-15' AS watched_date
  FROM part)"""


def silver_movies(name: str = "silver_movies", where: str = "TRUE", status: str | None = None,
                  bump: str = "0", stamp: str | None = None) -> str:
    status = status or ("CASE p_partkey % 10 WHEN 0 THEN 'NOT_FOUND' WHEN 1 THEN 'FUZZY_MATCH' "
                        "WHEN 2 THEN 'ERROR' ELSE 'SUCCESS' END")
    created = (f"TIMESTAMP '{stamp}'" if stamp
               else f"TIMESTAMP '{PREV_TS}' + to_days(CAST(p_size AS INTEGER))")
    return f"""{name} AS (
  SELECT letterboxd_uri, lb_movie_title, lb_movie_year, enrichment_status,
    CASE WHEN found THEN CAST(p_partkey + 100000 AS INTEGER) END AS tmdb_id,
    CASE WHEN found AND p_partkey % 3 <> 0 THEN upper(p_name) END AS tmdb_title,
    CASE WHEN found THEN p_name END AS tmdb_original_title,
    CASE WHEN found THEN (CASE WHEN p_partkey % 47 = 0 THEN '2001-13-45'
      ELSE CAST(1950 + p_size AS VARCHAR) || '-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0')
           || '-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') END) END AS release_date,
    CASE WHEN found THEN string_split(CASE WHEN p_partkey % 17 = 0 THEN p_name || ' ' || p_name
                                          ELSE p_name END, ' ') END AS genres,
    CASE WHEN found THEN CAST(CASE WHEN p_partkey % 83 = 0 THEN -1 ELSE 60 + p_size * 2 END AS INTEGER) END
      AS runtime_minutes,
    CASE WHEN found AND p_partkey % 4 <> 0 THEN CAST(p_partkey * 1000 AS BIGINT) END AS budget_usd,
    CASE WHEN found THEN CAST(p_partkey * 2500 AS BIGINT) END AS revenue_usd,
    CASE WHEN found THEN p_size / 5.0::DOUBLE END AS vote_average,
    CASE WHEN found THEN CAST(p_size * 10 + {bump} AS INTEGER) END AS vote_count,
    CASE WHEN found THEN p_type END AS overview,
    CASE WHEN found THEN 'en' END AS original_language,
    CASE WHEN found THEN '/p/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS poster_path,
    CASE WHEN found THEN p_brand END AS director_name,
    CASE WHEN found THEN TRY_CAST(substr(p_brand, 7, 10) AS INTEGER) END AS director_tmdb_id,
    {created} AS _silver_created_at,
    {created} AS _silver_updated_at
  FROM (SELECT *, 'https://boxd.it/' || CAST(p_partkey AS VARCHAR) AS letterboxd_uri,
               p_name AS lb_movie_title, CAST(1950 + p_size AS INTEGER) AS lb_movie_year,
               {status} AS enrichment_status
        FROM part WHERE {where}) p
  CROSS JOIN LATERAL (SELECT enrichment_status IN ('SUCCESS', 'FUZZY_MATCH') AS found) f)"""


STG_MOVIES = """stg_movies AS (
  SELECT letterboxd_uri, lb_movie_title, lb_movie_year, enrichment_status,
    CAST(tmdb_id AS BIGINT) AS tmdb_id, coalesce(tmdb_title, lb_movie_title) AS title,
    tmdb_original_title, TRY_CAST(release_date AS DATE) AS release_date,
    CAST(year(TRY_CAST(release_date AS DATE)) AS BIGINT) AS release_year, genres,
    CAST(runtime_minutes AS BIGINT) AS runtime_minutes, CAST(budget_usd AS BIGINT) AS budget_usd,
    CAST(revenue_usd AS BIGINT) AS revenue_usd, CAST(vote_average AS DOUBLE) AS vote_average,
    CAST(vote_count AS BIGINT) AS vote_count, overview, original_language, poster_path,
    director_name, CAST(director_tmdb_id AS BIGINT) AS director_tmdb_id, _silver_updated_at
  FROM silver_movies)"""

STG_DIARY = """stg_diary AS (
  SELECT letterboxd_uri, movie_title, watched_date, diary_date, CAST(my_rating AS DOUBLE) AS my_rating,
         is_rewatch, tags
  FROM silver_diary WHERE letterboxd_uri IS NOT NULL AND watched_date IS NOT NULL)"""

STG_RATINGS = """stg_ratings AS (
  SELECT letterboxd_uri, movie_title, rating_date, CAST(my_rating AS DOUBLE) AS my_rating
  FROM silver_ratings
  WHERE letterboxd_uri IS NOT NULL AND rating_date IS NOT NULL AND my_rating IS NOT NULL)"""

SNAPSHOT = f"""snapshot AS (
  SELECT *, md5(letterboxd_uri || '|' || '{PREV_TS}') AS scd_id,
         TIMESTAMP '{PREV_TS}' AS valid_from
  FROM stg_movies WHERE enrichment_status IN ('SUCCESS', 'FUZZY_MATCH'))"""

DIM_DIRECTOR = f"""dim_director AS (
  SELECT {sk('director_tmdb_id')} AS director_id, director_tmdb_id, min(director_name) AS director_name
  FROM stg_movies WHERE director_name IS NOT NULL AND director_tmdb_id IS NOT NULL
  GROUP BY director_tmdb_id)"""

DIM_GENRE = f"""dim_genre AS (
  SELECT {sk('genre_name')} AS genre_id, genre_name FROM (
    SELECT DISTINCT unnest(genres) AS genre_name FROM stg_movies WHERE genres IS NOT NULL) g
  WHERE genre_name IS NOT NULL)"""

DIM_MOVIE = f"""dim_movie AS (
  SELECT {sk('s.letterboxd_uri')} AS movie_id, s.scd_id AS movie_version_id, s.letterboxd_uri,
    s.tmdb_id, s.title, s.tmdb_original_title, s.release_date, s.release_year, s.genres,
    s.runtime_minutes, s.budget_usd, s.revenue_usd, s.vote_average, s.vote_count, s.overview,
    s.original_language, s.poster_path, d.director_id, s.director_name,
    s.valid_from AS version_valid_from, TRUE AS is_current_version
  FROM snapshot s LEFT JOIN dim_director d ON s.director_tmdb_id = d.director_tmdb_id)"""

BRIDGE = f"""bridge AS (
  SELECT {sk('mg.movie_id', 'mg.genre_name')} AS bridge_id, mg.movie_id, g.genre_id, mg.genre_name
  FROM (SELECT movie_id, unnest(list_distinct(genres)) AS genre_name
        FROM dim_movie WHERE genres IS NOT NULL) mg
  JOIN dim_genre g ON g.genre_name = mg.genre_name)"""

CALENDAR = f"""  SELECT {sk('d')} AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter_number,
    CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
    CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_number,
    strftime(d, '%A') AS day_of_week_name, dayofweek(d) IN (0, 6) AS is_weekend,
    CAST(strftime(d, '%U') AS INTEGER) AS week_of_year"""

DIM_DATE = f"""dim_date AS (
{CALENDAR}
  FROM (SELECT CAST(range AS DATE) AS d
        FROM range(TIMESTAMP '2000-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) s)"""

FACT_DIARY = f"""fact_diary AS (
  SELECT {sk('d.letterboxd_uri', 'd.watched_date')} AS diary_entry_id, m.movie_id,
    dt.date_id AS watched_date_id, d.letterboxd_uri, d.watched_date, d.diary_date, d.my_rating,
    d.is_rewatch, d.tags
  FROM stg_diary d LEFT JOIN dim_movie m ON d.letterboxd_uri = m.letterboxd_uri
  LEFT JOIN dim_date dt ON d.watched_date = dt.full_date)"""

FACT_RATINGS = f"""fact_ratings AS (
  SELECT {sk('r.letterboxd_uri', 'r.rating_date')} AS rating_id, m.movie_id,
    dt.date_id AS rating_date_id, r.letterboxd_uri, r.rating_date, r.my_rating
  FROM stg_ratings r LEFT JOIN dim_movie m ON r.letterboxd_uri = m.letterboxd_uri
  LEFT JOIN dim_date dt ON r.rating_date = dt.full_date)"""

GOLD = [raw_diary(), silver_diary(), raw_ratings(), silver_ratings(), silver_movies(),
        STG_MOVIES, STG_DIARY, STG_RATINGS, SNAPSHOT, DIM_DIRECTOR, DIM_GENRE, DIM_MOVIE,
        BRIDGE, DIM_DATE, FACT_DIARY, FACT_RATINGS]

CATALOG_UNION = """cat_union AS (
  SELECT letterboxd_uri, movie_title, movie_year, 0 AS prio, watched_date AS sort_date FROM silver_diary
  UNION ALL SELECT letterboxd_uri, movie_title, movie_year, -1, rating_date FROM silver_ratings
  UNION ALL SELECT letterboxd_uri, movie_title, movie_year, -2, watched_date FROM silver_watched),
catalog AS (
  SELECT letterboxd_uri, movie_title, movie_year FROM (
    SELECT *, row_number() OVER (PARTITION BY letterboxd_uri ORDER BY prio DESC,
              sort_date DESC NULLS LAST, movie_title DESC NULLS LAST, movie_year DESC NULLS LAST) AS rn
    FROM cat_union) u
  WHERE rn = 1 AND movie_title IS NOT NULL)"""

# Planted titles whose normalised form is empty; the key of a title.
PLANTED = "CASE WHEN p_partkey % 46 = 0 THEN '羅生門' WHEN p_partkey % 23 = 0 THEN '七人の侍' ELSE {0} END"


def title_key(e: str) -> str:
    return f"CASE WHEN trim({norm(e)}) <> '' THEN 'n:' || {norm(e)} WHEN trim({e}) <> '' THEN 'r:' || lower(trim({e})) END"


MATCH = f"""films AS (
  SELECT 'https://boxd.it/' || CAST(p_partkey AS VARCHAR) AS letterboxd_uri,
         CAST(CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 1950 + p_size END AS INTEGER) AS movie_year,
         {title_key('(' + PLANTED.format('p_name') + ')')} AS title_norm
  FROM part),
cat AS (
  SELECT p_partkey AS tmdb_id,
    {title_key('(' + PLANTED.format("CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || '!' ELSE p_name END") + ')')}
      AS title_norm,
    CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE 1950 + p_size + (p_partkey % 7) - 3 END AS cat_year,
    p_retailprice AS popularity
  FROM part),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY title_norm ORDER BY popularity DESC, tmdb_id) AS rnk FROM cat),
exact AS (
  SELECT title_norm, cat_year, tmdb_id AS exact_id FROM (
    SELECT *, row_number() OVER (PARTITION BY title_norm, cat_year ORDER BY popularity DESC, tmdb_id) AS r
    FROM cat WHERE cat_year IS NOT NULL) c WHERE r = 1),
t1 AS (
  SELECT f.*, e.exact_id FROM films f
  LEFT JOIN exact e ON f.title_norm = e.title_norm AND f.movie_year = e.cat_year),
near AS (
  SELECT t1.letterboxd_uri, arg_min(r.tmdb_id, r.rnk) AS near_id, bool_or(t1.movie_year IS NULL) AS no_year
  FROM t1 JOIN ranked r ON t1.title_norm = r.title_norm AND r.rnk <= 3
  WHERE t1.exact_id IS NULL
    AND ((t1.movie_year IS NULL AND r.rnk = 1)
         OR (t1.movie_year IS NOT NULL AND r.cat_year IS NOT NULL AND abs(r.cat_year - t1.movie_year) <= 2))
  GROUP BY t1.letterboxd_uri),
matched AS (
  SELECT t1.letterboxd_uri, t1.movie_year, CAST(coalesce(exact_id, near_id) AS BIGINT) AS tmdb_id,
    CASE WHEN exact_id IS NOT NULL THEN 'EXACT_YEAR' WHEN near_id IS NOT NULL AND no_year THEN 'TITLE_ONLY'
         WHEN near_id IS NOT NULL THEN 'NEAR_YEAR' END AS match_tier
  FROM t1 LEFT JOIN near USING (letterboxd_uri))"""


def title_words(e: str) -> str:
    folded = f"lower(regexp_replace(strip_accents({e}), '[''’]', '', 'g'))"
    return f"list_sort(list_distinct(string_split(trim(regexp_replace({folded}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')))"


SEARCH = with_(f"""films AS (
  SELECT *, {title_words('title')} AS words FROM (
    SELECT 'https://boxd.it/' || CAST(p_partkey AS VARCHAR) AS letterboxd_uri,
      CASE WHEN p_partkey % 9 <> 0 THEN CAST(1950 + p_size AS INTEGER) END AS movie_year,
      CASE WHEN p_partkey % 97 = 0 THEN '...' WHEN p_partkey % 11 = 0 THEN 'Unheard of ' || p_partkey
           WHEN p_partkey % 7 = 0 THEN p_name ELSE p_name || ' ' || p_brand END AS title
    FROM part) x)""", f"""entries AS (
  SELECT *, {title_words('title')} AS words FROM (
    SELECT p_partkey AS tmdb_id, floor(p_retailprice) AS popularity,
      CASE WHEN p_partkey % 19 <> 0 THEN 1950 + p_size + (p_partkey % 7) - 3 END AS cat_year,
      CASE p_partkey % 5 WHEN 0 THEN translate(p_name || ' ' || p_brand, 'aeiou', 'áèîöú')
        WHEN 1 THEN replace(p_name || ' ' || p_brand, ' ', '-') WHEN 2 THEN p_brand || ': the ' || p_name
        WHEN 3 THEN upper(p_name || ' ' || p_brand) || '!' ELSE replace(p_name || ' ' || p_brand, 'r', 'r''') END AS title
    FROM part WHERE p_partkey % 101 <> 0) x)""", """titles AS (SELECT DISTINCT words FROM entries WHERE words[1] <> '')""",
               """weights AS (
  SELECT word, CAST(floor(1000 * ln(1.0 + (SELECT count(*) FROM titles) / count(*)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT unnest(words) AS word FROM titles) t GROUP BY word)""", """film_words AS (
  SELECT words, word, coalesce(weight, (SELECT CAST(floor(1000 * ln(1.0 + count(*))) AS BIGINT) FROM titles)) AS weight
  FROM (SELECT words, unnest(words) AS word FROM (SELECT DISTINCT words FROM films WHERE words[1] <> '')) t
  LEFT JOIN weights USING (word))""", """cat_words AS (
  SELECT words, word, weight FROM (SELECT words, unnest(words) AS word FROM titles) t JOIN weights USING (word))""",
               """pairs AS (
  SELECT film, words, shared * 1000000 // (x.total + y.total - shared) AS score
  FROM (SELECT f.words AS film, c.words AS words, CAST(sum(f.weight) AS BIGINT) AS shared
        FROM film_words f JOIN cat_words c USING (word) GROUP BY ALL) p
  JOIN (SELECT words AS film, CAST(sum(weight) AS BIGINT) AS total FROM film_words GROUP BY 1) x USING (film)
  JOIN (SELECT words, CAST(sum(weight) AS BIGINT) AS total FROM cat_words GROUP BY 1) y USING (words)
  WHERE shared * 1000000 // (x.total + y.total - shared) >= 500000)""", """hits AS (
  SELECT f.letterboxd_uri, f.movie_year, e.tmdb_id, e.cat_year, CAST(p.score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY f.letterboxd_uri ORDER BY score DESC, popularity DESC, e.tmdb_id) AS rank
  FROM films f JOIN pairs p ON p.film = f.words JOIN entries e ON e.words = p.words)""")


def _film_json_fields() -> dict[str, str]:
    director = ("CASE WHEN p_partkey % 5 <> 0 THEN {a} WHEN p_partkey % 7 <> 0 THEN {b} END")
    brand_no = "TRY_CAST(substr(p_brand, 7, 10) AS INTEGER)"
    return {
        "director_name": director.format(a="p_brand", b="'Co-' || p_brand"),
        "director_id": director.format(a=brand_no, b=f"{brand_no} + 1000"),
    }


def _merge_movies_sql() -> str:
    src_status = ("CASE WHEN p_partkey % 6 = 0 THEN 'FUZZY_MATCH' WHEN p_partkey % 8 = 0 THEN 'NOT_FOUND' "
                  "ELSE 'SUCCESS' END")
    tgt = silver_movies("tgt", "p_partkey % 5 <> 0")
    src = silver_movies("src", "p_partkey % 2 = 0 OR p_partkey % 5 = 0", src_status,
                        "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END", RUN_TS)
    cond = ("s.enrichment_status = 'SUCCESS' AND (t.enrichment_status <> 'SUCCESS' "
            "OR s.vote_count > t.vote_count OR t.tmdb_id IS NULL)")
    return with_(tgt, src) + f"""
SELECT t.letterboxd_uri,
  CASE WHEN coalesce({cond}, FALSE) THEN s.enrichment_status ELSE t.enrichment_status END AS enrichment_status,
  CASE WHEN coalesce({cond}, FALSE) THEN s.tmdb_id ELSE t.tmdb_id END AS tmdb_id,
  CASE WHEN coalesce({cond}, FALSE) THEN s.vote_count ELSE t.vote_count END AS vote_count,
  CASE WHEN coalesce({cond}, FALSE) THEN s._silver_updated_at ELSE t._silver_updated_at END AS _silver_updated_at,
  CASE WHEN coalesce({cond}, FALSE) THEN 'update' ELSE 'keep' END AS action
FROM tgt t LEFT JOIN src s ON t.letterboxd_uri = s.letterboxd_uri
UNION ALL
SELECT s.letterboxd_uri, s.enrichment_status, s.tmdb_id, s.vote_count, s._silver_updated_at, 'insert'
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.letterboxd_uri = s.letterboxd_uri)"""


def _merge_diary_sql() -> str:
    ctes = [raw_diary("(SELECT * FROM events WHERE event_id % 2 = 0)", "raw_t"),
            silver_diary("raw_t", "tgt", PREV_TS),
            raw_diary("events", "raw_s", ("event_id % 3 = 0", "4.0")),
            silver_diary("raw_s", "src", RUN_TS)]
    cond = "s.my_rating IS NOT NULL AND s.my_rating <> t.my_rating"
    return with_(*ctes) + f"""
SELECT t.letterboxd_uri, t.watched_date,
  CAST(CASE WHEN coalesce({cond}, FALSE) THEN s.my_rating ELSE t.my_rating END AS DOUBLE) AS my_rating,
  CASE WHEN coalesce({cond}, FALSE) THEN 'update' ELSE 'keep' END AS action
FROM tgt t LEFT JOIN src s ON t.letterboxd_uri = s.letterboxd_uri AND t.watched_date = s.watched_date
UNION ALL
SELECT s.letterboxd_uri, s.watched_date, CAST(s.my_rating AS DOUBLE), 'insert'
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t
                             WHERE t.letterboxd_uri = s.letterboxd_uri AND t.watched_date = s.watched_date)"""


def _merge_ratings_sql() -> str:
    ctes = [raw_ratings("(SELECT * FROM lineitem WHERE l_orderkey % 2 = 0)", "raw_t"),
            silver_ratings("raw_t", "tgt", PREV_TS),
            raw_ratings("lineitem", "raw_s", ("l_orderkey % 3 = 0", "2.5")),
            silver_ratings("raw_s", "src", RUN_TS)]
    cond = "s.my_rating <> t.my_rating"
    return with_(*ctes) + f"""
SELECT t.letterboxd_uri, t.rating_date,
  CAST(CASE WHEN coalesce({cond}, FALSE) THEN s.my_rating ELSE t.my_rating END AS DOUBLE) AS my_rating,
  CASE WHEN coalesce({cond}, FALSE) THEN 'update' ELSE 'keep' END AS action
FROM tgt t LEFT JOIN src s ON t.letterboxd_uri = s.letterboxd_uri AND t.rating_date = s.rating_date
UNION ALL
SELECT s.letterboxd_uri, s.rating_date, CAST(s.my_rating AS DOUBLE), 'insert'
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t
                             WHERE t.letterboxd_uri = s.letterboxd_uri AND t.rating_date = s.rating_date)"""


SCD_BASE = f"""c AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
h1 AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, TIMESTAMP '{PREV_TS}' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to,
         md5(CAST(c_custkey AS VARCHAR) || '|' || '{PREV_TS}') AS scd_id
  FROM c WHERE c_custkey % 11 <> 0),
inc AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 5 = 0 THEN c_name || ' (renamed)' ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM c WHERE c_custkey % 13 <> 0 OR c_custkey % 11 = 0),
h2 AS (
  SELECT h.c_custkey, h.c_name, h.c_acctbal, h.valid_from,
    CASE WHEN n.c_custkey IS NOT NULL AND (h.c_acctbal IS DISTINCT FROM n.c_acctbal
              OR h.c_mktsegment IS DISTINCT FROM n.c_mktsegment)
         THEN TIMESTAMP '{RUN_TS}' END AS valid_to, h.scd_id
  FROM h1 h LEFT JOIN inc n ON h.c_custkey = n.c_custkey
  UNION ALL
  SELECT n.c_custkey, n.c_name, n.c_acctbal, TIMESTAMP '{RUN_TS}', CAST(NULL AS TIMESTAMP),
         md5(CAST(n.c_custkey AS VARCHAR) || '|' || '{RUN_TS}')
  FROM inc n LEFT JOIN h1 h ON h.c_custkey = n.c_custkey
  WHERE h.c_custkey IS NULL OR h.c_acctbal IS DISTINCT FROM n.c_acctbal
        OR h.c_mktsegment IS DISTINCT FROM n.c_mktsegment)
"""


def _dq_rows(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _rule_row(table: str, rule: str, total: str, failed: str, src: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({total} AS BIGINT) AS total, "
            f"CAST({failed} AS BIGINT) AS failed, "
            f"CASE WHEN {total} > 0 THEN round(({total} - {failed}) / CAST({total} AS DOUBLE), 6) END AS pass_ratio "
            f"FROM {src}")


def _contract_sql() -> str:
    gold = with_(*GOLD)
    rows = [
        f"SELECT 'dim_movie' AS table_name, 'unique(movie_id)' AS rule, 'movie_id' AS column_name, "
        f"'UNIQUENESS' AS dimension, count(*) AS total, "
        f"count(*) - coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM dim_movie WHERE movie_id IS NOT NULL "
        f"GROUP BY movie_id HAVING count(*) > 1) g), 0) AS passed FROM dim_movie",
        "SELECT 'dim_movie', 'range(release_year)', 'release_year', 'VALIDITY', count(*), "
        "count(*) FILTER (WHERE release_year IS NULL OR release_year BETWEEN 1888 AND 2030) FROM dim_movie",
        "SELECT 'dim_movie', 'row_condition(runtime_minutes)', 'runtime_minutes', 'CONSISTENCY', count(*), "
        "count(*) FILTER (WHERE coalesce(runtime_minutes >= 0, FALSE)) FROM dim_movie",
        "SELECT 'fact_diary_entries', 'not_null(letterboxd_uri)', 'letterboxd_uri', 'COMPLETENESS', count(*), "
        "count(letterboxd_uri) FROM fact_diary",
        "SELECT 'fact_diary_entries', 'row_condition(watched_date)', 'watched_date', 'VALIDITY', count(*), "
        "count(*) FILTER (WHERE coalesce(watched_date <= current_date, FALSE)) FROM fact_diary",
        "SELECT 'fact_diary_entries', 'regex(letterboxd_uri)', 'letterboxd_uri', 'CONFORMANCE', count(*), "
        "count(*) FILTER (WHERE letterboxd_uri IS NOT NULL AND "
        "regexp_matches(letterboxd_uri, '^https://boxd\\.it/[a-zA-Z0-9]+$')) FROM fact_diary",
        "SELECT 'fact_ratings', 'range(my_rating)', 'my_rating', 'VALIDITY', count(*), "
        "count(*) FILTER (WHERE my_rating BETWEEN 0.5 AND 5.0) FROM fact_ratings",
    ]
    return gold + ", contract AS (" + _dq_rows(rows) + ")\n"


def _model_tests_sql() -> str:
    def row(table, rule, total, failed):
        return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({total} AS BIGINT) AS total, "
                f"CAST({failed} AS BIGINT) AS failed")

    def not_null(table, src, column):
        return row(table, f"not_null({column})", "count(*)", f"count(*) - count({column})") + f" FROM {src}"

    def unique(table, src, column):
        return row(table, f"unique({column})", "coalesce(sum(n), 0)",
                   f"coalesce(sum(n) FILTER (WHERE {column} IS NOT NULL AND n > 1), 0)") + (
            f" FROM (SELECT {column}, count(*) AS n FROM {src} GROUP BY 1) g")

    def related(table, src, column, parent, field):
        return row(table, f"relationship({column})", f"count({column})",
                   f"count({column}) FILTER (WHERE {column} NOT IN (SELECT {field} FROM {parent} "
                   f"WHERE {field} IS NOT NULL))") + f" FROM {src}"

    def rated(table, src, scope):
        return row(table, "range(my_rating)", f"count(*) FILTER (WHERE {scope})",
                   "count(*) FILTER (WHERE my_rating < 0.5 OR my_rating > 5.0)") + f" FROM {src}"

    rows = []
    for table, src, filled, keys in (
            ("src_silver_movies", "silver_movies", ["letterboxd_uri", "enrichment_status"], ["letterboxd_uri"]),
            ("src_silver_diary_entries", "silver_diary", ["letterboxd_uri", "watched_date"], []),
            ("src_silver_ratings", "silver_ratings", ["letterboxd_uri", "my_rating"], []),
            ("stg_silver_movies", "stg_movies", ["letterboxd_uri", "enrichment_status", "title"], ["letterboxd_uri"]),
            ("stg_silver_diary_entries", "stg_diary", ["letterboxd_uri", "watched_date"], []),
            ("stg_silver_ratings", "stg_ratings", ["letterboxd_uri", "my_rating"], []),
            ("dim_date", "dim_date", ["date_id", "full_date", "year"], ["date_id", "full_date"]),
            ("dim_director", "dim_director", ["director_id", "director_tmdb_id", "director_name"],
             ["director_id", "director_tmdb_id"]),
            ("dim_genre", "dim_genre", ["genre_id", "genre_name"], ["genre_id", "genre_name"]),
            ("dim_movie", "dim_movie", ["movie_id", "letterboxd_uri", "title"], ["movie_id", "letterboxd_uri"]),
            ("bridge_movie_genre", "bridge", ["bridge_id", "movie_id", "genre_id"], ["bridge_id"]),
            ("fact_diary_entries", "fact_diary", ["diary_entry_id", "watched_date_id"], ["diary_entry_id"]),
            ("fact_ratings", "fact_ratings", ["rating_id", "rating_date_id", "my_rating"], ["rating_id"])):
        rows += [not_null(table, src, c) for c in filled] + [unique(table, src, c) for c in keys]
    rows += [row(table, "accepted_values(enrichment_status)", "count(*)",
                 "count(*) FILTER (WHERE enrichment_status NOT IN "
                 "('SUCCESS', 'FUZZY_MATCH', 'NOT_FOUND', 'ERROR'))") + f" FROM {src}"
             for table, src in (("src_silver_movies", "silver_movies"), ("stg_silver_movies", "stg_movies"))]
    rows += [related("dim_movie", "dim_movie", "director_id", "dim_director", "director_id"),
             related("bridge_movie_genre", "bridge", "movie_id", "dim_movie", "movie_id"),
             related("bridge_movie_genre", "bridge", "genre_id", "dim_genre", "genre_id"),
             related("fact_diary_entries", "fact_diary", "movie_id", "dim_movie", "movie_id"),
             related("fact_diary_entries", "fact_diary", "watched_date_id", "dim_date", "date_id"),
             related("fact_ratings", "fact_ratings", "movie_id", "dim_movie", "movie_id"),
             related("fact_ratings", "fact_ratings", "rating_date_id", "dim_date", "date_id"),
             rated("fact_diary_entries", "fact_diary", "my_rating IS NOT NULL"),
             rated("fact_ratings", "fact_ratings", "TRUE")]
    return with_(*GOLD) + "SELECT *, failed = 0 AS ok FROM (" + _dq_rows(rows) + ") t"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    gold = with_(*GOLD)

    q["csv_string_scan"] = ("SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
                            "event_type, props FROM events")
    q["missing_inputs"] = ("SELECT name FROM (VALUES ('diary.csv'), ('ratings.csv'), ('watched.csv'), "
                           "('reviews.csv'), ('watchlist.csv')) v(name) "
                           "WHERE name NOT IN (SELECT CASE event_type WHEN 'signup' THEN 'diary' "
                           "WHEN 'purchase' THEN 'ratings' WHEN 'view' THEN 'watched' ELSE event_type END "
                           "|| '.csv' FROM events)")
    q["bronze_lineage"] = ("SELECT o_orderkey, o_orderstatus, '2024-01-31' AS _ingestion_date, "
                           "'letterboxd' AS _source_system, 'orders.csv' AS _source_file, "
                           "'1.0.0' AS _pipeline_version FROM orders")
    q["ingest_summary"] = ("SELECT event_type || '.csv' AS file, count(*) AS n_rows FROM events GROUP BY 1")
    q["latest_partition"] = ("SELECT event_id, strftime(ts, '%Y-%m-%d') AS ingestion_date FROM events "
                             "WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)")
    q["export_reconcile"] = ("SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS sink_rows, "
                             "TRUE AS matches, TRUE AS same_columns FROM orders")
    q["schema_sync"] = ("SELECT p_partkey, p_name, p_type, CAST(NULL AS INTEGER) AS p_size, p_retailprice FROM part "
                        "WHERE p_partkey % 3 <> 0 UNION ALL "
                        "SELECT CASE WHEN p_partkey % 3 = 0 THEN p_partkey ELSE p_partkey + 1000000000 END, p_name, "
                        "p_type, p_size, p_retailprice + 1 FROM part")
    q["json_details_project"] = (
        "SELECT CAST(p_partkey AS BIGINT) AS tmdb_id, p_name AS title, replace(p_name, ' ', ',') AS genres_csv, "
        "CAST(p_size * 3 AS INTEGER) AS runtime, "
        "CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE nullif(p_partkey * 1000, 0) END AS BIGINT) AS budget "
        "FROM part")
    f = _film_json_fields()
    q["json_first_match"] = (f"SELECT p_partkey AS film_id, {f['director_name']} AS director_name, "
                             f"{f['director_id']} AS director_id FROM part")

    diary = with_(raw_diary())
    q["clean_diary"] = with_(raw_diary(), silver_diary()) + (
        "SELECT event_id, movie_title, letterboxd_uri, diary_date, watched_date, movie_year, "
        "CAST(my_rating AS DOUBLE) AS my_rating, is_rewatch, movie_title_normalized, "
        "array_to_string(tags, '|') AS tags, 'diary' AS source_file, "
        f"'2024-01-31' AS _ingestion_date, TIMESTAMP '{RUN_TS}' AS _silver_created_at, _silver_updated_at "
        "FROM silver_diary")
    q["parse_dates"] = diary + (f"SELECT event_id, {parsed_date(chr(34) + 'Date' + chr(34))} AS diary_date, "
                                f"{parsed_date(chr(34) + 'Watched Date' + chr(34))} AS watched_date FROM raw_diary")
    q["safe_year"] = diary + f"SELECT event_id, {safe_year(chr(34) + 'Year' + chr(34))} AS movie_year FROM raw_diary"
    q["safe_rating"] = diary + (f"SELECT event_id, CAST({safe_rating(chr(34) + 'Rating' + chr(34))} AS DOUBLE) "
                                "AS my_rating FROM raw_diary")
    q["flag_tokens"] = diary + ("SELECT event_id, \"Rewatch\" IN ('Yes', 'yes', 'TRUE', '1') AS is_rewatch "
                                "FROM raw_diary")
    q["normalize_title"] = f"SELECT doc_id, {norm('text')} AS title_norm FROM documents"
    q["split_tags"] = diary + ("SELECT event_id, CAST(len(string_split(\"Tags\", ',')) AS INTEGER) AS n_tags, "
                               "string_split(\"Tags\", ',')[1] AS first_tag FROM raw_diary")
    q["surrogate_key"] = (f"SELECT o_orderkey, "
                          f"{sk('o_orderkey', 'CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END')} AS sk "
                          "FROM orders")
    q["safe_divide"] = ("SELECT l_orderkey, l_linenumber, "
                        "round(CASE WHEN sum(l_tax) = 0 OR sum(l_tax) IS NULL THEN NULL "
                        "ELSE sum(l_quantity) / sum(l_tax) END, 6) AS ratio "
                        "FROM lineitem GROUP BY l_orderkey, l_linenumber")

    q["stg_movies"] = with_(silver_movies(), STG_MOVIES) + "SELECT * EXCLUDE (_silver_updated_at) FROM stg_movies"
    q["stg_diary"] = with_(raw_diary(), silver_diary(), STG_DIARY) + "SELECT * FROM stg_diary"
    q["stg_ratings"] = with_(raw_ratings(), silver_ratings(), STG_RATINGS) + "SELECT * FROM stg_ratings"

    cat = with_(raw_diary(), silver_diary(), raw_ratings(), silver_ratings(), SILVER_WATCHED, CATALOG_UNION)
    q["union_catalog"] = cat + "SELECT * FROM catalog"
    q["incremental_anti_join"] = with_(raw_diary(), silver_diary(), raw_ratings(), silver_ratings(),
                                       SILVER_WATCHED, CATALOG_UNION, silver_movies()) + (
        "SELECT letterboxd_uri FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM silver_movies m "
        "WHERE m.letterboxd_uri = c.letterboxd_uri AND m.enrichment_status = 'SUCCESS')")
    q["catalog_match"] = with_(MATCH) + "SELECT letterboxd_uri, tmdb_id, match_tier FROM matched"
    q["catalog_match_ranked"] = SEARCH + (
        "SELECT letterboxd_uri, CAST(rank AS INTEGER) AS rank, tmdb_id, score FROM hits WHERE rank <= 3")
    q["catalog_match_fuzzy"] = SEARCH + """
SELECT f.letterboxd_uri, CAST(coalesce(e.tmdb_id, n.tmdb_id) AS BIGINT) AS tmdb_id,
  CASE WHEN e.tmdb_id IS NOT NULL THEN 'EXACT_YEAR' WHEN n.tmdb_id IS NOT NULL AND f.movie_year IS NULL THEN 'TITLE_ONLY'
       WHEN n.tmdb_id IS NOT NULL THEN 'NEAR_YEAR' END AS match_tier
FROM films f
LEFT JOIN (SELECT letterboxd_uri, arg_min(tmdb_id, rank) AS tmdb_id FROM hits WHERE cat_year = movie_year GROUP BY 1) e
  USING (letterboxd_uri)
LEFT JOIN (SELECT letterboxd_uri, arg_min(tmdb_id, rank) AS tmdb_id FROM hits
           WHERE rank <= 3 AND (movie_year IS NULL OR abs(cat_year - movie_year) <= 2) GROUP BY 1) n
  USING (letterboxd_uri)"""
    q["match_status"] = with_(MATCH) + (
        ", st AS (SELECT m.letterboxd_uri, m.tmdb_id, p.*, CASE WHEN m.tmdb_id IS NULL THEN 'NOT_FOUND' "
        "WHEN m.tmdb_id % 13 = 0 THEN 'ERROR' "
        "WHEN m.movie_year IS NOT NULL AND abs(1950 + p.p_size + (p.p_partkey % 7) - 3 "
        "+ CASE WHEN p.p_partkey % 11 = 0 THEN 3 ELSE 0 END - m.movie_year) > 2 THEN 'FUZZY_MATCH' "
        "ELSE 'SUCCESS' END AS enrichment_status "
        "FROM matched m LEFT JOIN part p ON p.p_partkey = m.tmdb_id) "
        "SELECT letterboxd_uri, CASE WHEN enrichment_status <> 'ERROR' THEN tmdb_id END AS tmdb_id, enrichment_status, "
        "CASE WHEN good THEN CAST(p_size * 3 AS INTEGER) END AS runtime_minutes, "
        "CASE WHEN good THEN CAST(p_size AS BIGINT) * CASE WHEN p_partkey % 31 = 0 THEN 10000000000 ELSE 10 END END "
        "AS vote_count, CASE WHEN good THEN CAST(CASE WHEN p_partkey % 29 = 0 THEN 0 "
        "ELSE len(string_split(p_name, ' ')) END AS INTEGER) END AS n_genres "
        "FROM (SELECT *, enrichment_status IN ('SUCCESS', 'FUZZY_MATCH') AS good FROM st) x")
    q["dedup_composite"] = diary + (
        "SELECT letterboxd_uri, watched_date, event_id FROM ("
        f"SELECT \"Letterboxd URI\" AS letterboxd_uri, {parsed_date(chr(34) + 'Watched Date' + chr(34))} "
        "AS watched_date, event_id, row_number() OVER (PARTITION BY \"Letterboxd URI\", "
        f"{parsed_date(chr(34) + 'Watched Date' + chr(34))} ORDER BY event_id DESC) AS rn FROM raw_diary) d "
        "WHERE rn = 1")

    q["status_counts"] = with_(silver_movies()) + (
        "SELECT enrichment_status AS status, count(*) AS n FROM silver_movies GROUP BY 1")
    q["enrichment_rate"] = with_(silver_movies()) + (
        "SELECT count(*) FILTER (WHERE enrichment_status = 'SUCCESS') AS success, count(*) AS total, "
        "coalesce(round(count(*) FILTER (WHERE enrichment_status = 'SUCCESS') / nullif(count(*), 0)::DOUBLE, 6), 0.0)"
        " AS rate FROM silver_movies")
    q["audit_record"] = with_(raw_diary(), silver_diary(), raw_ratings(), silver_ratings(), SILVER_WATCHED,
                              CATALOG_UNION, silver_movies()) + f"""
SELECT '{RUN_TS}' AS pipeline_run_ts, 'incremental' AS run_mode, '2024-01-31' AS bronze_partition,
  (SELECT count(*) FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM silver_movies m
     WHERE m.letterboxd_uri = c.letterboxd_uri AND m.enrichment_status = 'SUCCESS')) AS movies_processed,
  (SELECT count(*) FROM silver_movies) AS silver_movies_total,
  (SELECT count(*) FROM silver_diary) AS silver_diary_total,
  (SELECT count(*) FROM silver_ratings) AS silver_ratings_total,
  (SELECT count(*) FILTER (WHERE enrichment_status = 'SUCCESS') FROM silver_movies) AS tmdb_success,
  (SELECT count(*) FILTER (WHERE enrichment_status = 'FUZZY_MATCH') FROM silver_movies) AS tmdb_fuzzy_match,
  (SELECT count(*) FILTER (WHERE enrichment_status = 'NOT_FOUND') FROM silver_movies) AS tmdb_not_found,
  (SELECT count(*) FILTER (WHERE enrichment_status = 'ERROR') FROM silver_movies) AS tmdb_error,
  'SUCCESS' AS job_status"""
    q["table_assertions"] = ("SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys "
                             "FROM orders")

    q["high_water_mark"] = ("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > "
                            "(SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders "
                            "WHERE o_orderdate < TIMESTAMP '1998-01-01')")
    q["high_water_mark_first_load"] = ("SELECT o_orderkey, o_orderdate FROM orders "
                                       "WHERE o_orderdate > TIMESTAMP '1900-01-01'")
    q["merge_conditional"] = _merge_movies_sql()
    q["merge_composite_key"] = _merge_diary_sql()
    q["merge_ratings"] = _merge_ratings_sql()
    for key, day, merged in (("stored_merge_diary", "watched_date", _merge_diary_sql()),
                             ("stored_merge_ratings", "rating_date", _merge_ratings_sql())):
        q[key] = (f"SELECT letterboxd_uri, {day}, my_rating, CAST(date_trunc('month', {day}) AS DATE) AS month "
                  f"FROM ({merged}) m")

    scd = "WITH " + SCD_BASE
    q["scd2_initial"] = scd + "SELECT c_custkey, c_name, c_acctbal, valid_from, valid_to, scd_id FROM h1"
    q["scd2_changes"] = scd + "SELECT * FROM h2"
    q["scd2_current"] = scd + "SELECT * FROM h2 WHERE valid_to IS NULL"
    q["scd2_as_of"] = scd + ("SELECT * FROM h2 WHERE valid_from <= TIMESTAMP '2024-01-15' "
                             "AND (valid_to IS NULL OR TIMESTAMP '2024-01-15' < valid_to)")
    q["stored_scd2"] = f"""
WITH last AS (
  SELECT *, CASE WHEN c_custkey % 21 = 0 THEN more + 1 ELSE more END AS value FROM (
    SELECT *, CASE WHEN c_custkey % 5 = 0 THEN once + 10 ELSE once END AS more FROM (
      SELECT *, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS once FROM customer) a) b)
SELECT c_custkey, c_name, c_acctbal, TIMESTAMP '{PREV_TS}' AS valid_from,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN TIMESTAMP '{RUN_TS}' END AS valid_to,
  md5(CAST(c_custkey AS VARCHAR) || '|' || '{PREV_TS}') AS scd_id
FROM last WHERE c_custkey % 11 <> 0
UNION ALL
SELECT c_custkey, c_name, value, TIMESTAMP '{RUN_TS}', NULL, md5(CAST(c_custkey AS VARCHAR) || '|' || '{RUN_TS}')
FROM last WHERE c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 5 = 0"""
    q["incremental_fact"] = f"""
SELECT {sk('o_orderkey')} AS fact_id, o_orderkey,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey % 10 = 0 THEN o_totalprice + 1
       ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey % 10 = 0 THEN TIMESTAMP '2002-01-01'
       ELSE o_orderdate END AS updated_at,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN TIMESTAMP '{PREV_TS}' ELSE TIMESTAMP '{RUN_TS}' END
    AS created_at
FROM orders"""

    q["stored_incremental_fact"] = f"""
SELECT f.*, CASE WHEN o.o_orderdate >= TIMESTAMP '1998-01-01' OR o.o_orderkey % 10 = 0 THEN o.o_custkey END AS o_custkey,
  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month
FROM ({q["incremental_fact"]}) f JOIN orders o USING (o_orderkey)"""

    q["dim_date"] = f"""{CALENDAR}
FROM (SELECT DISTINCT CAST(d AS DATE) AS d FROM (
  SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) x WHERE d IS NOT NULL) s"""
    q["dim_director"] = with_(silver_movies(), STG_MOVIES, DIM_DIRECTOR) + "SELECT * FROM dim_director"
    q["dim_genre"] = with_(silver_movies(), STG_MOVIES, DIM_GENRE) + "SELECT * FROM dim_genre"
    q["dim_movie"] = gold + "SELECT * FROM dim_movie"
    q["bridge_movie_genre"] = gold + "SELECT * FROM bridge"
    q["fact_diary"] = gold + "SELECT * FROM fact_diary"
    q["fact_ratings"] = gold + "SELECT * FROM fact_ratings"
    q["stored_fact_late_films"] = gold + (
        "SELECT diary_entry_id, movie_id, letterboxd_uri, watched_date, "
        "CAST(date_trunc('month', watched_date) AS DATE) AS month, "
        "movie_id IS NOT NULL AND regexp_matches(letterboxd_uri, '[147]$') AS repaired FROM fact_diary")

    q["dq_not_null"] = gold + _dq_rows([
        _rule_row("fact_ratings", "not_null(rating_id)", "count(*)",
                  "count(*) FILTER (WHERE rating_id IS NULL)", "fact_ratings"),
        _rule_row("fact_ratings", "not_null(rating_date_id)", "count(*)",
                  "count(*) FILTER (WHERE rating_date_id IS NULL)", "fact_ratings"),
        _rule_row("fact_ratings", "not_null(movie_id)", "count(*)",
                  "count(*) FILTER (WHERE movie_id IS NULL)", "fact_ratings"),
    ])
    q["dq_unique"] = _dq_rows([
        _rule_row("lineitem", "unique(l_orderkey,l_linenumber)", "(SELECT count(*) FROM lineitem)",
                  "coalesce(sum(n) FILTER (WHERE n > 1), 0)",
                  "(SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL "
                  "GROUP BY l_orderkey, l_linenumber) g"),
        _rule_row("orders", "unique(o_orderkey)", "(SELECT count(*) FROM orders)",
                  "coalesce(sum(n) FILTER (WHERE n > 1), 0)",
                  "(SELECT count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey) g"),
    ])
    q["dq_accepted_values"] = with_(silver_movies()) + _dq_rows([
        _rule_row("silver_movies", "accepted_values(enrichment_status)", "count(*)",
                  "count(*) FILTER (WHERE enrichment_status NOT IN ('SUCCESS','FUZZY_MATCH','NOT_FOUND','ERROR'))",
                  "silver_movies"),
        _rule_row("orders", "accepted_values(o_orderstatus)", "count(*)",
                  "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))", "orders"),
    ])
    q["dq_relationships"] = gold + (
        ", lab AS (SELECT CASE WHEN doc_id % 10 = 3 THEN doc_id + 1000000000 ELSE doc_id END AS doc_id "
        "FROM labels)\n") + _dq_rows([
        _rule_row("labels", "relationship(doc_id)", "count(*)",
                  "count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents))",
                  "lab WHERE doc_id IS NOT NULL"),
        _rule_row("fact_diary_entries", "relationship(movie_id)", "count(*)",
                  "count(*) FILTER (WHERE movie_id NOT IN (SELECT movie_id FROM dim_movie))",
                  "fact_diary WHERE movie_id IS NOT NULL"),
    ])
    q["dq_range"] = gold + _dq_rows([
        _rule_row("fact_ratings", "range(my_rating)", "count(*)",
                  "count(*) FILTER (WHERE my_rating IS NULL OR NOT (my_rating BETWEEN 0.5 AND 5.0))",
                  "fact_ratings"),
        _rule_row("fact_diary_entries", "range(my_rating)", "count(*) FILTER (WHERE my_rating IS NOT NULL)",
                  "count(*) FILTER (WHERE my_rating IS NOT NULL AND NOT (my_rating BETWEEN 0.5 AND 5.0))",
                  "fact_diary"),
        _rule_row("fact_diary_entries", "range_strict_nulls(my_rating)", "count(*)",
                  "count(*) FILTER (WHERE my_rating IS NULL OR NOT (my_rating BETWEEN 0.5 AND 5.0))",
                  "fact_diary"),
        _rule_row("dim_movie", "range(release_year)", "count(*)",
                  "count(*) FILTER (WHERE release_year IS NOT NULL AND NOT (release_year BETWEEN 1888 AND 2030))",
                  "dim_movie"),
    ])
    q["dq_regex"] = gold + _dq_rows([
        _rule_row("fact_diary_entries", "regex(letterboxd_uri)", "count(*)",
                  "count(*) FILTER (WHERE letterboxd_uri IS NULL OR NOT "
                  "regexp_matches(letterboxd_uri, '^https://boxd\\.it/[a-zA-Z0-9]+$'))", "fact_diary"),
        _rule_row("pages", "regex(url)", "count(*)",
                  "count(*) FILTER (WHERE url IS NULL OR NOT "
                  "regexp_matches(url, '^https://[a-z.]+\\.example\\.(com|org|net)/'))", "pages"),
    ])
    q["dq_row_condition"] = gold + _dq_rows([
        _rule_row("fact_diary_entries", "row_condition(watched_date)", "count(*)",
                  "count(*) FILTER (WHERE NOT coalesce(watched_date <= DATE '2024-12-31', FALSE))", "fact_diary"),
        _rule_row("dim_movie", "row_condition(runtime_minutes)", "count(*)",
                  "count(*) FILTER (WHERE NOT coalesce(runtime_minutes >= 0, FALSE))", "dim_movie"),
    ])
    contract = _contract_sql()
    q["dq_contract_report"] = contract + (
        "SELECT table_name, rule, column_name, dimension, CAST(total AS BIGINT) AS total, "
        "CAST(passed AS BIGINT) AS passed, "
        "CASE WHEN total > 0 THEN round(passed / CAST(total AS DOUBLE), 6) END AS pass_ratio, "
        "coalesce(round(passed / CAST(nullif(total, 0) AS DOUBLE), 6) >= 1.0, TRUE) AS ok FROM contract")
    q["dq_scorecard"] = contract + (
        "SELECT table_name, dimension, run_id, CAST(sum(total) AS BIGINT) AS total, "
        "CAST(sum(passed) AS BIGINT) AS passed, "
        "CASE WHEN sum(total) > 0 THEN round(sum(passed) * 100.0 / sum(total), 4) END AS score, "
        "coalesce(CASE WHEN sum(total) > 0 THEN round(sum(passed) * 100.0 / sum(total), 4) END = 100.0, TRUE) "
        f"AS is_perfect FROM contract, (VALUES ('{PREV_TS}'), ('{RUN_TS}')) r(run_id) "
        "GROUP BY table_name, dimension, run_id")
    q["dq_model_tests"] = _model_tests_sql()

    q["kpi_global"] = gold + (
        "SELECT count(DISTINCT letterboxd_uri) AS n_films, round(avg(my_rating), 6) AS avg_rating, "
        "(SELECT count(DISTINCT director_id) FROM dim_movie) AS n_directors, "
        "(SELECT coalesce(round(count(*) FILTER (WHERE enrichment_status = 'SUCCESS') / "
        "nullif(count(*), 0)::DOUBLE, 6), 0.0) FROM silver_movies) AS enrichment_rate FROM fact_diary")
    for grain in ("month", "year"):
        q[f"timeline_{grain}"] = gold + (
            f"SELECT source, CAST(date_trunc('{grain}', d) AS DATE) AS period, count(*) AS n_entries, "
            "count(DISTINCT letterboxd_uri) AS n_films FROM ("
            "SELECT 'diary' AS source, watched_date AS d, letterboxd_uri FROM fact_diary UNION ALL "
            "SELECT 'ratings', rating_date, letterboxd_uri FROM fact_ratings) u WHERE d IS NOT NULL GROUP BY 1, 2")
    q["rating_distribution"] = gold + (
        "SELECT r.my_rating, count(*) AS n_ratings, count(m.vote_average) AS n_with_catalogue, "
        "round(avg(r.my_rating * 2 - m.vote_average), 6) AS avg_diff_10pt "
        "FROM fact_ratings r LEFT JOIN dim_movie m ON r.movie_id = m.movie_id GROUP BY r.my_rating")
    q["genre_share"] = gold + (
        ", pg AS (SELECT g.genre_name, count(*) AS n_views, sum(g.runtime_minutes) AS minutes "
        "FROM fact_diary f JOIN (SELECT movie_id, runtime_minutes, unnest(list_distinct(genres)) AS genre_name "
        "FROM dim_movie) g ON f.movie_id = g.movie_id GROUP BY g.genre_name)\n"
        "SELECT genre_name, n_views, CAST(minutes AS BIGINT) AS minutes, "
        "round(minutes / (SELECT sum(minutes) FROM pg)::DOUBLE, 6) AS share FROM pg")
    q["fanout_safe_count"] = gold + (
        "SELECT b.genre_name, count(DISTINCT f.movie_id) AS n_films, count(*) AS n_views_inflated "
        "FROM fact_diary f JOIN bridge b ON f.movie_id = b.movie_id GROUP BY b.genre_name")
    q["unmatched_latest"] = with_(silver_movies()) + (
        "SELECT letterboxd_uri, lb_movie_title, lb_movie_year, _silver_created_at FROM silver_movies "
        "WHERE enrichment_status = 'NOT_FOUND' ORDER BY _silver_created_at DESC, letterboxd_uri ASC LIMIT 20")
    q["preview_enriched"] = with_(silver_movies()) + (
        "SELECT lb_movie_title, lb_movie_year, tmdb_id, director_name, vote_average, runtime_minutes, "
        "letterboxd_uri FROM silver_movies WHERE enrichment_status = 'SUCCESS' "
        "ORDER BY letterboxd_uri LIMIT 5")
    q["preview_not_found"] = with_(silver_movies()) + (
        "SELECT lb_movie_title, lb_movie_year, letterboxd_uri FROM silver_movies "
        "WHERE enrichment_status = 'NOT_FOUND' ORDER BY letterboxd_uri LIMIT 10")
    q["top_directors"] = gold + (
        "SELECT m.director_name, count(*) AS n_views, count(DISTINCT f.movie_id) AS n_films, "
        "round(avg(f.my_rating), 6) AS avg_rating FROM fact_ratings f JOIN dim_movie m ON f.movie_id = m.movie_id "
        "WHERE m.director_name IS NOT NULL GROUP BY m.director_name "
        "ORDER BY n_views DESC, m.director_name ASC LIMIT 10")
    q["top_movies"] = gold + (
        "SELECT m.letterboxd_uri, m.title, count(*) AS n_views, round(avg(f.my_rating), 6) AS avg_rating "
        "FROM fact_ratings f JOIN dim_movie m ON f.movie_id = m.movie_id "
        "WHERE list_contains(m.genres, 'widget') GROUP BY m.movie_id, m.letterboxd_uri, m.title "
        "ORDER BY n_views DESC, m.letterboxd_uri ASC LIMIT 10")
    q["top_movies_year"] = gold + (
        "SELECT m.letterboxd_uri, m.title, count(*) AS n_views, round(avg(f.my_rating), 6) AS avg_rating "
        "FROM fact_ratings f JOIN dim_movie m ON f.movie_id = m.movie_id "
        "WHERE m.release_year = 1975 GROUP BY m.movie_id, m.letterboxd_uri, m.title "
        "ORDER BY n_views DESC, m.letterboxd_uri ASC LIMIT 10")
    return q


ORACLE_SQL = build()
