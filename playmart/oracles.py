"""DuckDB statements that compute each registered query independently."""

from __future__ import annotations

from playmart.schemas import COLUMNS, NOT_NULL, TARGETS

STAGED = """
WITH staging_events AS (
    SELECT 'Artist ' || (p_partkey // 60) AS artist,
           CAST(NULL AS VARCHAR) AS auth,
           c_name AS "firstName",
           CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CAST(NULL AS INTEGER) AS "iteminSession",
           c_mktsegment AS "lastName",
           CAST(NULL AS DECIMAL(23,5)) AS length,
           CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN value >= 20 THEN 'paid' ELSE 'free' END AS level,
           n_name AS location,
           CAST(NULL AS VARCHAR) AS method,
           CASE WHEN event_type = 'view' THEN 'NextSong' ELSE event_type END AS page,
           CAST(NULL AS DECIMAL(23,5)) AS registration,
           CAST(user_id AS INTEGER) AS "sessionId",
           'Title ' || (p_partkey // 3) AS song,
           CAST(NULL AS INTEGER) AS status,
           epoch_us(ts) // 1000 AS ts,
           event_type AS "userAgent",
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS "userId",
           CAST(date_trunc('second', ts) AS TIMESTAMP) AS second_of
    FROM events, customer, nation, part
    WHERE user_id = c_custkey AND c_nationkey = n_nationkey
      AND p_partkey = CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)
),
staging_songs AS (
    SELECT CAST(1 AS INTEGER) AS num_songs,
           'AR' || (p_partkey // 60) AS artist_id,
           CAST(NULL AS DECIMAL(23,5)) AS artist_latitude,
           CAST(NULL AS DECIMAL(23,5)) AS artist_longitude,
           p_type AS artist_location,
           'Artist ' || (p_partkey // 60) AS artist_name,
           'SO' || p_partkey AS song_id,
           'Title ' || (p_partkey // 3) AS title,
           CAST(p_retailprice AS DECIMAL(23,5)) AS duration,
           CAST(p_size AS INTEGER) AS year
    FROM part
),
songplays AS (
    SELECT second_of AS start_time, "userId" AS user_id, level, song_id, artist_id,
           "sessionId" AS session_id, location, "userAgent" AS user_agent
    FROM staging_events JOIN staging_songs ON artist = artist_name AND song = title
    WHERE page = 'NextSong'
),
numbered AS (
    SELECT row_number() OVER (
               ORDER BY start_time NULLS FIRST, user_id NULLS FIRST, level NULLS FIRST,
                        song_id NULLS FIRST, artist_id NULLS FIRST, session_id NULLS FIRST,
                        location NULLS FIRST, user_agent NULLS FIRST
           ) - 1 AS songplay_id, *
    FROM songplays
),
users AS (
    SELECT DISTINCT "userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level
    FROM staging_events WHERE page = 'NextSong' AND "userId" IS NOT NULL
),
calendar AS (
    SELECT second_of AS start_time,
           CAST(hour(second_of) AS INTEGER) AS hour,
           CAST(day(second_of) AS INTEGER) AS day,
           CAST(weekofyear(second_of) AS INTEGER) AS week,
           CAST(month(second_of) AS INTEGER) AS month,
           CAST(year(second_of) AS INTEGER) AS year,
           CAST(dayofweek(second_of) AS INTEGER) AS weekday,
           page
    FROM staging_events
),
time_rows AS (
    SELECT DISTINCT start_time, hour, day, week, month, year, weekday
    FROM calendar WHERE page = 'NextSong'
)
"""

_RESULTS = {
    "staging_events": "SELECT * EXCLUDE (second_of) FROM staging_events",
    "staging_songs": "SELECT * FROM staging_songs",
    "ingest_events": "SELECT * EXCLUDE (second_of) FROM staging_events",
    "ingest_songs": "SELECT * FROM staging_songs",
    "nextsong_filter": """SELECT "userId", "sessionId", ts, level FROM staging_events WHERE page = 'NextSong'""",
    "not_null_filter": """SELECT "userId", page, ts FROM staging_events WHERE "userId" IS NOT NULL""",
    "epoch_to_timestamp": "SELECT ts, second_of AS start_time FROM staging_events",
    "calendar_parts": "SELECT * EXCLUDE (page) FROM calendar",
    "join_artist_title": """
        SELECT artist, song, ts, song_id, artist_id
        FROM staging_events JOIN staging_songs ON artist = artist_name AND song = title""",
    "songplays": "SELECT * FROM numbered",
    "users": "SELECT * FROM users",
    "songs": "SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs WHERE song_id IS NOT NULL",
    "artists": """
        SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
               artist_latitude AS latitude, artist_longitude AS longitude
        FROM staging_songs WHERE artist_id IS NOT NULL""",
    "time": "SELECT * FROM time_rows",
    "duplicate_keys": "SELECT user_id, count(*) AS n FROM users GROUP BY user_id HAVING count(*) > 1",
    "plays_by_hour": """
        SELECT hour, count(DISTINCT songplay_id) AS song_plays
        FROM numbered JOIN time_rows USING (start_time) GROUP BY hour ORDER BY hour""",
    "plays_by_level": "SELECT level, count(DISTINCT songplay_id) AS song_plays FROM numbered GROUP BY level",
    "users_by_gender": "SELECT gender, count(DISTINCT user_id) AS users FROM users GROUP BY gender",
}

_RESULTS |= {
    "appended_songplays": """
        SELECT * FROM numbered
        UNION ALL
        SELECT songplay_id + (SELECT count(*) FROM numbered), * EXCLUDE (songplay_id) FROM numbered""",
    "arrivals_songplays": _RESULTS["songplays"],
    "arrivals_users": _RESULTS["users"],
    "arrivals_time": _RESULTS["time"],
    "ingest_songs_ddl": """
        SELECT num_songs, artist_id, CAST(NULL AS DECIMAL(18,0)) AS artist_latitude,
               CAST(NULL AS DECIMAL(18,0)) AS artist_longitude, artist_location, artist_name, song_id, title,
               CAST(trunc(duration) AS DECIMAL(18,0)) AS duration, year
        FROM staging_songs""",
    "etl_row_counts": """
        SELECT 'staging_events' AS table_name, count(*) AS n FROM staging_events
        UNION ALL SELECT 'staging_songs', count(*) FROM staging_songs
        UNION ALL SELECT 'songplays', count(*) FROM numbered
        UNION ALL SELECT 'users', count(*) FROM users
        UNION ALL SELECT 'songs', count(*)
                  FROM (SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs)
        UNION ALL SELECT 'artists', count(*)
                  FROM (SELECT DISTINCT artist_id, artist_name, artist_location FROM staging_songs)
        UNION ALL SELECT 'time', count(*) FROM time_rows""",
    "plays_by_hour_from_staging": _RESULTS["plays_by_hour"],
    "plays_by_level_from_staging": _RESULTS["plays_by_level"],
    "users_by_gender_from_staging": _RESULTS["users_by_gender"],
    "arrivals_late_songs": "SELECT * EXCLUDE (songplay_id) FROM numbered",
    "overwritten_songplays": _RESULTS["songplays"],
    "etl_songplays": _RESULTS["songplays"],
    "etl_songs": _RESULTS["songs"],
    "etl_artists": _RESULTS["artists"],
    "stored_layout": "SELECT * FROM (VALUES "
    + ", ".join(f"('{table}', CAST(0 AS BIGINT))" for table in TARGETS)
    + ") AS t(table_name, overlapping_files)",
    "etl_users": _RESULTS["users"],
    "etl_time": _RESULTS["time"],
    "reset_row_counts": "SELECT * FROM (VALUES "
    + ", ".join(f"('{table}', CAST(0 AS BIGINT))" for table in COLUMNS)
    + ") AS t(table_name, n)",
    "not_null_rejects": "SELECT * FROM (VALUES "
    + ", ".join(f"('{table}', '{column}', true)" for table, columns in NOT_NULL.items() for column in columns)
    + ") AS t(table_name, column_name, rejected)",
    "ingest_dirty_events": """
        SELECT "userId", "sessionId", ts, page, CAST(ts AS DECIMAL(23,5)) AS registration FROM staging_events""",
    "quarantined_events": """
        SELECT CASE WHEN ts % 4 = 0 THEN "sessionId" END AS session_id,
               CASE WHEN ts % 4 = 0 THEN ts END AS ts,
               CASE ts % 4 WHEN 1 THEN line || line WHEN 2 THEN line || ' xyz{bad'
                    WHEN 3 THEN left(line, length(line) - 2) END AS record
        FROM (SELECT "sessionId", ts, '{"sessionId":' || "sessionId" || ',"ts":' || ts || '}' AS line
              FROM staging_events)""",
}

ORACLES = {name: f"{STAGED}{result.strip()}" for name, result in _RESULTS.items()}
