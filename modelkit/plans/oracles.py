"""SQL statements of the same results, written against the raw tables for a different engine (DuckDB).

They state each result directly, without the operators' techniques: self joins instead of window
prefixes, calendars instead of array arithmetic, range conditions instead of buckets.
"""

from __future__ import annotations

import math

SEASONS = """
seasons AS (
  SELECT o_custkey AS player, CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS gp,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE)
           / (CAST(count(*) AS DOUBLE) * CAST(1000000 AS DOUBLE)) AS pts
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
"""

BANDS = "CASE WHEN {0} > 20 THEN 'star' WHEN {0} > 15 THEN 'good' WHEN {0} > 10 THEN 'average' ELSE 'bad' END"

PLAYERS = f"""
{SEASONS},
years AS (SELECT DISTINCT season AS current_season FROM seasons),
grid AS (
  SELECT f.player, y.current_season
  FROM (SELECT player, min(season) AS first FROM seasons GROUP BY 1) f
  JOIN years y ON y.current_season >= f.first),
players AS (
  SELECT g.player, g.current_season, string_agg(s.season || ':' || s.gp, ',' ORDER BY s.season) AS season_stats,
         {BANDS.format("arg_max(s.pts, s.season)")} AS scoring_class,
         CAST(g.current_season - max(s.season) AS INTEGER) AS years_since_last_active,
         max(s.season) = g.current_season AS is_active
  FROM grid g JOIN seasons s ON s.player = g.player AND s.season <= g.current_season
  GROUP BY 1, 2)
"""

PEOPLE = "SELECT c_custkey, c_name AS player_name, c_mktsegment AS college, CAST(c_nationkey AS VARCHAR) AS country FROM customer"

RANGES = f"""
{PLAYERS},
starts AS (
  SELECT p.player, p.scoring_class, p.is_active, p.current_season AS start_season
  FROM players p LEFT JOIN players q ON q.player = p.player AND q.current_season = p.current_season - 1
  WHERE q.player IS NULL OR q.scoring_class <> p.scoring_class OR q.is_active <> p.is_active),
ranges AS (
  SELECT s.player, s.scoring_class, s.is_active, s.start_season,
         CAST(coalesce(min(n.start_season) - 1, (SELECT max(current_season) FROM years)) AS INTEGER) AS end_season
  FROM starts s LEFT JOIN starts n ON n.player = s.player AND n.start_season > s.start_season
  GROUP BY 1, 2, 3, 4)
"""

SCD = f"""
WITH {RANGES}
SELECT player, scoring_class, is_active, start_season, end_season,
       (SELECT max(current_season) FROM years) AS current_season
FROM ranges
"""

PLAYER_TABLE = f"""
WITH {PLAYERS}
SELECT player, player_name, college, country, season_stats, scoring_class, years_since_last_active, current_season, is_active
FROM players JOIN ({PEOPLE}) ON c_custkey = player
"""

ACTORS = """
films AS (
  SELECT o_custkey AS actorid, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS id,
         CAST(round(o_totalprice * 100) AS BIGINT) / CAST(5000000 AS DOUBLE) AS rating
  FROM orders),
yearly AS (SELECT actorid, year, avg(rating) AS rating FROM films GROUP BY 1, 2),
grid AS (
  SELECT f.actorid, y.year AS current_year
  FROM (SELECT actorid, min(year) AS first FROM films GROUP BY 1) f
  JOIN (SELECT DISTINCT year FROM films) y ON y.year >= f.first),
rated AS (
  SELECT g.actorid, g.current_year, arg_max(y.rating, y.year) AS rating, max(y.year) AS newest
  FROM grid g JOIN yearly y ON y.actorid = g.actorid AND y.year <= g.current_year GROUP BY 1, 2),
actors AS (
  SELECT actorid, current_year, newest = current_year AS is_active,
         CASE WHEN rating > 8 THEN 'star' WHEN rating > 7 THEN 'good' WHEN rating > 6 THEN 'average' ELSE 'bad' END
           AS quality_class
  FROM rated)
"""

ACTOR_TABLE = f"""
WITH {ACTORS},
counted AS (
  SELECT g.actorid, g.current_year, count(*) AS films
  FROM grid g JOIN films f ON f.actorid = g.actorid AND f.year <= g.current_year GROUP BY 1, 2)
SELECT actorid, 'actor ' || actorid AS actor, films, quality_class, current_year, is_active
FROM counted JOIN actors USING (actorid, current_year)
"""

GAMES = """
games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est, CAST(year(o_orderdate) AS INTEGER) AS season,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins,
         CAST(round(o_totalprice * 100) AS BIGINT) AS pts_home, length(o_orderpriority) AS pts_away,
         home_team_id, visitor_team_id
  FROM orders JOIN (
    SELECT l_orderkey, min(l_suppkey) AS home_team_id, max(l_suppkey) AS visitor_team_id FROM lineitem GROUP BY 1
  ) ON l_orderkey = o_orderkey)
"""

DETAILS = """
details AS (
  SELECT l_orderkey AS game_id, l_suppkey AS team_id, 'T' || (l_suppkey % 10) AS team_abbreviation,
         l_partkey AS player_id, 'player ' || l_partkey AS player_name, l_linestatus AS start_position,
         CASE l_returnflag WHEN 'A' THEN 'NWT - personal' WHEN 'R' THEN 'DNP - coach''s decision' END AS comment,
         CASE WHEN l_returnflag = 'A' THEN NULL
              ELSE CAST(l_linenumber * 5 AS DOUBLE) + CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) / CAST(60 AS DOUBLE)
         END AS m_minutes,
         CAST(l_quantity AS BIGINT) AS pts, l_linenumber AS ast, l_shipdate AS shipped, l_extendedprice AS price
  FROM lineitem)
"""

BY_RANK = "pts DESC, ast, team_id, start_position, shipped, price"

FACT = f"""
{GAMES}, {DETAILS},
fact AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY game_id, team_id, player_id ORDER BY {BY_RANK}) AS pick FROM details
  ) JOIN games USING (game_id) WHERE pick = 1)
"""

APPEARANCES = f"""
{DETAILS},
appearances AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY player_id, game_id ORDER BY {BY_RANK}) AS pick FROM details
  ) WHERE pick = 1)
"""

PAIRS = f"""
{APPEARANCES},
pairs AS (
  SELECT a.player_id AS subject, b.player_id AS object,
         CASE WHEN a.team_abbreviation = b.team_abbreviation THEN 'shares_team' ELSE 'plays_against' END AS edge_type,
         count(*) AS num_games, CAST(sum(a.pts) AS BIGINT) AS subject_points, CAST(sum(b.pts) AS BIGINT) AS object_points
  FROM appearances a JOIN appearances b ON a.game_id = b.game_id AND a.player_id <> b.player_id
  WHERE a.player_id IN (SELECT player_id FROM details GROUP BY 1 ORDER BY sum(pts) DESC, player_id LIMIT 10)
  GROUP BY 1, 2, 3)
"""

CAREERS = """
careers AS (
  SELECT player_id, max(player_name) AS player_name, count(*) AS number_of_games, CAST(sum(pts) AS BIGINT) AS total_points
  FROM details GROUP BY 1)
"""

TEAMS = """
teams AS (
  SELECT s_suppkey AS team_id, 'T' || (s_suppkey % 10) AS abbreviation, s_name AS nickname,
         CAST(s_nationkey AS VARCHAR) AS city, CASE WHEN s_nationkey > 2 THEN 'arena ' || s_nationkey END AS arena,
         s_suppkey % 50 + 1900 AS year_founded
  FROM supplier)
"""

WEB = """
web AS (
  SELECT event_id, user_id, k AS device_id, '/' || event_type AS url, 'host' || (k % 3) || '.example.com' AS host,
         CASE k % 7 WHEN 0 THEN 'https://www.linkedin.com/feed' WHEN 1 THEN 'https://t.co/abc'
           WHEN 2 THEN 'https://www.google.com/' WHEN 3 THEN 'https://lnkd.in/xyz'
           WHEN 4 THEN 'https://news.example.org/' WHEN 5 THEN 'https://blog.example.net/' END AS referrer,
         CASE k % 7 WHEN 0 THEN 'Linkedin' WHEN 1 THEN 'Twitter' WHEN 2 THEN 'Google' WHEN 3 THEN 'Linkedin'
           WHEN 4 THEN 'https://news.example.org/' WHEN 5 THEN 'https://blog.example.net/' END AS channel,
         10 * 16777216 + (user_id % 200) * 65536 + ((user_id // 200) % 250) * 256 + event_id % 250 AS ip_number,
         '10.' || (user_id % 200) || '.' || ((user_id // 200) % 250) || '.' || (event_id % 250) AS ip,
         ts, CAST(ts AS DATE) AS day, value,
         'browser' || (k % 4) AS browser_type, 'device' || (k % 2) AS device_type,
         CASE WHEN k % 5 <> 4 THEN 'os' || (k % 5) END AS os_type
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))
"""


def days_of(*keys: str) -> str:
    """Active days per key and the grid of (key, date) from the first day to the last day of the log."""
    by = ", ".join(keys)
    same = " AND ".join(f"f.{k} = a.{k}" for k in keys)
    listed = ", ".join(f"f.{k}" for k in keys)
    return f"""
    {WEB},
    active AS (SELECT DISTINCT {by}, day FROM web),
    calendar AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS date FROM active),
    firsts AS (SELECT {by}, min(day) AS first FROM active GROUP BY {by}),
    lists AS (
      SELECT {listed}, c.date, list(a.day ORDER BY a.day) AS days
      FROM firsts f JOIN calendar c ON c.date >= f.first JOIN active a ON {same} AND a.day <= c.date
      GROUP BY {listed}, c.date)
    """


def joined(direction: str) -> str:
    source = "list_reverse(days)" if direction == "desc" else "days"
    return f"array_to_string(list_transform({source}, lambda d: CAST(d AS VARCHAR)), ',')"


LAST_DAY = "(SELECT max(day) FROM active)"


def arrays_of(key: str, cells: str, fill: str = "0") -> str:
    """Daily values per key on the days of the month up to the last day of the log, missing ones filled."""
    return f"""
    {WEB},
    daily AS (SELECT {key}, day, {cells} FROM web GROUP BY ALL),
    months AS (SELECT {key}, CAST(date_trunc('month', day) AS DATE) AS month, min(day) AS first_day FROM daily GROUP BY 1, 2),
    grid AS (
      SELECT {key}, month, first_day, CAST(unnest(generate_series(month,
        least(last_day(month), (SELECT max(day) FROM daily)), INTERVAL 1 DAY)) AS DATE) AS day FROM months),
    filled AS (SELECT g.{key}, g.month, g.first_day, g.day, COLUMNS(d.* EXCLUDE ({key}, day))
               FROM grid g LEFT JOIN daily d ON d.{key} = g.{key} AND d.day = g.day)
    """


USER_ARRAYS = arrays_of("user_id", "count(*) AS hits")

GROWTH = f"""
{days_of("user_id")},
steps AS (
  SELECT user_id, date, days, days[1] AS first_active, days[len(days)] AS newest,
         CASE WHEN days[len(days)] = date THEN days[len(days) - 1] ELSE days[len(days)] END AS before,
         days[len(days)] = date AS present
  FROM lists),
growth AS (
  SELECT user_id, first_active AS first_active_date, newest AS last_active_date, days, date,
         CASE WHEN date = first_active THEN 'New'
              WHEN present AND date - before = 1 THEN 'Retained'
              WHEN present THEN 'Resurrected'
              WHEN date - before = 1 THEN 'Churned' ELSE 'Stale' END AS daily_active_state,
         CASE WHEN date = first_active THEN 'New'
              WHEN present AND date - before > 7 THEN 'Resurrected'
              WHEN NOT present AND date - before = 8 THEN 'Churned'
              WHEN present OR date - before <= 8 THEN 'Retained' ELSE 'Stale' END AS weekly_active_state
  FROM steps)
"""

MASK_ROWS = f"""
{WEB},
active AS (SELECT DISTINCT user_id, {LAST_DAY.replace("active", "web")} - day AS age FROM web),
masks AS (
  SELECT user_id, CAST(sum(CASE WHEN age <= 31 THEN CAST(1 AS BIGINT) << CAST(31 - age AS INTEGER) ELSE 0 END) AS BIGINT) AS datelist_int,
         CAST(sum(CASE WHEN age BETWEEN 1 AND 32 THEN CAST(1 AS BIGINT) << CAST(32 - age AS INTEGER) ELSE 0 END) AS BIGINT)
           AS datelist_int_literal
  FROM active GROUP BY 1)
"""

SESSIONS = f"""
{WEB},
marked AS (
  SELECT user_id, host, ts,
         CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id, host ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
  FROM web),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id, host ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked),
sessions AS (
  SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, host, count(*) AS num_events
  FROM numbered GROUP BY user_id, host, session)
"""

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
SESSION_COLUMNS = (
    f"{STAMP.format('session_start')} AS session_start, {STAMP.format('session_end')} AS session_end, user_id, host, num_events"
)

GEO = f"""
{WEB},
ranges AS (
  SELECT 167772160 + n_nationkey * 524288 AS low, 167772160 + n_nationkey * 524288 + 393215 AS high,
         n_name, r_name, 'city ' || n_nationkey AS city
  FROM nation JOIN region ON r_regionkey = n_regionkey),
located AS (
  SELECT w.*, n_name AS country,
         CASE WHEN n_name IS NULL THEN '{{}}'
              ELSE '{{"country":"' || n_name || '","state":"' || r_name || '","city":"' || city || '"}}' END AS geodata
  FROM web w LEFT JOIN ranges ON ip_number BETWEEN low AND high)
"""


def slot(experiment: str, unit: str) -> str:
    return f"(CAST('0x' || substr(md5('{experiment}:' || {unit}), 1, 8) AS BIGINT) % 10000)"


def variant(experiment: str, unit: str, bounds: list[tuple[int, str]], rest: str) -> str:
    cases = " ".join(f"WHEN {slot(experiment, unit)} < {b} THEN '{name}'" for b, name in bounds)
    return f"CASE {cases} ELSE '{rest}' END"


ONBOARDING = variant("onboarding", "user_id", [(3333, "control"), (6666, "test_a")], "test_b")

EXPOSED = f"""
exposed AS (
  SELECT user_id, 'onboarding' AS experiment, min(ts) AS first_exposed_at, {ONBOARDING} AS variant
  FROM web WHERE url = '/view' GROUP BY user_id)
"""

TEAM_GAMES = f"""
{GAMES}, {DETAILS},
team_games AS (
  SELECT DISTINCT team_id, game_id, game_date_est,
         CASE WHEN team_id = home_team_id THEN home_team_wins WHEN team_id = visitor_team_id THEN 1 - home_team_wins END AS won
  FROM details JOIN games USING (game_id))
"""


def states(literal: bool) -> str:
    """States by recursion over the periods, one period from the one before."""
    resting = "('Retired')" if literal else "('Retired', 'Stayed Retired')"
    playing = "('New', 'Continued Playing', 'Returned from Retirement')"
    return f"""
    WITH RECURSIVE {PLAYERS},
    base AS (
      SELECT player, college, current_season, is_active,
             current_season = min(current_season) OVER (PARTITION BY player) AS is_first
      FROM players JOIN ({PEOPLE}) ON c_custkey = player),
    walk AS (
      SELECT player, college, current_season, 'New' AS state FROM base WHERE is_first
      UNION ALL
      SELECT b.player, b.college, b.current_season,
             CASE WHEN w.state IN {playing} THEN CASE WHEN b.is_active THEN 'Continued Playing' ELSE 'Retired' END
                  WHEN b.is_active AND w.state IN {resting} THEN 'Returned from Retirement'
                  ELSE 'Stayed Retired' END
      FROM walk w JOIN base b ON b.player = w.player AND b.current_season = w.current_season + 1)
    SELECT player, college, current_season, state FROM walk
    """


TUMBLING = f"""
WITH {WEB}
SELECT {STAMP.format("time_bucket(INTERVAL 5 MINUTE, ts)")} AS event_hour, {{0}}, count(*) AS num_hits
FROM web GROUP BY ALL
"""

ACTIVES = """
SELECT '{0}' AS dimension, {1} AS member, count(DISTINCT user_id) AS users
FROM web WHERE ts >= (SELECT max(day) FROM web) - 22 AND referrer IS NOT NULL GROUP BY ALL HAVING count(DISTINCT user_id) <= 56083
"""


def monthly(dim: str, where: str, top: int) -> str:
    return f"""
    WITH {WEB}, kept AS (SELECT user_id, day, {dim} FROM web WHERE {where}),
    best AS (SELECT member FROM (SELECT member, count(DISTINCT user_id) AS users FROM kept WHERE member IS NOT NULL GROUP BY 1)
             ORDER BY users DESC, member LIMIT {top})
    SELECT CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS month, member AS {{0}}, count(DISTINCT user_id) AS users
    FROM kept WHERE member IN (SELECT member FROM best) GROUP BY ALL
    """


LEVELS = f"""
WITH {WEB}, dims AS (SELECT browser_type, device_type, coalesce(os_type, 'unknown') AS os_type FROM web)
SELECT 'browser_type__device_type__os_type' AS aggregation_level, browser_type, device_type, os_type, count(*) AS number_of_hits
FROM dims GROUP BY ALL
UNION ALL SELECT 'browser_type', browser_type, '(overall)', '(overall)', count(*) FROM dims GROUP BY ALL
UNION ALL SELECT 'os_type', '(overall)', '(overall)', os_type, count(*) FROM dims GROUP BY ALL
UNION ALL SELECT 'device_type', '(overall)', device_type, '(overall)', count(*) FROM dims GROUP BY ALL
"""

KPI_METRICS = (
    "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS profit_cents, "
    "count(DISTINCT user_id) AS growth_users, count(*) AS engagement_events"
)
KPI = f"""
WITH {WEB}, rows_ AS (
  SELECT CAST(day AS VARCHAR) AS day, {variant("checkout", "user_id", [(5000, "control")], "test")} AS variant, value, user_id FROM web)
SELECT 'day__variant' AS aggregation_level, day, variant, {KPI_METRICS} FROM rows_ GROUP BY day, variant
UNION ALL SELECT 'day', day, '(overall)', {KPI_METRICS} FROM rows_ GROUP BY day
UNION ALL SELECT '', '(overall)', '(overall)', {KPI_METRICS} FROM rows_
"""

ORACLES: dict[str, str] = {
    "fact_dedupe": f"""
        WITH {FACT}
        SELECT CAST(game_date_est AS VARCHAR) AS dim_game_date, season AS dim_season, team_id AS dim_team_id,
               player_id AS dim_player_id, player_name AS dim_player_name, start_position AS dim_start_position,
               team_id = home_team_id AS dim_is_playing_at_home, coalesce(contains(comment, 'DNP'), false) AS dim_did_not_play,
               coalesce(contains(comment, 'DND'), false) AS dim_did_not_dress,
               coalesce(contains(comment, 'NWT'), false) AS dim_not_with_team, m_minutes,
               CAST(ast AS INTEGER) AS m_ast, CAST(pts AS INTEGER) AS m_pts
        FROM fact""",
    "fact_quality": f"""
        WITH {FACT}
        SELECT player_id AS dim_player_id, max(player_name) AS dim_player_name, count(*) AS num_games,
               count(*) FILTER (contains(comment, 'NWT')) AS bailed_num,
               CAST(count(*) FILTER (contains(comment, 'NWT')) AS DOUBLE) / count(*) AS bailed_percentage
        FROM fact GROUP BY 1""",
    "player_cumulative": PLAYER_TABLE,
    "player_cumulative_step": PLAYER_TABLE + " WHERE current_season = (SELECT max(current_season) FROM years)",
    "actor_cumulative": ACTOR_TABLE,
    "actor_cumulative_step": ACTOR_TABLE + " WHERE current_year = (SELECT max(current_year) FROM actors)",
    "actor_films": f"""
        WITH {ACTORS} SELECT actorid, year, CAST(id AS VARCHAR) AS filmid, CAST(id % 1000 AS INTEGER) AS votes, rating FROM films""",
    "actor_scd2_backfill": f"""
        WITH {ACTORS}, starts AS (
          SELECT a.* FROM actors a LEFT JOIN actors b ON b.actorid = a.actorid AND b.current_year = a.current_year - 1
          WHERE b.actorid IS NULL OR b.quality_class <> a.quality_class OR b.is_active <> a.is_active),
        final AS (SELECT max(current_year) AS year FROM actors)
        SELECT s.actorid, 'actor ' || s.actorid AS actor, s.quality_class, s.is_active, s.current_year AS start_date,
               CAST(coalesce(min(n.current_year) - 1, any_value(year)) AS INTEGER) AS end_date, any_value(year) AS current_year
        FROM starts s CROSS JOIN final LEFT JOIN starts n ON n.actorid = s.actorid AND n.current_year > s.current_year
        GROUP BY ALL""",
    "scd2_backfill": SCD,
    "scd2_incremental": SCD,
    "history_ratio": f"""
        WITH {SEASONS}, ends AS (
          SELECT player, arg_max(pts, season) AS newest, arg_min(pts, season) AS oldest FROM seasons GROUP BY 1)
        SELECT player, newest / CASE WHEN oldest = 0 THEN 1 ELSE oldest END AS growth FROM ends WHERE newest > 20""",
    "history_rows": f"WITH {SEASONS} SELECT player, season, gp, pts FROM seasons",
    "graph_vertices": f"""
        WITH {GAMES}, {DETAILS}, {CAREERS}, {TEAMS}
        SELECT CAST(game_id AS VARCHAR) AS identifier, 'game' AS type,
               '{{"pts_home":' || pts_home || ',"pts_away":' || pts_away || ',"winning_team":'
                 || CASE WHEN home_team_wins = 1 THEN home_team_id ELSE visitor_team_id END || '}}' AS properties
        FROM games
        UNION ALL
        SELECT CAST(player_id AS VARCHAR), 'player',
               '{{"player_name":"' || player_name || '","number_of_games":' || number_of_games || ',"total_points":' || total_points || '}}'
        FROM careers c
        UNION ALL
        SELECT CAST(team_id AS VARCHAR), 'team',
               '{{"abbreviation":"' || abbreviation || '","nickname":"' || nickname || '","city":"' || city || '","arena":'
                 || coalesce('"' || arena || '"', 'null') || ',"year_founded":' || year_founded || '}}'
        FROM teams""",
    "team_vertex_map": f"""
        WITH {TEAMS}
        SELECT team_id AS identifier, 'team' AS type, property, value FROM (
          SELECT team_id, unnest(['abbreviation', 'nickname', 'city', 'arena', 'year_founded']) AS property,
                 unnest([abbreviation, nickname, city, arena, CAST(year_founded AS VARCHAR)]) AS value
          FROM teams)""",
    "graph_edges_in": f"""
        WITH {APPEARANCES}
        SELECT player_id AS subject_identifier, 'player' AS subject_type, game_id AS object_identifier,
               'game' AS object_type, 'plays_in' AS edge_type,
               '{{"start_position":"' || start_position || '","pts":' || pts || ',"team_id":' || team_id
                 || ',"team_abbreviation":"' || team_abbreviation || '"}}' AS properties
        FROM appearances""",
    "graph_edges_pair": f"""
        WITH {PAIRS}
        SELECT subject AS subject_identifier, 'player' AS subject_type, object AS object_identifier,
               'player' AS object_type, edge_type,
               '{{"num_games":' || num_games || ',"subject_points":' || subject_points || ',"object_points":' || object_points
                 || '}}' AS properties
        FROM pairs""",
    "graph_plays_for": f"""
        WITH {DETAILS}
        SELECT player_id AS subject_identifier, 'player' AS subject_type, team_id AS object_identifier, 'team' AS object_type,
               'plays_for' AS edge_type, '{{"num_games":' || count(*) || ',"points":' || CAST(sum(pts) AS BIGINT) || '}}' AS properties
        FROM details GROUP BY player_id, team_id""",
    "graph_tie_totals": f"""
        WITH {APPEARANCES}
        SELECT a.player_id, count(b.game_id) FILTER (a.team_abbreviation = b.team_abbreviation) AS teammates_met,
               CAST(coalesce(sum(b.pts) FILTER (a.team_abbreviation = b.team_abbreviation), 0) AS BIGINT) AS teammates_points,
               count(b.game_id) FILTER (a.team_abbreviation <> b.team_abbreviation) AS opponents_met,
               CAST(coalesce(sum(b.pts) FILTER (a.team_abbreviation <> b.team_abbreviation), 0) AS BIGINT) AS opponents_points
        FROM appearances a LEFT JOIN appearances b ON b.game_id = a.game_id AND b.player_id <> a.player_id GROUP BY 1""",
    "graph_max_points": f"""
        WITH {DETAILS}
        SELECT player_id, max(player_name) AS player_name, CAST(max(pts) AS INTEGER) AS max_pts FROM details GROUP BY 1""",
    "graph_traverse": f"""
        WITH {PAIRS}, {CAREERS}
        SELECT subject AS subject_identifier, player_name, object AS object_identifier,
               CAST(number_of_games AS DOUBLE) / CASE WHEN total_points = 0 THEN 1 ELSE total_points END AS games_per_point,
               subject_points, num_games
        FROM pairs JOIN careers ON player_id = subject""",
    "user_datelist": f"""
        WITH {days_of("user_id")}
        SELECT user_id, {joined("desc")} AS dates_active, CAST(date AS VARCHAR) AS date FROM lists""",
    "user_datelist_step": f"""
        WITH {days_of("user_id")}
        SELECT user_id, {joined("desc")} AS dates_active, CAST(date AS VARCHAR) AS date FROM lists WHERE date = {LAST_DAY}""",
    "device_datelist": f"""
        WITH {days_of("user_id", "browser_type")}
        SELECT user_id, browser_type, {joined("desc")} AS device_activity_datelist, CAST(date AS VARCHAR) AS date
        FROM lists WHERE date = {LAST_DAY}""",
    "device_datelist_map": f"""
        WITH {WEB} SELECT user_id, browser_type, count(DISTINCT day) AS num_days FROM web GROUP BY 1, 2""",
    "host_datelist": f"""
        WITH {days_of("host")}
        SELECT host, {joined("asc")} AS host_activity_datelist, CAST(date AS VARCHAR) AS date FROM lists""",
    "datelist_int": f"""
        WITH {MASK_ROWS}
        SELECT user_id, datelist_int, datelist_int_literal, lpad(bin(datelist_int), 32, '0') AS bits FROM masks""",
    "datelist_metrics": f"""
        WITH {MASK_ROWS}, counts AS (
          SELECT user_id, count(*) FILTER (age <= 31) AS l32, count(*) FILTER (age <= 6) AS l7,
                 count(*) FILTER (age BETWEEN 7 AND 13) AS before, count(*) FILTER (age = 0) AS today
          FROM active GROUP BY 1)
        SELECT user_id, datelist_int, l32 > 0 AS monthly_active, l32, l7 > 0 AS weekly_active, l7,
               before > 0 AS weekly_active_previous_week, today > 0 AS daily_active
        FROM counts JOIN masks USING (user_id)""",
    "array_metric": f"""
        WITH {USER_ARRAYS}
        SELECT user_id, CAST(month AS VARCHAR) AS month_start, 'site_hits' AS metric_name,
               string_agg(CAST(coalesce(hits, 0) AS VARCHAR), ',' ORDER BY day) AS metric_array
        FROM filled GROUP BY 1, 2""",
    "array_metric_step": f"""
        WITH {USER_ARRAYS}
        SELECT user_id, CAST(month AS VARCHAR) AS month_start,
               string_agg(CAST(coalesce(hits, 0) AS VARCHAR), ',' ORDER BY day) AS metric_array
        FROM filled WHERE month = (SELECT max(month) FROM months) GROUP BY 1, 2""",
    "monthly_hits": f"""
        WITH {USER_ARRAYS}
        SELECT user_id, CAST(month AS VARCHAR) AS month_start,
               string_agg(coalesce(CAST(hits AS VARCHAR), 'null'), ',' ORDER BY day) AS hit_array,
               CAST(min(first_day) AS VARCHAR) AS first_found_date
        FROM filled GROUP BY 1, 2""",
    "host_reduced": f"""
        WITH {arrays_of("host", "count(*) AS hits, count(DISTINCT user_id) AS visitors")}
        SELECT host, CAST(month AS VARCHAR) AS month,
               string_agg(CAST(coalesce(hits, 0) AS VARCHAR), ',' ORDER BY day) AS hits,
               string_agg(CAST(coalesce(visitors, 0) AS VARCHAR), ',' ORDER BY day) AS unique_visitors
        FROM filled GROUP BY 1, 2""",
    "array_explode": f"""
        WITH {WEB}, calendar AS (
          SELECT CAST(unnest(generate_series(date_trunc('month', min(day)), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM web)
        SELECT 'site_hits' AS metric_name, CAST(c.day AS VARCHAR) AS date, count(w.day) AS value
        FROM calendar c LEFT JOIN web w ON w.day = c.day GROUP BY 2""",
    "monthly_hits_sum": f"""
        WITH {WEB}
        SELECT CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS month_start,
               count(*) FILTER (day(day) = 1) AS num_hits_first_day, count(*) FILTER (day(day) = 2) AS num_hits_second_day,
               count(*) FILTER (day(day) = 3) AS num_hits_third_day
        FROM web GROUP BY 1""",
    "array_lengths": f"""
        WITH {USER_ARRAYS}
        SELECT CAST(days AS INTEGER) AS length, count(*) AS num_rows
        FROM (SELECT user_id, month, count(*) AS days FROM grid GROUP BY 1, 2) GROUP BY 1""",
    "growth_accounting": f"""
        WITH {GROWTH}
        SELECT user_id, CAST(first_active_date AS VARCHAR) AS first_active_date,
               CAST(last_active_date AS VARCHAR) AS last_active_date, daily_active_state, weekly_active_state,
               {joined("asc")} AS dates_active, CAST(date AS VARCHAR) AS date
        FROM growth""",
    "retention": f"""
        WITH {GROWTH}
        SELECT date - first_active_date AS days_since_first_active,
               CAST(count(*) FILTER (date = last_active_date) AS DOUBLE) / count(*) AS pct_active, count(*) AS num_rows
        FROM growth GROUP BY 1""",
    "state_change": states(False),
    "state_change_literal": states(True),
    "funnel_conversion": f"""
        WITH {WEB}, visits AS (SELECT DISTINCT user_id, day, ts, url FROM web),
        followed AS (
          SELECT a.user_id, a.ts, a.url, max(CASE WHEN b.url = '/signup' THEN 1 ELSE 0 END) AS converted
          FROM visits a JOIN visits b ON b.user_id = a.user_id AND b.day = a.day AND b.ts > a.ts
          GROUP BY 1, 2, 3)
        SELECT url, count(*) AS visits, CAST(sum(converted) AS DOUBLE) / count(*) AS conversion
        FROM followed GROUP BY 1 HAVING sum(converted) > 0 AND count(*) > 100""",
    "level_rollup": LEVELS,
    "leaders": f"""
        WITH {TEAM_GAMES},
        one_team AS (
          SELECT player_id, team_id, sum(pts) AS amount FROM details JOIN games USING (game_id) GROUP BY 1, 2
          ORDER BY amount DESC, player_id, team_id LIMIT 1),
        one_season AS (
          SELECT player_id, season, sum(pts) AS amount FROM details JOIN games USING (game_id) GROUP BY 1, 2
          ORDER BY amount DESC, player_id, season LIMIT 1),
        winner AS (SELECT team_id, sum(won) AS amount FROM team_games GROUP BY 1 ORDER BY amount DESC NULLS LAST, team_id LIMIT 1)
        SELECT 'most points for one team' AS query_type, player_id, team_id, CAST(NULL AS INTEGER) AS season,
               CAST(amount AS DOUBLE) AS amount FROM one_team
        UNION ALL SELECT 'most points in one season', player_id, NULL, season, CAST(amount AS DOUBLE) FROM one_season
        UNION ALL SELECT 'most games won', NULL, team_id, NULL, CAST(amount AS DOUBLE) FROM winner""",
    "contribution": f"""
        WITH {WEB}, daily AS (
          SELECT channel AS referrer, url, day, count(*) AS n, row_number() OVER (PARTITION BY channel, url ORDER BY day) AS rn
          FROM web WHERE channel IS NOT NULL GROUP BY 1, 2, 3)
        SELECT a.referrer, a.url, CAST(a.day AS VARCHAR) AS event_date, a.n AS count,
               CAST(sum(b.n) FILTER (b.rn <= a.rn) AS BIGINT) AS rolling_cumulative_sum,
               CAST(sum(b.n) FILTER (b.rn BETWEEN a.rn - 6 AND a.rn) AS BIGINT) AS weekly_rolling_count,
               CAST(sum(b.n) FILTER (b.rn BETWEEN a.rn - 13 AND a.rn - 7) AS BIGINT) AS previous_weekly_rolling_count,
               CAST(a.n AS DOUBLE) / sum(b.n) FILTER (date_trunc('month', b.day) = date_trunc('month', a.day)) AS pct_of_month,
               CAST(a.n AS DOUBLE) / sum(b.n) AS pct_of_total
        FROM daily a JOIN daily b ON b.referrer = a.referrer AND b.url = a.url
        GROUP BY a.referrer, a.url, a.day, a.n, a.rn HAVING sum(b.n) > 100""",
    "best_stretch": f"""
        WITH {TEAM_GAMES}, summed AS (
          SELECT team_id, sum(won) OVER (PARTITION BY team_id ORDER BY game_date_est, game_id
                                         ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS wins
          FROM team_games)
        SELECT team_id, CAST(max(wins) AS BIGINT) AS best FROM summed GROUP BY 1""",
    "longest_streak": f"""
        WITH {GAMES}, {APPEARANCES}, played AS (
          SELECT player_id, game_date_est, game_id, pts > 10 AS met,
                 row_number() OVER (PARTITION BY player_id ORDER BY game_date_est, game_id) AS rn
          FROM appearances JOIN games USING (game_id)),
        runs AS (
          SELECT player_id, count(*) AS n, min(game_date_est) AS first, max(game_date_est) AS last, min(rn) AS rn
          FROM (SELECT *, rn - row_number() OVER (PARTITION BY player_id ORDER BY rn) AS run FROM played WHERE met)
          GROUP BY player_id, run)
        SELECT player_id, n AS games_in_streak, CAST(first AS VARCHAR) AS streak_start, CAST(last AS VARCHAR) AS streak_end
        FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY n DESC, rn) AS pick FROM runs) WHERE pick = 1""",
    "match_leaders": """
        WITH kills AS (
          SELECT l_partkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(DISTINCT l_orderkey) AS v FROM lineitem GROUP BY 1),
        lists AS (SELECT o_orderpriority AS k, count(*) AS v FROM orders GROUP BY 1),
        maps AS (SELECT o_custkey % 25 AS k, count(*) AS v FROM orders GROUP BY 1),
        medals AS (
          SELECT o_custkey % 25 AS k, sum(l_linenumber) AS v
          FROM lineitem JOIN region ON r_regionkey = l_suppkey % 5 AND r_name = 'ASIA' JOIN orders ON o_orderkey = l_orderkey
          GROUP BY 1)
        SELECT * FROM (SELECT 'kills per game' AS query_type, CAST(k AS VARCHAR) AS winner, v AS amount FROM kills ORDER BY v DESC, k LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'most played playlist', k, CAST(v AS DOUBLE) FROM lists ORDER BY v DESC, k LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'most played map', CAST(k AS VARCHAR), CAST(v AS DOUBLE) FROM maps m ORDER BY v DESC, m.k LIMIT 1)
        UNION ALL SELECT * FROM (
          SELECT 'most medals on a map', CAST(k AS VARCHAR), CAST(v AS DOUBLE) FROM medals m ORDER BY v DESC, m.k LIMIT 1)""",
    "monthly_actives_top": monthly("coalesce(os_type, 'unknown') AS member", "true", 3).format("os_type"),
    "monthly_actives_by_referrer": monthly("channel AS member", "os_type IS NOT NULL", 10).format("referrer"),
    "actives_by_dim": f"WITH {WEB}"
    + ACTIVES.format("referrer", "channel")
    + "UNION ALL"
    + ACTIVES.format("os_type", "coalesce(os_type, 'unknown')")
    + "UNION ALL"
    + ACTIVES.format("browser_type", "browser_type"),
    "kpi_rollup": KPI,
    "events_devices": f"""
        WITH {WEB}
        SELECT user_id, device_id, upper(browser_type) AS browser_type, os_type, device_type,
               coalesce(referrer, 'unknown') AS referrer, host, url, {STAMP.format("ts")} AS event_time
        FROM web""",
    "events_left_devices": f"""
        WITH {WEB}
        SELECT CASE WHEN os_type IS NOT NULL THEN browser_type END AS browser_family, os_type AS os_family, count(*) AS num_events
        FROM web GROUP BY 1, 2""",
    "scalar_functions": f"""
        SELECT {BANDS.format("l_quantity")} AS pts_class, string_split(p_name, ' ')[1] AS first_word,
               l_returnflag = 'R' AS did_not_play, count(*) AS num_rows, count(*) FILTER (l_returnflag <> 'A') AS timed_rows,
               CAST(sum(CASE WHEN l_returnflag <> 'A' THEN floor(l_linenumber * 5 + CAST(l_quantity AS INTEGER) / 60) END) AS BIGINT)
                 AS whole_minutes
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
    "typed_pairs": """
        SELECT o_orderkey, o_orderpriority, c_custkey, lower(c_mktsegment) AS segment
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "user_devices": f"""
        WITH {WEB}, activity AS (SELECT user_id, device_id, count(*) AS n FROM web GROUP BY 1, 2)
        SELECT user_id, device_id, n AS event_counts, max(n) OVER (PARTITION BY user_id) AS total_hits FROM activity""",
    "device_users": f"""
        WITH {WEB} SELECT DISTINCT device_id, user_id, device_type FROM web""",
    "broadcast_enrich": """
        SELECT n_name, o_orderpriority AS playlist_id, count(*) AS plays
        FROM orders JOIN nation ON n_nationkey = o_custkey % 25 GROUP BY 1, 2""",
    "bucketed_join": """
        SELECT o_orderpriority, count(*) AS num_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS kills
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
    "bucketed_join_three": """
        SELECT o_orderpriority, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS kills,
               count(*) FILTER (l_returnflag = 'R') AS returned
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
    "table_upsert": f"""
        WITH {SEASONS}, last AS (SELECT max(season) AS y FROM seasons)
        SELECT player, season, CASE WHEN season >= y - 1 THEN gp + 1 ELSE gp END AS gp FROM seasons, last""",
    "csv_round_trip": "SELECT event_id, user_id, event_type, props FROM events",
    "partition_overwrite": f"""
        WITH {SEASONS}, last AS (SELECT max(season) AS y FROM seasons)
        SELECT player, CASE WHEN season = y THEN gp * 2 ELSE gp END AS gp, season FROM seasons, last""",
    "schema_quarantine": f"""
        WITH {WEB} SELECT url, device_id % 5 <> 0 AS conforms, count(*) AS num_rows FROM web WHERE url IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2""",
    "stream_tumbling": TUMBLING.format("host"),
    "stream_tumbling_2d": TUMBLING.format("host, referrer"),
    "stream_sessions": f"""
        WITH {SESSIONS}
        SELECT {SESSION_COLUMNS} FROM sessions
        WHERE session_end <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 15 SECOND) FROM web)""",
    "stream_enrich": f"""
        WITH {GEO}
        SELECT ip, {STAMP.format("ts")} AS event_timestamp, referrer, host, url, geodata FROM located""",
    "batch_sessions": f"WITH {SESSIONS} SELECT {SESSION_COLUMNS} FROM sessions",
    "session_stats": f"""
        WITH {SESSIONS}
        SELECT host, CAST(sum(num_events) AS DOUBLE) / count(*) AS avg_events_per_session, count(*) AS total_sessions
        FROM sessions GROUP BY 1""",
    "geo_enrich": f"WITH {GEO} SELECT event_id, ip, geodata FROM located",
    "by_country": f"WITH {GEO} SELECT country, count(*) AS num_events FROM located GROUP BY 1",
    "variant_assignment": f"""
        SELECT c_custkey AS user_id, {variant("button", "c_custkey", [(5000, "control")], "test")} AS button,
               {variant("onboarding", "c_custkey", [(3333, "control"), (6666, "test_a")], "test_b")} AS onboarding,
               {variant("reactions", "c_custkey", [(5000, "control"), (7500, "test_a")], "test_b")} AS reactions,
               {variant("store", "c_custkey", [(4000, "control"), (7000, "test_a")], "test_b")} AS store
        FROM customer""",
    "first_exposure": f"""
        WITH {WEB}, {EXPOSED}
        SELECT user_id, experiment, {STAMP.format("first_exposed_at")} AS first_exposed_at, variant FROM exposed""",
    "experiment_readout": f"""
        WITH {WEB}, users AS (
          SELECT user_id, count(*) FILTER (url = '/purchase') AS purchases, {ONBOARDING} AS variant FROM web GROUP BY user_id),
        stats AS (
          SELECT variant, count(*) AS n, CAST(sum(purchases) AS DOUBLE) / count(*) AS m, var_samp(purchases) AS v
          FROM users GROUP BY 1),
        paired AS (SELECT s.*, c.n AS cn, c.m AS cm, c.v AS cv FROM stats s JOIN stats c ON c.variant = 'control')
        SELECT 'onboarding' AS experiment, variant, n AS units, round(m, 8) AS mean, round(v, 8) AS variance,
               CASE WHEN variant <> 'control' THEN round((m - cm) / cm, 8) END AS lift,
               CASE WHEN variant <> 'control' THEN round((m - cm) / sqrt(v / n + cv / cn), 8) END AS z_score
        FROM paired""",
    "retention_readout": f"""
        WITH {WEB}, {EXPOSED}, kept AS (
          SELECT e.user_id, e.experiment, e.variant, max(w.day - CAST(e.first_exposed_at AS DATE)) AS gap
          FROM exposed e JOIN web w ON w.user_id = e.user_id GROUP BY 1, 2, 3)
        SELECT experiment, variant, count(*) AS units,
               CAST(count(*) FILTER (gap >= 7) AS DOUBLE) / count(*) AS retained_7d,
               CAST(count(*) FILTER (gap >= 30) AS DOUBLE) / count(*) AS retained_30d,
               CAST(count(*) FILTER (gap >= 60) AS DOUBLE) / count(*) AS retained_60d,
               CAST(count(*) FILTER (gap >= 90) AS DOUBLE) / count(*) AS retained_90d
        FROM kept GROUP BY 1, 2""",
    "freshness": f"""
        SELECT {STAMP.format("max(ts)")} AS latest, count(*) AS num_rows,
               max(ts) < (SELECT max(CAST(ts AS DATE)) FROM events) + 1 AS is_late, count(*) < 1000 AS is_short
        FROM events""",
    "schema_conformance": f"""
        WITH {WEB}
        SELECT 'user_id' AS "column", true AS present, count(*) FILTER (user_id IS NULL) AS missing_required, CAST(0 AS BIGINT) AS bad_values FROM web
        UNION ALL SELECT 'referrer', true, count(*) FILTER (referrer IS NULL), 0 FROM web
        UNION ALL SELECT 'url', true, 0, count(*) FILTER (try_cast(substr(url, 2) AS INTEGER) IS NULL) FROM web
        UNION ALL SELECT 'ip', true, 0, count(*) FILTER (try_cast(ip AS INTEGER) IS NULL) FROM web
        UNION ALL SELECT 'event_time', true, count(*) FILTER (ts IS NULL), 0 FROM web
        UNION ALL SELECT 'value', true, 0, count(*) FILTER (value IS NOT NULL) FROM web""",
    "volume_anomaly": f"""
        WITH {WEB}, daily AS (SELECT day, count(*) AS events, row_number() OVER (ORDER BY day) AS rn FROM web GROUP BY 1),
        recent AS (
          SELECT a.day, a.events, avg(b.events) AS m, stddev_samp(b.events) AS s
          FROM daily a LEFT JOIN daily b ON b.rn BETWEEN a.rn - 7 AND a.rn - 1 GROUP BY 1, 2)
        SELECT CAST(day AS VARCHAR) AS date, events, round(m, 8) AS trailing_mean, round(s, 8) AS trailing_std,
               CASE WHEN s > 0 THEN round((events - m) / s, 8) END AS z_score,
               coalesce(s > 0 AND abs((events - m) / s) > 2, false) AS is_anomaly
        FROM recent""",
    "reconcile": f"""
        WITH {WEB}
        SELECT CAST(day AS VARCHAR) AS date, count(*) AS left_value, count(referrer) AS right_value,
               count(*) - count(referrer) AS difference
        FROM web GROUP BY 1 HAVING count(*) <> count(referrer)""",
    "key_checks": """
        WITH counts AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2)
        SELECT CAST(sum(n) AS BIGINT) AS num_rows,
               CAST(coalesce(sum(n) FILTER (l_orderkey IS NULL OR l_partkey IS NULL), 0) AS BIGINT) AS null_keys,
               count(*) FILTER (n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM counts""",
    "missing_periods": f"""
        WITH {SEASONS}, spans AS (SELECT player, min(season) AS low, max(season) AS high FROM seasons GROUP BY 1),
        full_grid AS (SELECT player, CAST(unnest(generate_series(low, high)) AS INTEGER) AS season FROM spans)
        SELECT player, season FROM full_grid g
        WHERE NOT EXISTS (SELECT 1 FROM seasons s WHERE s.player = g.player AND s.season = g.season)""",
}

# Steps give the last period of their table.
ORACLES |= {
    "growth_step": f"SELECT * FROM ({ORACLES['growth_accounting']}) g WHERE date = (SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events)",
    "state_change_step": f"SELECT * FROM ({ORACLES['state_change']}) s WHERE current_season = (SELECT year(max(o_orderdate)) FROM orders)",
    "device_datelist_step": ORACLES["device_datelist"],
    "stream_parsed": ORACLES["stream_tumbling"],
    "layout_compare": """
        SELECT layout, CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS num_rows,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem, (VALUES ('sorted'), ('unsorted')) v (layout) GROUP BY 1, 2""",
}

_RUNS = "max(run{0}) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
ORACLES["funnel_steps"] = f"""
    WITH {WEB}, s1 AS (
      SELECT user_id, ts, bool_or(url = '/view') AS is1, bool_or(url = '/click') AS is2, bool_or(url = '/signup') AS is3,
             bool_or(url = '/purchase') AS is4, CASE WHEN is1 THEN ts END AS run1 FROM web WHERE url <> '/error' GROUP BY 1, 2),
    s2 AS (SELECT *, {_RUNS.format(1)} AS b2, CASE WHEN is2 AND b2 >= ts - INTERVAL 1 DAY THEN b2 END AS run2 FROM s1),
    s3 AS (SELECT *, {_RUNS.format(2)} AS b3, CASE WHEN is3 AND b3 >= ts - INTERVAL 1 DAY THEN b3 END AS run3 FROM s2),
    s4 AS (SELECT *, {_RUNS.format(3)} AS b4, CASE WHEN is4 AND b4 >= ts - INTERVAL 1 DAY THEN b4 END AS run4 FROM s3),
    furthest AS (
      SELECT user_id, CASE WHEN count(run4) > 0 THEN 4 WHEN count(run3) > 0 THEN 3 WHEN count(run2) > 0 THEN 2
        WHEN count(run1) > 0 THEN 1 END AS step FROM s4 GROUP BY 1),
    steps (step, name) AS (VALUES (1, 'view'), (2, 'click'), (3, 'signup'), (4, 'purchase')),
    reached AS (SELECT s.step, name, count(*) AS users FROM steps s JOIN furthest f ON f.step >= s.step GROUP BY 1, 2)
    SELECT step, name, users, users / CAST((SELECT users FROM reached WHERE step = 1) AS DOUBLE) AS share FROM reached"""
ORACLES["point_in_time"] = f"""
    WITH scd AS ({SCD})
    SELECT o_orderkey AS order_id, o_custkey AS player, CAST(year(o_orderdate) AS INTEGER) AS season, scoring_class, is_active
    FROM orders LEFT JOIN scd ON player = o_custkey AND year(o_orderdate) BETWEEN start_season AND end_season"""
ORACLES["history_deltas"] = PLAYER_TABLE
ORACLES["actives_merged"] = f"""
    WITH {WEB}
    SELECT CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month, url, count(DISTINCT user_id) AS users FROM web GROUP BY 1, 2"""
ORACLES["actives_trailing"] = f"""
    WITH {WEB}, days AS (SELECT DISTINCT day + CAST(n AS INTEGER) AS day FROM web, range(7) t (n))
    SELECT CAST(d.day AS VARCHAR) AS day, host, count(DISTINCT user_id) AS users
    FROM days d JOIN web w ON w.day BETWEEN d.day - 6 AND d.day WHERE d.day <= (SELECT max(day) FROM web) GROUP BY 1, 2"""
ORACLES["keyed_upsert"] = f"""
    WITH {SEASONS} SELECT player, season, gp, pts, c_name AS player_name FROM seasons JOIN customer ON c_custkey = player"""
_ARRIVED = """
parts AS (SELECT *, least((day(ts) - 1) // 8, 3) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS part FROM web),
marks AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM parts GROUP BY 1),
judged AS (SELECT p.*, coalesce(ts < mark - INTERVAL 15 SECOND, false) AS late FROM parts p JOIN marks USING (part))"""
ORACLES["stream_late_rows"] = f"""
    WITH {WEB}, {_ARRIVED}
    SELECT event_id, user_id, host, {STAMP.format("ts")} AS event_timestamp FROM judged WHERE late"""
ORACLES["stream_all_sessions"] = f"""
    WITH {WEB}, {_ARRIVED}, {SESSIONS.replace(WEB + ",", "").replace("FROM web)", "FROM judged WHERE NOT late)")}
    SELECT {SESSION_COLUMNS}, session_end >= (SELECT max(ts) - INTERVAL 15 SECOND FROM web) AS is_open FROM sessions"""


def _poisson(unit: str, replicate: str, seed: str) -> str:
    """Sum of the steps at which the distribution function of Poisson(1) passes a uniform hash."""
    uniform = f"CAST('0x' || substr(md5('{seed}:' || {replicate} || ':' || {unit}), 1, 8) AS UBIGINT)"
    seen, term, steps = 0.0, math.exp(-1), []
    for k in range(1, 10):
        seen += term
        steps.append(f"CASE WHEN {uniform} >= {int(seen * (1 << 32))} THEN 1 ELSE 0 END")
        term /= k
    return " + ".join(steps)


ORACLES["prefix_lookup"] = f"""
    WITH {WEB}, prefixes AS (
      SELECT 167772160 + n_nationkey * 524288 AS low, 524288 AS size, n_name AS place FROM nation
      UNION ALL SELECT 167772160 + (n_nationkey * 8 + n_nationkey % 8) * 65536, 65536, n_name || ' city' FROM nation
      UNION ALL SELECT 167772160 + (n_nationkey * 8 + n_nationkey % 8) * 65536, 256, n_name || ' street' FROM nation WHERE n_nationkey % 2 = 0)
    SELECT event_id, ip, arg_min(place, size) AS place FROM web LEFT JOIN prefixes ON ip_number >= low AND ip_number < low + size GROUP BY 1, 2"""
ORACLES["layout_skipping"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem
    WHERE l_partkey BETWEEN (SELECT max(l_partkey) FROM lineitem) // 4 AND (SELECT max(l_partkey) FROM lineitem) // 2
      AND CAST(l_shipdate AS DATE) BETWEEN (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 400 AND (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 200"""
ORACLES["differing_keys"] = f"""
    WITH {SEASONS}
    SELECT player, season, CASE WHEN player % 50 = 7 THEN 'left' ELSE 'changed' END AS kind FROM seasons WHERE player % 50 = 7 OR player % 31 = 3
    UNION ALL SELECT player, season + 100, 'right' FROM seasons WHERE player % 41 = 5"""
ORACLES["bootstrap_readout"] = f"""
    WITH {WEB}, users AS (
      SELECT user_id, count(*) FILTER (url = '/purchase') AS y, count(*) FILTER (url = '/click') AS x, {ONBOARDING} AS variant
      FROM web WHERE user_id IS NOT NULL GROUP BY user_id),
    drawn AS (SELECT *, CASE WHEN r = 0 THEN 1 ELSE {_poisson("user_id", "r", "bootstrap")} END AS w FROM users, range(101) t (r)),
    sums AS (SELECT variant, r, CAST(sum(w) AS DOUBLE) AS n, CAST(sum(w * y) AS DOUBLE) AS y, CAST(sum(w * x) AS DOUBLE) AS x,
      CAST(sum(w * x * y) AS DOUBLE) AS xy, CAST(sum(w * x * x) AS DOUBLE) AS xx FROM drawn GROUP BY ALL),
    slope AS (SELECT (sum(xy) - sum(x) * sum(y) / sum(n)) / (sum(xx) - sum(x) * sum(x) / sum(n)) AS b FROM sums WHERE r = 0),
    apart AS (SELECT s.variant, s.r, s.n, s.y / s.n - c.y / c.n AS difference, s.y / s.n - c.y / c.n - b * (s.x / s.n - c.x / c.n) AS adjusted
      FROM sums s JOIN sums c ON c.r = s.r AND c.variant = 'control' CROSS JOIN slope WHERE s.variant <> 'control')
    SELECT 'onboarding' AS experiment, variant, CAST(max(n) FILTER (r = 0) AS BIGINT) AS units, round(max(difference) FILTER (r = 0), 8) AS difference,
           round(max(adjusted) FILTER (r = 0), 8) AS adjusted, round(quantile_cont(adjusted, 0.025) FILTER (r > 0), 8) AS low,
           round(quantile_cont(adjusted, 0.975) FILTER (r > 0), 8) AS high FROM apart GROUP BY variant"""
ORACLES["bucketed_join_heavy"] = """
    WITH lines AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS part, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem),
    parts AS (SELECT p_partkey AS part, p_partkey % 7 AS kind FROM part WHERE p_partkey <> 0 UNION ALL SELECT 0, 99)
    SELECT kind, count(*) AS num_rows, CAST(sum(quantity) AS BIGINT) AS quantity FROM lines JOIN parts USING (part) GROUP BY 1"""
ORACLES["history_repair"] = PLAYER_TABLE

