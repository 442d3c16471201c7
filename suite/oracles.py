"""The same queries in DuckDB SQL.

Ratios are rounded with integer arithmetic here and with decimals in Spark, so the two
sides do not share a rounding method. ``PARTS`` are named subqueries; a statement lists the
ones it needs and gets their prerequisites as well.
"""

from __future__ import annotations

LEAGUE, SEASON = "R1", 1996

# -- building blocks -------------------------------------------------------------------


def two(a: str, b: str) -> str:
    """a / b, half up to two places."""
    return f"((200*({a})+({b}))//(2*({b})))::DOUBLE/100"


def pct(a: str, b: str) -> str:
    """100 a / b, half up to one place."""
    return f"((2000*({a})+({b}))//(2*({b})))::DOUBLE/10"


def n_if(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


def total(value: str) -> str:
    return f"CAST(SUM({value}) AS BIGINT)"


def season_of(day: str, cut: int = 7) -> str:
    return f"(year({day}) - CASE WHEN month({day}) < {cut} THEN 1 ELSE 0 END)"


def within(season: int) -> str:
    return f"match_date >= DATE '{season}-07-01' AND match_date < DATE '{season + 1}-07-01'"


PARTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (sql, needs)


def statement(body: str, *needs: str, recursive: bool = False) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for need in PARTS[name][1]:
                visit(need)
            ordered.append(name)

    for need in needs:
        visit(need)
    if not ordered:
        return body
    named = ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{named}\n{body}"


part(
    "raw_matches",
    f"""
    SELECT o_orderkey AS id, CAST(h.n_regionkey AS BIGINT) AS competition_id,
      CAST(h.n_regionkey AS BIGINT) * 10000 + {season_of('o_orderdate')} AS season_id,
      o_orderdate AS utc_date,
      CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'SCHEDULED' ELSE 'IN_PLAY' END AS status,
      CAST(date_diff('day', make_date({season_of('o_orderdate')}, 7, 1), o_orderdate::DATE) // 7 + 1 AS INTEGER)
        AS matchday,
      CAST(h.n_nationkey AS BIGINT) AS home_team_id, h.n_name AS home_team_name,
      CAST(a.n_nationkey AS BIGINT) AS away_team_id, a.n_name AS away_team_name,
      hf AS home_score_full_time, af AS away_score_full_time,
      hh AS home_score_half_time, ah AS away_score_half_time,
      CASE WHEN hf > af THEN 'HOME_TEAM' WHEN af > hf THEN 'AWAY_TEAM' ELSE 'DRAW' END AS winner,
      o_orderdate AS ingested_at
    FROM orders
    JOIN (SELECT l_orderkey, MIN(l_suppkey) AS away_key,
            CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS hf,
            CAST(COUNT(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS af,
            CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber <= 3) AS INTEGER) AS hh,
            CAST(COUNT(*) FILTER (WHERE l_returnflag = 'A' AND l_linenumber <= 3) AS INTEGER) AS ah
          FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation h ON h.n_nationkey = c_nationkey
    JOIN supplier ON s_suppkey = away_key JOIN nation a ON a.n_nationkey = s_nationkey
    WHERE h.n_nationkey <> a.n_nationkey""",
)
part(
    "comps",
    """
    SELECT CAST(r_regionkey AS BIGINT) AS competition_id, r_name AS competition_name,
      'R' || r_regionkey AS competition_code, 'LEAGUE' AS competition_type, r_name AS area_name,
      'TIER_ONE' AS plan, TIMESTAMP '2001-09-01' AS ingested_at FROM region""",
)
part(
    "raw_teams",
    """
    SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 'N' || n_nationkey AS short_name,
      upper(right(n_name, 3)) AS tla, CAST(n_regionkey AS BIGINT) AS competition_id, r_name AS area_name,
      TIMESTAMP '2001-09-01' AS ingested_at FROM nation JOIN region ON r_regionkey = n_regionkey""",
)
part(
    "stg",
    """
    SELECT id AS match_id, competition_id, season_id, utc_date::DATE AS match_date, utc_date AS match_datetime,
      status, matchday, home_team_id, home_team_name, away_team_id, away_team_name,
      home_score_full_time AS home_goals, away_score_full_time AS away_goals,
      home_score_half_time AS home_goals_ht, away_score_half_time AS away_goals_ht,
      CASE sign(home_score_full_time - away_score_full_time) WHEN 1 THEN 'home' WHEN -1 THEN 'away'
        WHEN 0 THEN 'draw' END AS result, winner, ingested_at
    FROM raw_matches WHERE status = 'FINISHED'""",
    "raw_matches",
)
part(
    "mart",
    """
    SELECT match_id, match_date, matchday, season_id, competition_id, competition_name, competition_code,
      home_team_id, home_team_name, away_team_id, away_team_name, home_goals, away_goals,
      home_goals_ht, away_goals_ht, home_goals + away_goals AS total_goals, home_goals - away_goals AS goal_diff,
      home_goals_ht + away_goals_ht AS total_goals_ht, result,
      CASE sign(home_goals_ht - away_goals_ht) WHEN 1 THEN 'home' WHEN -1 THEN 'away' WHEN 0 THEN 'draw' END
        AS ht_leader,
      home_goals + away_goals > 3 AS is_high_scoring,
      home_goals_ht <> away_goals_ht AND sign(home_goals_ht - away_goals_ht) <> sign(home_goals - away_goals)
        AS is_ht_lead_dropped
    FROM stg LEFT JOIN (SELECT competition_id, competition_name, competition_code FROM comps) USING (competition_id)""",
    "stg", "comps",
)
part(
    "legs",
    """
    SELECT match_id, match_date, competition_id, competition_code, competition_name, season_id, 'home' AS venue,
      home_team_id AS team_id, home_team_name AS team_name, away_team_id AS opponent_id,
      away_team_name AS opponent_name, home_goals AS goals_scored, away_goals AS goals_conceded,
      CASE result WHEN 'home' THEN 'win' WHEN 'away' THEN 'loss' ELSE result END AS team_result,
      CASE result WHEN 'home' THEN 3 WHEN 'draw' THEN 1 ELSE 0 END AS points_earned, result
    FROM mart
    UNION ALL
    SELECT match_id, match_date, competition_id, competition_code, competition_name, season_id, 'away',
      away_team_id, away_team_name, home_team_id, home_team_name, away_goals, home_goals,
      CASE result WHEN 'away' THEN 'win' WHEN 'home' THEN 'loss' ELSE result END,
      CASE result WHEN 'away' THEN 3 WHEN 'draw' THEN 1 ELSE 0 END, result
    FROM mart""",
    "mart",
)

TABLE_LINE = f"""COUNT(*) AS played_games, {n_if("team_result = 'win'")} AS won,
      {n_if("team_result = 'draw'")} AS draw, {n_if("team_result = 'loss'")} AS lost,
      {total('goals_scored')} AS goals_for, {total('goals_conceded')} AS goals_against,
      {total('goals_scored - goals_conceded')} AS goal_difference, {total('points_earned')} AS points,
      {two('SUM(points_earned)', 'COUNT(*)')} AS points_per_game,
      {pct("COUNT(*) FILTER (WHERE team_result = 'win')", 'COUNT(*)')} AS win_percentage,
      {two('SUM(goals_scored)', 'COUNT(*)')} AS goals_per_game,
      {two('SUM(goals_conceded)', 'COUNT(*)')} AS conceded_per_game"""
BY_POINTS = "ORDER BY points DESC, goal_difference DESC, goals_for DESC"

part(
    "tables",
    f"""
    SELECT CAST(RANK() OVER (PARTITION BY competition_code, season_id {BY_POINTS}) AS INTEGER) AS position, *
    FROM (SELECT competition_code, season_id, team_name, {TABLE_LINE} FROM legs
          GROUP BY competition_code, season_id, team_name)""",
    "legs",
)
part(
    "league",
    """
    SELECT c.competition_id, season_id, competition_name, competition_code, position, team_name, played_games,
      won, draw, lost, goals_for, goals_against, goal_difference, points, points_per_game, win_percentage,
      goals_per_game, conceded_per_game FROM tables JOIN comps c USING (competition_code)""",
    "tables", "comps",
)
part(
    "bottlers",
    f"""
    SELECT competition_id, competition_code, competition_name, season_id,
      CASE ht_leader WHEN 'home' THEN home_team_id ELSE away_team_id END AS team_id,
      CASE ht_leader WHEN 'home' THEN home_team_name ELSE away_team_name END AS team_name,
      COUNT(*) AS matches_leading_ht, {n_if('is_ht_lead_dropped')} AS leads_dropped,
      {pct('COUNT(*) FILTER (WHERE is_ht_lead_dropped)', 'COUNT(*)')} AS drop_rate_pct
    FROM mart WHERE ht_leader <> 'draw' GROUP BY ALL HAVING COUNT(*) >= 3""",
    "mart",
)
part(
    "form",
    """
    SELECT match_id, match_date, competition_id, season_id, team_id, team_name, goals_scored, goals_conceded,
      team_result, points_earned,
      CAST(SUM(points_earned) OVER (PARTITION BY team_id, competition_id ORDER BY match_date, match_id
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS form_points_last5,
      ROW_NUMBER() OVER (PARTITION BY team_id, competition_id ORDER BY match_date DESC, match_id DESC)
        AS match_recency_rank
    FROM legs""",
    "legs",
)
part(
    "reports",
    """
    SELECT doc_id AS id, doc_id AS match_id, competition_code, home_team_name AS home_team,
      away_team_name AS away_team, match_date, matchday, text AS narrative
    FROM documents LEFT JOIN mart ON match_id = doc_id""",
    "mart",
)


def one_team(like: str | None = None, team_id: int | None = None) -> str:
    """Matches seen from one team; home counts when a pattern fits both sides."""
    if like is not None:
        home, away = f"home_team_name ILIKE '%{like}%'", f"away_team_name ILIKE '%{like}%'"
    else:
        home, away = f"home_team_id = {team_id}", f"away_team_id = {team_id}"
    return f"""
    SELECT match_id, match_date, competition_code,
      CASE WHEN {home} THEN away_team_name ELSE home_team_name END AS opponent,
      CASE WHEN {home} THEN 'home' ELSE 'away' END AS venue, home_goals, away_goals,
      CASE WHEN {home} THEN home_goals ELSE away_goals END AS goals_scored,
      CASE WHEN {home} THEN away_goals ELSE home_goals END AS goals_conceded, result,
      CASE WHEN ({home} AND result = 'home') OR ({away} AND result = 'away') THEN 'W'
           WHEN result = 'draw' THEN 'D' ELSE 'L' END AS team_result
    FROM mart WHERE ({home} OR {away})"""


def splits(matches: str) -> str:
    def zero(value: str) -> str:
        return f"COALESCE({value}, 0)"

    won, drawn = "COUNT(*) FILTER (WHERE team_result = 'W')", "COUNT(*) FILTER (WHERE team_result = 'D')"
    n = "NULLIF(COUNT(match_id), 0)"
    won_n, drawn_n = f"({won})", f"({drawn})"
    return f"""
    SELECT split, CAST(COUNT(match_id) AS BIGINT) AS played, CAST({won} AS BIGINT) AS won,
      CAST({drawn} AS BIGINT) AS drawn, {n_if("team_result = 'L'")} AS lost,
      CAST({zero('SUM(goals_scored)')} AS BIGINT) AS goals_for,
      CAST({zero('SUM(goals_conceded)')} AS BIGINT) AS goals_against,
      CAST({zero('SUM(goals_scored - goals_conceded)')} AS BIGINT) AS goal_difference,
      CAST(3*{won_n}+{drawn_n} AS BIGINT) AS points,
      {zero(two(f'3*{won_n}+{drawn_n}', n))} AS points_per_game,
      {zero(pct(won_n, n))} AS win_percentage,
      {zero(two('SUM(goals_scored)', n))} AS goals_per_game,
      {zero(two('SUM(goals_conceded)', n))} AS conceded_per_game
    FROM (VALUES ('aggregate'), ('home'), ('away')) AS s(split)
    LEFT JOIN ({matches}) m ON split IN ('aggregate', venue) GROUP BY split"""


# Blanks as a regular expression class, spelled out because the engine's \s is ASCII only.
BLANK = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def chunk_parts(prefix: str, source: str, keys: str, text: str, size: int) -> None:
    """Sentences of a text packed one after the other by a recursive query."""
    trimmed = f"regexp_replace(regexp_replace({text}, '^{BLANK}+', ''), '{BLANK}+$', '')"
    part(
        f"{prefix}_sentences",
        f"""SELECT {keys}, string_split(regexp_replace({trimmed}, '([.!?]){BLANK}+', '\\1' || chr(1), 'g'), chr(1))
        AS s FROM {source}""",
    )
    joined = " AND ".join(f"f.{k.strip()} = t.{k.strip()}" for k in keys.split(","))
    own = ", ".join(f"f.{k.strip()}" for k in keys.split(","))
    fits = f"length(f.cur) + length(t.s[f.i + 1]) + 1 <= {size}"
    part(
        f"{prefix}_fold",
        f"""SELECT {keys}, 1 AS i, 0 AS idx, s[1] AS cur FROM {prefix}_sentences WHERE s[1] <> ''
        UNION ALL
        SELECT {own}, f.i + 1, CASE WHEN {fits} THEN f.idx ELSE f.idx + 1 END,
          CASE WHEN {fits} THEN f.cur || ' ' || t.s[f.i + 1] ELSE t.s[f.i + 1] END
        FROM {prefix}_fold f JOIN {prefix}_sentences t ON {joined} WHERE f.i < len(t.s)""",
        f"{prefix}_sentences",
    )
    part(
        f"{prefix}_chunks",
        f"""SELECT {keys}, CAST(idx AS INTEGER) AS chunk_index, arg_max(cur, i) AS chunk_text
        FROM {prefix}_fold GROUP BY {keys}, idx""",
        f"{prefix}_fold",
    )


chunk_parts("d3", "documents", "doc_id", "text", 300)
chunk_parts("d6", "documents", "doc_id", "text", 600)
chunk_parts("cv", "conversations", "conv_id, turn", "text", 120)

part(
    "scores",
    """
    SELECT q.vec_id AS query_id, e.vec_id AS report_id, 0 AS chunk_index,
      round(list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[])
        / (sqrt(list_inner_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))
         * sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]))), 6) AS similarity
    FROM embeddings e, embeddings q WHERE q.vec_id BETWEEN 0 AND 99""",
)


def search(threshold: float, limit: int) -> str:
    return f"""
    SELECT query_id, report_id, s.chunk_index, chunk_text, home_team, away_team, match_date, competition_code,
      matchday, similarity
    FROM scores s JOIN reports r ON r.id = s.report_id
    LEFT JOIN d3_chunks c ON c.doc_id = s.report_id AND c.chunk_index = s.chunk_index
    WHERE similarity >= {threshold}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, report_id, s.chunk_index) <= {limit}"""


part(
    "features",
    """
    SELECT team_name, competition_code, season_id, competition_name, played_games, points, points_per_game,
      win_percentage, goals_per_game, conceded_per_game, goal_difference,
      sp::DOUBLE / (100*n)::DOUBLE AS league_avg_ppg, sg::DOUBLE / (100*n)::DOUBLE AS league_avg_goals,
      sc::DOUBLE / (100*n)::DOUBLE AS league_avg_conceded,
      sqrt((n*qp - sp*sp)::DOUBLE / nullif(n*(n-1), 0)::DOUBLE) / 100 AS stddev_ppg,
      sqrt((n*qg - sg*sg)::DOUBLE / nullif(n*(n-1), 0)::DOUBLE) / 100 AS stddev_goals,
      sqrt((n*qc - sc*sc)::DOUBLE / nullif(n*(n-1), 0)::DOUBLE) / 100 AS stddev_conceded
    FROM (SELECT *, COUNT(*) OVER w AS n, SUM(p) OVER w AS sp, SUM(g) OVER w AS sg, SUM(c) OVER w AS sc,
            SUM(p*p) OVER w AS qp, SUM(g*g) OVER w AS qg, SUM(c*c) OVER w AS qc
          FROM (SELECT *, CAST(round(points_per_game*100) AS BIGINT) AS p,
                  CAST(round(goals_per_game*100) AS BIGINT) AS g,
                  CAST(round(conceded_per_game*100) AS BIGINT) AS c FROM league)
          WINDOW w AS (PARTITION BY competition_code, season_id))""",
    "league",
)


def decimals(hundredths: str) -> str:
    return f"printf('%d.%02d', CAST({hundredths} AS BIGINT) // 100, CAST({hundredths} AS BIGINT) % 100)"


part(
    "flags",
    f"""
    WITH z AS (
      SELECT *, COALESCE((points_per_game - league_avg_ppg) / nullif(stddev_ppg, 0), 0) AS z_ppg,
        COALESCE((goals_per_game - league_avg_goals) / nullif(stddev_goals, 0), 0) AS z_goals,
        COALESCE((conceded_per_game - league_avg_conceded) / nullif(stddev_conceded, 0), 0) AS z_conceded
      FROM features),
    m AS (
      SELECT *, greatest(abs(z_ppg), abs(z_goals), abs(z_conceded)) AS big,
        CASE greatest(abs(z_ppg), abs(z_goals), abs(z_conceded)) WHEN abs(z_ppg) THEN 1 WHEN abs(z_goals) THEN 2
          ELSE 3 END AS pick FROM z),
    v AS (
      SELECT *, ['points_per_game', 'goals_per_game', 'conceded_per_game'][pick] AS key_metric,
        [points_per_game, goals_per_game, conceded_per_game][pick] AS val,
        [league_avg_ppg, league_avg_goals, league_avg_conceded][pick] AS mean,
        CASE WHEN big >= 2.5 THEN 'high' WHEN big >= 2 THEN 'medium' WHEN big >= 1.5 THEN 'low' ELSE 'none' END
          AS severity FROM m)
    SELECT team_name, competition_code, season_id, points, points_per_game, z_ppg, z_goals, z_conceded,
      severity <> 'none' AS is_anomalous,
      CASE WHEN severity = 'none' THEN 'none' WHEN pick = 2 THEN 'attacking_outlier'
        WHEN pick = 3 THEN 'defensive_outlier' WHEN z_ppg > 0 THEN 'overperforming' ELSE 'underperforming' END
        AS anomaly_type, severity, key_metric,
      team_name || ': ' || replace(key_metric, '_', ' ') || ' of ' || {decimals('round(val*100)')}
        || ' against a league average of '
        || {decimals('(CAST(round(mean*1000000) AS BIGINT) + 5000) // 10000')}
        || ' (severity ' || severity || ').' AS explanation
    FROM v""",
    "features",
)
part(
    "pairs",
    """
    SELECT u.conv_id, u.turn + 1 AS turn, u.text AS question, a.text AS response, string_split(u.text, ' ')[1] AS expected,
      string_split(u.text, ' ')[-1] AS forbidden
    FROM conversations u LEFT JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    WHERE u.role = 'user'""",
)
part(
    "golden",
    """
    SELECT conv_id, turn, question, CASE WHEN response IS NULL THEN ['no response'] ELSE list_filter([
      CASE WHEN NOT contains(lower(response), lower(expected)) THEN 'missing expected text: ''' || expected || '''' END,
      CASE WHEN contains(lower(response), lower(forbidden)) THEN 'contains forbidden text: ''' || forbidden || '''' END,
      CASE WHEN contains(question, '?') AND NOT regexp_matches(response, '[0-9]')
        THEN 'no number found in response' END,
      CASE WHEN length(question) < 60 AND NOT regexp_matches(lower(response),
          'don''t have|cannot|not available|outside|only covers|no data|not in|limited to')
        THEN 'expected graceful refusal but agent answered directly' END], lambda r: r IS NOT NULL) END AS reasons
    FROM pairs""",
    "pairs",
)

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
part(
    "phrases",
    f"""
    SELECT event_id, CASE event_type WHEN 'click' THEN 1996 WHEN 'view' THEN 1996 - {K}
      WHEN 'purchase' THEN 2000 + CASE WHEN {K} > 99 THEN {K} // 10 ELSE {K} END
      WHEN 'signup' THEN 1995 ELSE 1996 END AS start FROM events""",
)

# -- statements ------------------------------------------------------------------------

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str, recursive: bool = False) -> None:
    ORACLES[name] = statement(body, *needs, recursive=recursive)


oracle(
    "src_competitions",
    "SELECT competition_id AS id, competition_name AS name, competition_code AS code, competition_type AS type,"
    " area_name, plan FROM comps", "comps",
)
oracle("src_teams", "SELECT id, name, short_name, tla, competition_id, area_name FROM raw_teams", "raw_teams")


def landed(columns: str = "") -> str:
    def score(c: str) -> str:
        return f"CASE WHEN status <> 'SCHEDULED' THEN {c} END AS {c}"

    fields = ", ".join(
        score(c)
        for c in ("home_score_full_time", "away_score_full_time", "home_score_half_time", "away_score_half_time", "winner")
    )
    return f"""SELECT id, competition_id, season_id, utc_date, status, matchday, home_team_id, home_team_name,
      away_team_id, away_team_name, {fields} FROM raw_matches"""


oracle("src_matches", landed(), "raw_matches")
oracle("stream_ingest_upsert", landed(), "raw_matches")
oracle(
    "stream_dedup_late",
    "SELECT id, 'SCHEDULED' AS status FROM raw_matches"
    " UNION ALL SELECT id, status FROM raw_matches WHERE status <> 'SCHEDULED'",
    "raw_matches",
)
oracle(
    "src_standings",
    """SELECT l.competition_id, season_id, 'REGULAR_SEASON' AS stage, kind AS type, n.id AS team_id, team_name,
      position, CASE kind WHEN 'TOTAL' THEN CAST(played_games AS INTEGER) END AS played_games,
      CASE kind WHEN 'TOTAL' THEN CAST(won AS INTEGER) END AS won,
      CASE kind WHEN 'TOTAL' THEN CAST(draw AS INTEGER) END AS draw,
      CASE kind WHEN 'TOTAL' THEN CAST(lost AS INTEGER) END AS lost, CAST(points AS INTEGER) AS points,
      CASE kind WHEN 'TOTAL' THEN CAST(goals_for AS INTEGER) END AS goals_for,
      CASE kind WHEN 'TOTAL' THEN CAST(goals_against AS INTEGER) END AS goals_against,
      CASE kind WHEN 'TOTAL' THEN CAST(goal_difference AS INTEGER) END AS goal_difference,
      table_no, 0 AS row_no
    FROM league l JOIN raw_teams n ON n.name = team_name,
      (VALUES ('TOTAL', 0), ('HOME', 1)) AS k(kind, table_no)""",
    "league", "raw_teams",
)
oracle(
    "src_players",
    """SELECT c_custkey AS id, c_name AS name, string_split(c_name, '#')[1] AS first_name,
      string_split(c_name, '#')[-1] AS last_name,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) END
        AS date_of_birth, 'N' || c_nationkey AS nationality, c_mktsegment AS position,
      CAST(c_custkey % 99 + 1 AS INTEGER) AS shirt_number, CAST(c_nationkey AS BIGINT) AS team_id FROM customer""",
)
oracle(
    "scan_window",
    "SELECT id, utc_date, status FROM raw_matches WHERE utc_date >= '1995-07-01' AND utc_date < '1997-07-01'",
    "raw_matches",
)
oracle(
    "scan_windows",
    """SELECT run, COUNT(*) AS matches, CAST(SUM(id) AS BIGINT) AS id_sum FROM (
      SELECT 'incremental' AS run, id FROM raw_matches WHERE utc_date >= '1997-02-14'
      UNION ALL SELECT 'full', id FROM raw_matches WHERE utc_date >= '1995-07-01' AND utc_date < '1997-07-01'
      UNION ALL SELECT 'seasons', id FROM raw_matches WHERE utc_date >= '1995-07-01' AND utc_date < '1996-07-01'
        OR utc_date >= '1999-07-01' AND utc_date < '2000-07-01'
      UNION ALL SELECT 'bounded', id FROM raw_matches
        WHERE utc_date >= '1996-08-01' AND utc_date < '1996-09-01' AND status = 'FINISHED')
    GROUP BY run""",
    "raw_matches",
)
oracle(
    "src_partial_failure",
    """SELECT CASE status WHEN 'FINISHED' THEN 'ok' WHEN 'IN_PLAY' THEN 'document' ELSE 'entry' END AS level,
      COUNT(*) AS records FROM raw_matches GROUP BY 1""",
    "raw_matches",
)
oracle(
    "upsert_competitions",
    """SELECT competition_id AS id, COALESCE(n.name, competition_name) AS name,
      CASE WHEN n.name IS NULL THEN plan ELSE 'TIER_TWO' END AS plan
    FROM comps LEFT JOIN (SELECT n_regionkey, arg_max(n_name, n_nationkey) AS name FROM nation GROUP BY 1) n
      ON n_regionkey = competition_id""",
    "comps",
)
oracle(
    "upsert_teams",
    """SELECT id, COALESCE(b.name, t.name) AS name, COALESCE(seen, competition_id) AS competition_id
    FROM raw_teams t LEFT JOIN (
      SELECT c_nationkey, arg_max(c_name, c_custkey) AS name, MAX(c_custkey) AS seen FROM customer GROUP BY 1) b
      ON c_nationkey = id""",
    "raw_teams",
)
oracle(
    "upsert_matches",
    """SELECT o_orderkey AS id, COALESCE(m.status, 'TIMED') AS status, home_score_full_time,
      away_score_full_time, winner FROM orders LEFT JOIN raw_matches m ON m.id = o_orderkey""",
    "raw_matches",
)


def standing_at(matchdays: str) -> str:
    return f"""SELECT competition_id, season_id, team_id,
        CAST(RANK() OVER (PARTITION BY competition_id, season_id {BY_POINTS}) AS INTEGER) AS position,
        played_games, points, goal_difference
      FROM (SELECT competition_id, season_id, team_id, {TABLE_LINE}
            FROM legs JOIN (SELECT match_id, matchday FROM mart) USING (match_id)
            WHERE matchday {matchdays} GROUP BY 1, 2, 3)"""


FULL, EARLY = standing_at("IS NOT NULL"), standing_at("<= 26")
oracle(
    "upsert_standings",
    f"""SELECT * FROM ({FULL}) UNION ALL
    SELECT e.* FROM ({EARLY}) e ANTI JOIN ({FULL}) l USING (competition_id, season_id, team_id) UNION ALL
    SELECT e.* REPLACE (competition_id + 100 AS competition_id) FROM ({EARLY}) e""",
    "legs",
)
oracle(
    "sink_feeds",
    """SELECT 'competitions' AS feed, COUNT(*) AS rows, CAST(SUM(competition_id) AS BIGINT) AS keys,
      CAST(SUM(length(competition_name)) AS BIGINT) AS letters, 0::BIGINT AS goals FROM comps
    UNION ALL SELECT 'teams', COUNT(*), SUM(id), SUM(length(name)), 0 FROM raw_teams
    UNION ALL SELECT 'matches', COUNT(*), SUM(id), SUM(length(home_team_name)),
      SUM(home_score_full_time) FILTER (WHERE status <> 'SCHEDULED') FROM raw_matches
    UNION ALL SELECT 'standings', COUNT(*), SUM(n.id), SUM(length(team_name)), 0
      FROM league JOIN raw_teams n ON n.name = team_name
    UNION ALL SELECT 'players', COUNT(*), SUM(c_custkey), SUM(length(c_name)), 0 FROM customer""",
    "comps", "raw_teams", "raw_matches", "league",
)
oracle("sink_one_season", f"{landed()} WHERE season_id = 11996", "raw_matches")
oracle(
    "src_rejects",
    """WITH feeds AS (SELECT unnest(['competitions', 'teams', 'matches', 'standings', 'players']) AS feed)
    SELECT feed, 'document' AS level, feed || ' ' || s_suppkey || ' {' AS record, 3::BIGINT AS version
    FROM supplier, feeds WHERE s_suppkey % 2 = 0
    UNION ALL SELECT feed, 'entry', '{"note":"' || s_suppkey || '"}', 3 FROM supplier, feeds WHERE s_suppkey % 2 = 1
    UNION ALL SELECT 'standings', 'table', '{"type":"' || s_suppkey || '"}', 3 FROM supplier WHERE s_suppkey % 2 = 1""",
)
oracle(
    "upsert_players",
    """SELECT c_custkey AS id, CASE WHEN s.k IS NULL THEN c_name ELSE 'P' || c_custkey END AS name,
      CASE WHEN s.k IS NULL THEN c_mktsegment ELSE prio END AS position,
      COALESCE(s.k, c_nationkey) AS team_id
    FROM customer LEFT JOIN (
      SELECT o_custkey, o_orderkey AS k, o_orderpriority AS prio FROM orders
      QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) s
      ON o_custkey = c_custkey""",
)
oracle(
    "upsert_reports",
    """WITH b AS (
      SELECT conv_id, first(role ORDER BY turn) AS role, last(text ORDER BY turn) AS text, MAX(turn) AS turn
      FROM conversations GROUP BY conv_id)
    SELECT COALESCE(doc_id, conv_id) AS id, COALESCE(doc_id, conv_id) AS match_id,
      CASE WHEN doc_id IS NULL THEN b.role ELSE source END AS competition_code,
      CASE WHEN conv_id IS NULL THEN d.text ELSE b.text END AS narrative,
      COALESCE(b.turn, 0) AS generated_at
    FROM documents d FULL JOIN b ON conv_id = doc_id""",
)
oracle(
    "upsert_chunks",
    """SELECT COALESCE(a.doc_id, b.doc_id) AS report_id, COALESCE(a.chunk_index, b.chunk_index) AS chunk_index,
      COALESCE(b.chunk_text, a.chunk_text) AS chunk_text
    FROM d3_chunks a FULL JOIN d6_chunks b ON a.doc_id = b.doc_id AND a.chunk_index = b.chunk_index""",
    "d3_chunks", "d6_chunks", recursive=True,
)
oracle(
    "ingestion_log",
    """SELECT entity_type, records_ingested, COALESCE(n, records_ingested) AS keys_ingested, 'success' AS status,
      (SELECT COUNT(*) + COUNT(*) FILTER (WHERE s_suppkey % 2 = 1 AND entity_type = 'standings') FROM supplier) AS records_rejected
    FROM (SELECT 'competitions' AS entity_type, COUNT(*) AS records_ingested, NULL AS n FROM comps
      UNION ALL SELECT 'teams', COUNT(*), NULL FROM raw_teams
      UNION ALL SELECT 'matches', COUNT(*), NULL FROM raw_matches
      UNION ALL SELECT 'standings', 2 * COUNT(*), COUNT(*) FROM league
      UNION ALL SELECT 'players', COUNT(*), NULL FROM customer)""",
    "comps", "raw_teams", "raw_matches", "league",
)
oracle("stg_competitions", "SELECT * FROM comps", "comps")
oracle(
    "stg_teams",
    "SELECT id AS team_id, name AS team_name, short_name AS team_short_name, tla AS team_tla, competition_id,"
    " area_name, ingested_at FROM raw_teams", "raw_teams",
)
oracle("stg_matches", "SELECT * FROM stg", "stg")
oracle(
    "stg_standings",
    """SELECT l.competition_id, l.season_id, n.id AS team_id, l.team_name, position, played_games, won, draw, lost,
      points, goals_for, goals_against, goal_difference, points_per_game, stamp AS ingested_at
    FROM league l JOIN raw_teams n ON n.name = team_name
    JOIN (SELECT competition_id, season_id, team_id, MAX(CAST(match_date AS TIMESTAMP)) AS stamp FROM legs
          GROUP BY ALL) s ON s.competition_id = l.competition_id AND s.season_id = l.season_id AND s.team_id = n.id""",
    "league", "raw_teams",
)
oracle("int_match_results", "SELECT * FROM mart", "mart")
oracle("mart_match_results", "SELECT * FROM mart", "mart")
oracle("mart_league_table", "SELECT * FROM league", "league")
oracle("mart_bottler_index", "SELECT * FROM bottlers", "bottlers")
oracle("team_form_all", "SELECT * FROM form", "form")
oracle("stream_form", "SELECT * FROM form", "form")
oracle(
    "guarded_refusals",
    """SELECT 'comma join of marts' AS attempt, '' AS refusal, COUNT(*) AS rows FROM mart m
      JOIN bottlers b ON b.team_id = m.home_team_id AND b.season_id = m.season_id
    UNION ALL SELECT 'named query', '', COUNT(*) FROM mart WHERE home_goals = (SELECT MAX(home_goals) FROM mart)
    UNION ALL SELECT 'reflection', 'Query may not call methods by name', 0
    UNION ALL SELECT unnest(['comma join', 'file', 'comma file', 'function', 'other relation']),
      'Query may only read the known marts', 0""",
    "mart", "bottlers",
)
oracle(
    "stream_late_corrections",
    "SELECT id, status, CAST('1' || matchday AS INTEGER) AS matchday FROM raw_matches WHERE id % 5 = 0", "raw_matches",
)

oracle(
    "build_models",
    """SELECT 'int_match_results' AS model, COUNT(*) AS rows, COUNT(DISTINCT match_id) AS keys FROM mart
    UNION ALL SELECT 'int_team_form', COUNT(*), COUNT(DISTINCT team_id) FROM legs
    UNION ALL SELECT 'mart_match_results', COUNT(*), COUNT(DISTINCT match_id) FROM mart
    UNION ALL SELECT 'mart_league_table', COUNT(*), COUNT(DISTINCT team_name) FROM league
    UNION ALL SELECT 'mart_bottler_index', COUNT(*), COUNT(DISTINCT team_id) FROM bottlers""",
    "mart", "legs", "league", "bottlers",
)

LINE = "match_id, match_date, competition_code, home_team_name, away_team_name, total_goals"
oracle("flt_status", "SELECT id, status FROM raw_matches WHERE status = 'FINISHED'", "raw_matches")
oracle(
    "flt_name_pattern",
    f"SELECT {LINE} FROM mart WHERE contains(lower(home_team_name), 'nation_1') OR contains(lower(away_team_name), 'nation_1')",
    "mart",
)
MEET = """(home_team_name ILIKE '%NATION_2%' AND away_team_name ILIKE '%nation_7%'
      OR home_team_name ILIKE '%nation_7%' AND away_team_name ILIKE '%NATION_2%')"""
oracle("flt_pair_pattern", f"SELECT {LINE} FROM mart WHERE {MEET}", "mart")
oracle("flt_season_range", f"SELECT {LINE} FROM mart WHERE {within(SEASON)}", "mart")
IN_SEASON = f"""competition_code = '{LEAGUE}' AND {within(SEASON)}"""
oracle(
    "flt_season_ids",
    f"SELECT * FROM bottlers WHERE season_id IN (SELECT season_id FROM mart WHERE {IN_SEASON})", "bottlers",
)
oracle(
    "flt_latest_season",
    "SELECT * FROM bottlers b WHERE season_id = (SELECT MAX(season_id) FROM bottlers x"
    " WHERE x.competition_code = b.competition_code)", "bottlers",
)
oracle("flt_optional", f"SELECT {LINE} FROM mart WHERE competition_code = '{LEAGUE}'", "mart")
oracle("flt_in_list", f"SELECT {LINE} FROM mart WHERE competition_code IN ('R0', 'R3')", "mart")
oracle("flt_threshold", f"SELECT {LINE} FROM mart WHERE total_goals >= 5", "mart")
WINS = f"""SELECT team_name, {n_if("team_result = 'win' AND venue = 'home'")} AS home_wins,
      {n_if("team_result = 'win' AND venue = 'away'")} AS away_wins FROM legs GROUP BY team_name"""
for name in ("flt_having", "away_over_home_wins"):
    oracle(name, f"SELECT * FROM ({WINS}) WHERE away_wins > home_wins", "legs")
oracle("agg_conditional_sum", WINS, "legs")

oracle("join_left_dim", "SELECT match_id, competition_id, competition_name, competition_code FROM mart", "mart")
oracle(
    "join_inner_report",
    "SELECT id, 0 AS chunk_index, match_id, competition_code, home_team, match_date"
    " FROM embeddings JOIN reports ON id = vec_id", "reports",
)
oracle(
    "join_semi_season",
    f"SELECT competition_code, season_id, team_name, points FROM league"
    f" WHERE season_id IN (SELECT season_id FROM mart WHERE {IN_SEASON})", "league",
)
oracle("join_anti_notin", "SELECT match_id FROM mart WHERE match_id NOT IN (SELECT doc_id FROM documents)", "mart")
NO_CHUNK = "SELECT doc_id AS id FROM documents WHERE NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = doc_id)"
oracle("join_anti_notexists", NO_CHUNK)
oracle("embedding_backlog", NO_CHUNK)
oracle(
    "join_vector_topk",
    """SELECT query_id, report_id, chunk_index, match_id, similarity FROM scores JOIN reports ON id = report_id
    WHERE similarity >= 0.1
    QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY similarity DESC, report_id, chunk_index) <= 5""",
    "scores", "reports",
)
oracle(
    "topk_similarity",
    "SELECT report_id, chunk_index, query_id, similarity FROM scores WHERE query_id = 0 AND similarity >= 0.1"
    " ORDER BY similarity DESC, report_id, chunk_index LIMIT 10", "scores",
)
oracle(
    "fn_cosine",
    """SELECT report_id, round(c, 6) AS similarity, round(1 - round(c, 6), 6) AS distance FROM (
      SELECT a.vec_id AS report_id, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
        / (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
         * sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))) AS c
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)""",
)
oracle("agg_league_table", "SELECT * EXCLUDE (position) FROM tables", "tables")
oracle("league_tables", "SELECT * FROM tables", "tables")
oracle("win_position_rank", "SELECT competition_code, season_id, team_name, position FROM tables", "tables")
SUMMARY = f"""COUNT(*) AS total_matches, {total('total_goals')} AS total_goals,
      {two('SUM(total_goals)', 'COUNT(*)')} AS avg_goals_per_game, {n_if("result = 'home'")} AS home_wins,
      {n_if("result = 'draw'")} AS draws, {n_if("result = 'away'")} AS away_wins,
      MAX(total_goals) AS highest_scoring_match, {n_if('is_high_scoring')} AS high_scoring_matches"""
oracle("agg_season_summary", f"SELECT competition_code, season_id, {SUMMARY} FROM mart GROUP BY 1, 2", "mart")
oracle("season_summary", f"SELECT competition_code, {SUMMARY} FROM mart WHERE {IN_SEASON} GROUP BY 1", "mart")
oracle(
    "season_highlights",
    """SELECT competition_code, season_id,
      CASE WHEN h >= d AND h >= a THEN 'home' WHEN a >= d THEN 'away' ELSE 'draw' END AS most_common_result,
      big AS biggest_margin, m AS biggest_win_match_id
    FROM (SELECT competition_code, season_id, COUNT(*) FILTER (WHERE result = 'home') AS h,
        COUNT(*) FILTER (WHERE result = 'draw') AS d, COUNT(*) FILTER (WHERE result = 'away') AS a,
        MAX(abs(goal_diff)) AS big,
        first(match_id ORDER BY abs(goal_diff) DESC, total_goals DESC, match_date DESC, match_id DESC) AS m
      FROM mart GROUP BY 1, 2)""",
    "mart",
)
oracle("agg_team_splits", splits(one_team(team_id=7) + f" AND competition_code = '{LEAGUE}'"), "mart")
MINE = one_team(like="nation_1") + f" AND {IN_SEASON}"
oracle("team_season_stats", splits(MINE), "mart")
oracle("team_season_matches", f"SELECT * EXCLUDE (competition_code) FROM ({MINE})", "mart")
STATS = "SELECT competition_code, COUNT(*) AS matches, COUNT(DISTINCT season_id) AS seasons FROM mart GROUP BY 1"
oracle("agg_db_stats", STATS, "mart")
oracle("db_stats", STATS, "mart")
oracle(
    "agg_count_star",
    "SELECT 'reports' AS table_name, COUNT(*) AS rows FROM documents UNION ALL"
    " SELECT 'report_embeddings', COUNT(*) FROM embeddings UNION ALL SELECT 'mart_match_results', COUNT(*) FROM mart",
    "mart",
)
oracle("win_form_points_last5", "SELECT match_id, team_id, form_points_last5 FROM form", "form")
oracle("win_recency_rank", "SELECT match_id, team_id, match_recency_rank FROM form", "form")


def form_of(matches: str, n: int) -> str:
    return f"""SELECT match_id, match_date, competition_code, opponent, venue, home_goals, away_goals, goals_scored,
      goals_conceded, result,
      CAST(SUM(CASE team_result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) OVER (ORDER BY match_date, match_id
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS form_points_last5
    FROM ({matches}) ORDER BY match_date DESC, match_id DESC LIMIT {n}"""


oracle("win_form_query", form_of(one_team(like="nation_1"), 25), "mart")
oracle("team_form", form_of(one_team(team_id=7), 7), "mart")
F_KEYS = "competition_code, season_id, team_name"
oracle("win_league_avg", f"SELECT {F_KEYS}, league_avg_ppg, league_avg_goals, league_avg_conceded FROM features", "features")
oracle("win_league_stddev", f"SELECT {F_KEYS}, stddev_ppg, stddev_goals, stddev_conceded FROM features", "features")
HIGH = "match_id, match_date, competition_code, home_team_name, away_team_name, home_goals, away_goals, total_goals, result"
BEST = "ORDER BY total_goals DESC, match_date DESC, match_id DESC"
oracle("topk_high_scoring", f"SELECT {HIGH} FROM mart WHERE total_goals >= 4 {BEST} LIMIT 25", "mart")
oracle("high_scoring_matches", f"SELECT {HIGH} FROM mart WHERE total_goals >= 4 AND {IN_SEASON} {BEST} LIMIT 10", "mart")
oracle(
    "topk_recent",
    """SELECT team_id, match_id, match_date, team_result FROM legs
    QUALIFY ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id DESC) <= 5""",
    "legs",
)
oracle("sort_ranked", f"SELECT {LINE} FROM mart WHERE is_ht_lead_dropped", "mart")
oracle(
    "sides_unpivot",
    """SELECT match_id, match_date, competition_id, season_id, venue, team_id, team_name, opponent_id, opponent_name,
      goals_scored, goals_conceded, team_result, points_earned FROM legs""",
    "legs",
)
oracle("sides_unpivot_names", "SELECT match_id, team_name, result FROM legs", "legs")
oracle("distinct_union", "SELECT DISTINCT doc_id AS id FROM documents")

oracle("season_parse", "SELECT event_id, CAST(start AS INTEGER) AS season_start FROM phrases", "phrases")
LABEL = "printf('%d/%02d', {0}, ({0} + 1) % 100)"
oracle(
    "resolve_season",
    f"SELECT event_id, CAST(start AS INTEGER) AS season_start_year, {LABEL.format('start')} AS season_label FROM phrases",
    "phrases",
)
oracle("season_label", f"SELECT match_id, {LABEL.format(season_of('match_date'))} AS season_label FROM mart", "mart")
oracle(
    "season_of_date",
    f"""SELECT match_id, CAST({season_of('match_date')} AS INTEGER) AS july_season,
      CAST({season_of('match_date', 8)} AS INTEGER) AS august_season FROM mart""",
    "mart",
)
oracle("text_chunks", "SELECT * FROM cv_chunks", "cv_chunks", recursive=True)
oracle("chunk_reports", "SELECT doc_id AS report_id, chunk_index, chunk_text FROM d3_chunks", "d3_chunks", recursive=True)

PROBLEM = """CASE WHEN event_type IN ('click', 'view') THEN NULL
      WHEN event_type = 'purchase' AND value < 20 THEN 'Query must reference at least one marts. table'
      WHEN event_type = 'purchase' THEN 'Empty query'
      WHEN event_type = 'signup' AND value < 20 THEN 'Only one statement is allowed'
      WHEN event_type = 'signup' THEN 'Forbidden keyword detected: \\bupdate\\b'
      WHEN value < 20 THEN 'Only SELECT statements are allowed (got DROP)'
      ELSE 'Only SELECT statements are allowed (got UNKNOWN)' END"""
oracle(
    "sql_guard",
    f"""SELECT event_id, CASE WHEN event_type = 'error' AND value < 20 THEN 'DROP'
      WHEN event_type = 'error' OR event_type = 'purchase' AND value >= 20 THEN 'UNKNOWN' ELSE 'SELECT' END
      AS statement_type, {PROBLEM} AS problem FROM events""",
)
oracle(
    "fence_strip",
    """SELECT event_id, CASE event_type
      WHEN 'click' THEN 'select team_name from marts.mart_league_table where points > ' || user_id
      WHEN 'view' THEN 'WITH t AS (SELECT * FROM marts.mart_match_results) -- drop nothing' || chr(10)
        || 'SELECT count(*) FROM t WHERE matchday = ' || user_id || ';'
      WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'select * from raw.matches where id = ' || user_id ELSE '' END
      WHEN 'signup' THEN CASE WHEN value < 20 THEN 'select 1 from marts.mart_match_results; select 2'
        ELSE 'select * from marts.mart_match_results where home_team_name = ''Update FC; update''' END
      ELSE CASE WHEN value < 20 THEN 'Drop table marts.mart_bottler_index' ELSE 'explain ' || user_id END
      END AS statement FROM events""",
)
oracle(
    "prompt_build",
    """SELECT match_id, format('Match: {} {}-{} {}, HT: {}-{}, Matchday {}, {}', home_team_name, home_goals,
      away_goals, away_team_name, home_goals_ht, away_goals_ht, matchday, competition_code)
      || chr(10) || 'Half-time leader: ' || ht_leader
      || chr(10) || 'HT lead dropped: ' || CASE WHEN is_ht_lead_dropped THEN 'True' ELSE 'False' END
      || chr(10) || 'High scoring: ' || CASE WHEN is_high_scoring THEN 'True' ELSE 'False' END
      || chr(10) || 'Write the match report:' AS prompt FROM mart""",
    "mart",
)
oracle("report_search", search(0.4, 5), "scores", "reports", "d3_chunks", recursive=True)
oracle("report_search_low", search(0.1, 5), "scores", "reports", "d3_chunks", recursive=True)
oracle(
    "context_block",
    f"""SELECT query_id, '## Relevant match reports' || chr(10) || chr(10) || string_agg(
      '[' || COALESCE(home_team, 'None') || ' vs ' || COALESCE(away_team, 'None') || ', '
      || COALESCE(competition_code, 'None') || ', ' || COALESCE(CAST(match_date AS VARCHAR), 'None')
      || ', similarity: ' || {decimals('(CAST(round(similarity*1000000) AS BIGINT) + 5000) // 10000')} || ']' || chr(10)
      || chunk_text || chr(10) || chr(10), '' ORDER BY similarity DESC, report_id, chunk_index) AS context
    FROM ({search(0.1, 5)}) GROUP BY query_id""",
    "scores", "reports", "d3_chunks", recursive=True,
)
oracle(
    "judge_parse",
    f"""SELECT event_id, event_type <> 'error' AS readable,
      CASE WHEN event_type <> 'error' THEN CAST({K} % 5 + 1 AS INTEGER) END AS grounding,
      CASE WHEN event_type <> 'error' THEN 4 END AS responsiveness,
      CASE WHEN event_type <> 'error' THEN CAST({K} % 3 + 1 AS INTEGER) END AS accuracy,
      CASE WHEN event_type <> 'error' THEN 'a,b' END AS issues,
      CASE WHEN event_type <> 'error' THEN TRUE END AS overall_pass FROM events""",
)

CURRENT = f"""SELECT CAST(RANK() OVER ({BY_POINTS}) AS INTEGER) AS position, * FROM (
      SELECT team_name, {TABLE_LINE} FROM legs WHERE {IN_SEASON} GROUP BY team_name)"""
oracle("league_table", CURRENT, "legs")
oracle("league_table_current", CURRENT, "legs")
INDEX = "SELECT team_name, competition_name, matches_leading_ht, leads_dropped, drop_rate_pct FROM bottlers"
oracle(
    "bottler_index",
    f"{INDEX} WHERE competition_code = '{LEAGUE}' AND matches_leading_ht >= 4"
    f" AND season_id IN (SELECT season_id FROM mart WHERE {IN_SEASON})", "bottlers",
)
oracle(
    "bottler_index_latest",
    f"{INDEX} WHERE competition_code = '{LEAGUE}'"
    f" AND season_id = (SELECT MAX(season_id) FROM bottlers WHERE competition_code = '{LEAGUE}')", "bottlers",
)
oracle(
    "head_to_head",
    f"SELECT match_id, match_date, competition_code, matchday, home_team_name, away_team_name, home_goals,"
    f" away_goals, result, total_goals FROM mart WHERE {MEET}", "mart",
)
oracle(
    "guarded_sql",
    "SELECT competition_code, COUNT(*) AS total_draws FROM mart WHERE home_goals = away_goals GROUP BY 1", "mart",
)
oracle("league_anomaly_features", "SELECT * FROM features", "features")
def rounded(value: str) -> str:
    return decimals(f"(CAST(round({value}*1000000) AS BIGINT) + 5000) // 10000")


oracle(
    "anomaly_prompt",
    f"""SELECT team_name, competition_code, season_id, 'Team: ' || team_name
      || chr(10) || 'Competition: ' || competition_name || chr(10) || 'Games played: ' || played_games
      || chr(10) || chr(10) || 'Team stats:' || chr(10) || '- Points per game: ' || {rounded('points_per_game')}
      || chr(10) || '- Win percentage: ' || printf('%d.%d', CAST(round(win_percentage*10) AS BIGINT) // 10,
        CAST(round(win_percentage*10) AS BIGINT) % 10) || '%'
      || chr(10) || '- Goals per game: ' || {rounded('goals_per_game')}
      || chr(10) || '- Conceded per game: ' || {rounded('conceded_per_game')}
      || chr(10) || '- Goal difference: ' || goal_difference
      || chr(10) || chr(10) || 'League averages:' || chr(10) || '- Avg points per game: ' || {rounded('league_avg_ppg')}
      || chr(10) || '- Avg goals per game: ' || {rounded('league_avg_goals')}
      || chr(10) || '- Avg conceded per game: ' || {rounded('league_avg_conceded')}
      || chr(10) || '- Std deviation PPG: ' || COALESCE({rounded('stddev_ppg')}, 'None') AS prompt FROM features""",
    "features",
)
oracle("league_anomaly_flags", "SELECT * FROM flags", "flags")
oracle(
    "anomaly_summary",
    f"SELECT competition_code, COUNT(*) AS teams_analysed, {n_if('is_anomalous')} AS teams_flagged FROM flags GROUP BY 1",
    "flags",
)
FACTS = """match_id, match_date, matchday, competition_code, competition_name, home_team_name, away_team_name,
      home_goals, away_goals, home_goals_ht, away_goals_ht, total_goals, result, ht_leader, is_ht_lead_dropped,
      is_high_scoring"""
oracle(
    "narrative_backlog",
    f"SELECT {FACTS} FROM mart WHERE competition_code IN ('R0', 'R1', 'R2', 'R3')"
    " AND match_id NOT IN (SELECT doc_id FROM documents)", "mart",
)
oracle(
    "backlog_cost",
    """SELECT COUNT(*) AS matches, (COUNT(*) * 500)::DOUBLE * (0.80::DOUBLE + 4.00::DOUBLE) / 1000000
      AS estimated_usd FROM mart WHERE match_id NOT IN (SELECT doc_id FROM documents)""",
    "mart",
)
oracle(
    "recent_matches",
    f"SELECT {FACTS} FROM mart WHERE competition_code = '{LEAGUE}' ORDER BY match_date DESC, match_id DESC LIMIT 12",
    "mart",
)


def best_of_season(columns: str, order: str, n: int = 1) -> str:
    return f"""SELECT competition_code, season_id, team_name, {columns} FROM league
    QUALIFY ROW_NUMBER() OVER (PARTITION BY competition_code, season_id ORDER BY {order}, team_name) <= {n}"""


oracle("top_scoring_team", best_of_season("goals_for", "goals_for DESC"), "league")
oracle("fewest_conceded", best_of_season("goals_against", "goals_against"), "league")
oracle("best_goal_difference", best_of_season("goal_difference", "goal_difference DESC"), "league")
oracle("draw_count", f"SELECT competition_code, COUNT(*) AS total_draws FROM mart WHERE result = 'draw' GROUP BY 1", "mart")
oracle(
    "high_drop_rate",
    "SELECT team_name, competition_code, season_id, drop_rate_pct FROM bottlers WHERE 2 * leads_dropped > matches_leading_ht"
    " AND drop_rate_pct > 50", "bottlers",
)
RECORD = "competition_code, season_id, team_name, played_games, won, draw, lost, points"
oracle(
    "away_record",
    f"SELECT {RECORD} FROM (SELECT competition_code, season_id, team_name, {TABLE_LINE} FROM legs"
    " WHERE venue = 'away' GROUP BY 1, 2, 3)", "legs",
)
oracle("total_goals", f"SELECT {total('home_goals + away_goals')} AS total_goals FROM mart", "mart")
oracle(
    "home_win_pct",
    f"""SELECT competition_code, {n_if("result = 'home'")} AS home_wins, COUNT(*) AS matches,
      {pct("COUNT(*) FILTER (WHERE result = 'home')", 'COUNT(*)')} AS home_win_pct FROM mart GROUP BY 1""",
    "mart",
)
oracle("dropped_leads_total", f"SELECT {n_if('is_ht_lead_dropped')} AS dropped_leads FROM mart", "mart")
oracle("avg_goals_dropped", f"SELECT {two('SUM(total_goals)', 'COUNT(*)')} AS avg_goals FROM mart WHERE is_ht_lead_dropped", "mart")
oracle(
    "goalless_count",
    "SELECT competition_code, season_id, COUNT(*) AS goalless_matches FROM mart WHERE total_goals = 0 GROUP BY 1, 2", "mart",
)
oracle(
    "avg_goals_matchday",
    f"SELECT COUNT(*) AS matches, {two('SUM(total_goals)', 'NULLIF(COUNT(*), 0)')} AS avg_goals FROM mart WHERE matchday = 1",
    "mart",
)
oracle(
    "top_scorers_bottlers",
    f"""SELECT competition_code, season_id, team_name, goals_for, drop_rate_pct
    FROM ({best_of_season('goals_for', 'goals_for DESC', 5)})
    JOIN bottlers USING (competition_code, season_id, team_name) WHERE drop_rate_pct > 30""",
    "league", "bottlers",
)
oracle("competition_count", "SELECT COUNT(DISTINCT competition_id) AS competitions FROM mart", "mart")
oracle(
    "top_bottlers",
    """SELECT competition_code, season_id, team_name, matches_leading_ht, leads_dropped, drop_rate_pct FROM bottlers
    ORDER BY drop_rate_pct DESC, matches_leading_ht DESC, season_id, team_id LIMIT 10""",
    "bottlers",
)
oracle(
    "record_vs_top_n",
    f"""SELECT {RECORD} FROM (SELECT l.competition_code, l.season_id, l.team_name, {TABLE_LINE}
      FROM legs l JOIN (SELECT competition_code AS c, season_id AS s, team_name AS o FROM tables WHERE position <= 6)
        ON c = competition_code AND s = season_id AND o = opponent_name GROUP BY 1, 2, 3)""",
    "tables",
)
oracle(
    "league_goals_ranking",
    f"""SELECT competition_code, COUNT(*) AS total_matches, {two('SUM(total_goals)', 'COUNT(*)')} AS avg_goals_per_game
    FROM mart GROUP BY 1""",
    "mart",
)
oracle(
    "dropped_lead_matches",
    """SELECT match_id, match_date, competition_code, home_team_name, away_team_name, home_goals, away_goals,
      home_goals_ht, away_goals_ht, total_goals, result FROM mart WHERE is_ht_lead_dropped""",
    "mart",
)


def measures(team_id: int, name: str) -> str:
    columns = "played, won, drawn, lost, goals_for, goals_against, goal_difference, points"
    return f"""SELECT measure, {name} FROM (
      UNPIVOT (SELECT {columns} FROM ({splits(one_team(team_id=team_id))}) WHERE split = 'aggregate')
      ON {columns} INTO NAME measure VALUE {name})"""


oracle(
    "compare_teams",
    f"SELECT measure, team_a, team_b FROM ({measures(2, 'team_a')}) JOIN ({measures(7, 'team_b')}) USING (measure)",
    "mart",
)
oracle(
    "points_gap",
    """SELECT competition_code, season_id, MAX(points) - MIN(points) AS points_gap FROM (
      SELECT competition_code, season_id, points FROM league QUALIFY ROW_NUMBER() OVER (
        PARTITION BY competition_code, season_id ORDER BY position, team_name) <= 2) GROUP BY 1, 2""",
    "league",
)


def checks(*lines: tuple[str, str, str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{model}' AS model, '{column}' AS column_name, CAST(({bad}) AS BIGINT) AS n_bad"
        for rule, model, column, bad in lines
    )
    return f"SELECT *, n_bad = 0 AS ok FROM ({rows})"


def repeated(frame: str, key: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {key} FROM {frame} GROUP BY {key} HAVING COUNT(*) > 1)"


def bad(frame: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {frame} WHERE {condition}"


oracle(
    "dq_unique",
    checks(
        ("unique", "lineitem", "l_orderkey,l_linenumber", repeated("lineitem", "l_orderkey, l_linenumber")),
        ("unique", "stg_matches", "match_id", repeated("stg", "match_id")),
    ),
    "stg",
)
oracle(
    "dq_not_null",
    checks(*[("not_null", "match_reports", c, bad("reports", f"{c} IS NULL")) for c in ("id", "match_id", "home_team", "match_date")]),
    "reports",
)
oracle(
    "dq_accepted_values",
    checks(("accepted_values", "raw_matches", "status", bad("raw_matches", "status NOT IN ('FINISHED', 'SCHEDULED')"))),
    "raw_matches",
)
def spread(key: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {key} FROM mart GROUP BY {key} HAVING COUNT(DISTINCT {season_of('match_date')}) > 1)"


oracle(
    "dq_ranges",
    checks(
        ("range", "mart_bottler_index", "drop_rate_pct", bad("bottlers", "drop_rate_pct NOT BETWEEN 0 AND 60")),
        ("range", "mart_match_results", "home_goals", bad("mart", "home_goals < 1")),
        ("one_season", "mart_match_results", "match_date", spread("season_id")),
        ("one_season", "matches_by_team", "match_date", spread("home_team_id")),
    ),
    "bottlers",
)
oracle(
    "dq_report",
    checks(
        ("unique", "stg_competitions", "competition_id", repeated("comps", "competition_id")),
        ("unique", "stg_teams", "team_id", repeated("raw_teams", "id")),
        ("unique", "stg_matches", "match_id", repeated("stg", "match_id")),
        ("unique", "int_match_results", "match_id", repeated("mart", "match_id")),
        ("unique", "mart_match_results", "match_id", repeated("mart", "match_id")),
        ("unique", "mart_league_table", "competition_id,season_id,team_name",
         repeated("league", "competition_id, season_id, team_name")),
        ("not_null", "stg_competitions", "competition_id", bad("comps", "competition_id IS NULL")),
        ("not_null", "stg_competitions", "competition_code", bad("comps", "competition_code IS NULL")),
        ("not_null", "stg_teams", "team_id", bad("raw_teams", "id IS NULL")),
        ("not_null", "stg_matches", "match_id", bad("stg", "match_id IS NULL")),
        ("accepted_values", "stg_matches", "status", bad("stg", "status <> 'FINISHED'")),
        ("not_null", "stg_standings", "team_id", bad("legs", "team_id IS NULL")),
        ("not_null", "stg_standings", "points", bad("league", "points IS NULL")),
        ("not_null", "int_match_results", "match_id", bad("mart", "match_id IS NULL")),
        ("not_null", "int_team_form", "team_id", bad("legs", "team_id IS NULL")),
        ("not_null", "mart_match_results", "match_id", bad("mart", "match_id IS NULL")),
        ("range", "mart_match_results", "home_goals", bad("mart", "home_goals < 0")),
        ("range", "mart_match_results", "away_goals", bad("mart", "away_goals < 0")),
        ("one_season", "mart_match_results", "match_date", spread("season_id")),
        ("not_null", "mart_league_table", "team_name", bad("league", "team_name IS NULL")),
        ("not_null", "mart_league_table", "points", bad("league", "points IS NULL")),
        ("not_null", "mart_bottler_index", "team_name", bad("bottlers", "team_name IS NULL")),
        ("not_null", "mart_bottler_index", "drop_rate_pct", bad("bottlers", "drop_rate_pct IS NULL")),
        ("range", "mart_bottler_index", "drop_rate_pct", bad("bottlers", "drop_rate_pct NOT BETWEEN 0 AND 100")),
    ),
    "comps", "raw_teams", "league", "bottlers",
)

oracle(
    "eval_checks_sql",
    f"""SELECT event_id, concat_ws(' | ',
      CASE WHEN event_type = 'purchase' AND value >= 20 THEN 'sql is empty' END,
      CASE WHEN event_type = 'error' THEN 'success is False' END,
      CASE WHEN NOT (event_type = 'purchase' AND value >= 20) THEN 'validate_sql failed: ' || ({PROBLEM}) END,
      CASE WHEN event_type = 'signup' THEN 'answer is empty' END,
      CASE WHEN event_type = 'click' THEN 'answer contains disallowed phrase: ''i don''t know''' END) AS failures
    FROM events""",
)
LENGTH = "length(repeat(props, CAST(length(event_type) - 3 AS BIGINT)))"
oracle(
    "eval_checks_anomaly",
    f"""SELECT event_id, concat_ws(' | ',
      CASE WHEN event_type = 'view' THEN 'missing keys: anomaly_type, explanation' END,
      CASE WHEN event_type = 'click' THEN 'invalid severity value: ''extreme''' END,
      CASE WHEN {LENGTH} <= 20 THEN 'explanation too short (' || {LENGTH} || ' chars, need > 20)' END) AS failures
    FROM events""",
)
oracle(
    "eval_checks_response",
    """SELECT conv_id, turn, concat_ws(' | ',
      CASE WHEN trim(text) = '' THEN 'response is empty' END,
      CASE WHEN contains(lower(text), 'i don''t have access')
        THEN 'response contains disallowed phrase: ''i don''t have access''' END,
      CASE WHEN contains(lower(text), 'my training data')
        THEN 'response contains disallowed phrase: ''my training data''' END,
      CASE WHEN length(text) <= 50 THEN 'response too short (' || length(text) || ' chars, need > 50)' END) AS failures
    FROM conversations WHERE role = 'assistant'""",
)
oracle("eval_golden", "SELECT conv_id, turn, array_to_string(reasons, ' | ') AS reasons FROM golden", "golden")
for name in ("eval_summary", "agg_pass_rate"):
    oracle(
        name,
        """SELECT total, passed, total - passed AS failed,
          ((2000 * passed + total) // (2 * total))::DOUBLE / 1000 AS pass_rate,
          passed::DOUBLE / total >= 0.85 AS passed_threshold
        FROM (SELECT COUNT(*) AS total, CAST(COUNT(*) FILTER (WHERE len(reasons) = 0) AS BIGINT) AS passed FROM golden)""",
        "golden",
    )
part(
    "hits",
    """
      SELECT question, kind FROM (SELECT question, unnest(reasons) AS reason FROM golden)
      JOIN (VALUES ('missing expected text'), ('graceful refusal'), ('forbidden text'), ('no number')) AS k(kind)
        ON contains(reason, kind)""",
    "golden",
)
part(
    "every",
    """
      SELECT * FROM hits UNION ALL SELECT DISTINCT question, 'routing' FROM hits WHERE kind = 'missing expected text'""",
    "hits",
)
part(
    "told",
    """
      SELECT kind, COUNT(*) AS failures, array_to_string(list_sort(list(DISTINCT question))[:3], ' | ') AS examples
      FROM every GROUP BY kind
      UNION ALL SELECT 'none', 0, '' FROM golden HAVING COUNT(*) FILTER (WHERE len(reasons) > 0) = 0""",
    "every", "golden",
)
oracle(
    "eval_recommend",
    """SELECT kind, failures, examples, CASE kind
      WHEN 'missing expected text' THEN 'Compare these answers with the rows their tools returned.'
      WHEN 'graceful refusal' THEN 'State in the task which seasons and competitions are covered.'
      WHEN 'forbidden text' THEN 'Screen answers for the listed texts before they are shown.'
      WHEN 'no number' THEN 'Have an answer repeat the figures it rests on.'
      WHEN 'routing' THEN 'Check which tool each of these questions was sent to.'
      ELSE 'Nothing to change.' END AS advice
    FROM told""",
    "told",
)
