"""Independent SQL for every query, for a second engine over the same tables."""

from __future__ import annotations

from pavilion import schemas
from pavilion.testbed import mapping


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


# Named parts, each using only earlier ones. A statement gets the ones it needs.
PARTS = {
    "raw_matches": f"""
        SELECT m.* FROM (
            SELECT {_select(mapping.MATCHES)}
            FROM orders
            LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey) m
        CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c
        WHERE c.copy = 1 OR m.id LIKE '%7'""",
    "raw_deliveries": f"""
        SELECT d.* FROM (SELECT {_select(mapping.DELIVERIES)} FROM lineitem) d
        CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c
        WHERE c.copy = 1 OR d.match_id LIKE '%7'""",
    "clean_matches": """
        SELECT DISTINCT TRY_CAST(id AS BIGINT) AS id, season, city, venue, date, team1, team2,
               toss_winner, toss_decision, winner,
               TRY_CAST(win_by_runs AS INTEGER) AS win_by_runs,
               TRY_CAST(win_by_wickets AS INTEGER) AS win_by_wickets, player_of_match
        FROM raw_matches WHERE TRY_CAST(id AS BIGINT) IS NOT NULL""",
    "clean_deliveries": """
        SELECT DISTINCT TRY_CAST(match_id AS BIGINT) AS match_id,
               TRY_CAST(inning AS INTEGER) AS inning, batting_team, bowling_team,
               TRY_CAST("over" AS INTEGER) AS "over", TRY_CAST(ball AS INTEGER) AS ball,
               batsman, non_striker, bowler,
               TRY_CAST(batsman_runs AS INTEGER) AS batsman_runs,
               TRY_CAST(extra_runs AS INTEGER) AS extra_runs,
               TRY_CAST(total_runs AS INTEGER) AS total_runs,
               player_dismissed, dismissal_kind
        FROM raw_deliveries
        WHERE TRY_CAST(match_id AS BIGINT) IS NOT NULL
          AND batsman IS NOT NULL AND bowler IS NOT NULL""",
    "dim_matches": """
        SELECT match_id, season_year, city, venue, match_date, team1, team2, toss_winner,
               toss_decision, match_winner, win_by_runs, win_by_wickets, player_of_match
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY match_id
                ORDER BY season_year NULLS FIRST, city NULLS FIRST, venue NULLS FIRST,
                         match_date NULLS FIRST, team1 NULLS FIRST, team2 NULLS FIRST,
                         toss_winner NULLS FIRST, toss_decision NULLS FIRST,
                         match_winner NULLS FIRST, win_by_runs NULLS FIRST,
                         win_by_wickets NULLS FIRST, player_of_match NULLS FIRST) AS place
            FROM (
                SELECT id AS match_id, season AS season_year, city, venue,
                       TRY_CAST(date AS DATE) AS match_date, team1, team2, toss_winner,
                       toss_decision, winner AS match_winner, win_by_runs, win_by_wickets,
                       player_of_match
                FROM clean_matches))
        WHERE place = 1""",
    "dim_teams": """
        SELECT row_number() OVER (ORDER BY team_name) AS team_id, team_name
        FROM (SELECT team1 AS team_name FROM clean_matches
              UNION SELECT team2 FROM clean_matches)
        WHERE team_name IS NOT NULL""",
    "dim_players": """
        SELECT row_number() OVER (ORDER BY player_name) AS player_id, player_name
        FROM (SELECT batsman AS player_name FROM clean_deliveries
              UNION SELECT bowler FROM clean_deliveries)""",
    "dim_seasons": """
        SELECT row_number() OVER (ORDER BY season_year) AS season_id, season_year
        FROM (SELECT DISTINCT season AS season_year FROM clean_matches)
        WHERE season_year IS NOT NULL""",
    "fact_deliveries": """
        SELECT d.match_id, m.season_year AS season, inning, batting_team, bowling_team,
               "over", ball, batsman, non_striker, bowler,
               batsman_runs, extra_runs, total_runs,
               CAST(coalesce(batsman_runs, 0) IN (4, 6) AS INTEGER) AS is_boundary,
               CAST(coalesce(batsman_runs, 0) = 4 AS INTEGER) AS is_four,
               CAST(coalesce(batsman_runs, 0) = 6 AS INTEGER) AS is_six,
               CAST(coalesce(total_runs, 1) = 0 AS INTEGER) AS is_dot_ball,
               CAST(player_dismissed IS NOT NULL AS INTEGER) AS is_wicket,
               player_dismissed, dismissal_kind
        FROM clean_deliveries d LEFT JOIN dim_matches m ON d.match_id = m.match_id""",
    "batting_stats": """
        SELECT batsman, season, total_runs, balls_faced, boundaries, fours, sixes, matches_played,
               round(total_runs * 10000 / nullif(balls_faced, 0)) / 100 AS strike_rate,
               round(total_runs * 100 / nullif(matches_played, 0)) / 100 AS batting_average
        FROM (
            SELECT batsman, season, CAST(sum(batsman_runs) AS BIGINT) AS total_runs,
                   count(ball) AS balls_faced,
                   CAST(sum(is_boundary) AS BIGINT) AS boundaries,
                   CAST(sum(is_four) AS BIGINT) AS fours, CAST(sum(is_six) AS BIGINT) AS sixes,
                   count(DISTINCT match_id) AS matches_played
            FROM fact_deliveries GROUP BY batsman, season)""",
    "bowling_stats": """
        SELECT bowler, season, wickets, runs_conceded, balls_bowled, dot_balls, matches_played,
               round(balls_bowled * 10 / 6) / 10 AS overs_bowled,
               round(runs_conceded * 600 / nullif(balls_bowled, 0)) / 100 AS economy_rate,
               round(runs_conceded * 100 / nullif(wickets, 0)) / 100 AS bowling_average,
               round(dot_balls * 10000 / nullif(balls_bowled, 0)) / 100 AS dot_ball_pct
        FROM (
            SELECT bowler, season, CAST(sum(is_wicket) AS BIGINT) AS wickets,
                   CAST(sum(total_runs) AS BIGINT) AS runs_conceded,
                   count(ball) AS balls_bowled, CAST(sum(is_dot_ball) AS BIGINT) AS dot_balls,
                   count(DISTINCT match_id) AS matches_played
            FROM fact_deliveries GROUP BY bowler, season)""",
}

REPORTS = {
    "top_run_scorers": """
        SELECT batsman, CAST(sum(batsman_runs) AS BIGINT) AS total_runs,
               count(DISTINCT match_id) AS matches,
               round(sum(batsman_runs) * 10000 / nullif(count(ball), 0)) / 100 AS strike_rate,
               CAST(sum(is_six) AS BIGINT) AS sixes, CAST(sum(is_four) AS BIGINT) AS fours
        FROM fact_deliveries GROUP BY batsman ORDER BY total_runs DESC, batsman LIMIT 10""",
    "top_wicket_takers": """
        SELECT bowler, CAST(sum(is_wicket) AS BIGINT) AS wickets,
               CAST(sum(total_runs) AS BIGINT) AS runs_conceded,
               round(sum(total_runs) * 600 / nullif(count(ball), 0)) / 100 AS economy_rate,
               round(sum(total_runs) * 100 / nullif(sum(is_wicket), 0)) / 100 AS bowling_average,
               round(sum(is_dot_ball) * 10000 / nullif(count(ball), 0)) / 100 AS dot_ball_pct
        FROM fact_deliveries GROUP BY bowler ORDER BY wickets DESC, bowler LIMIT 10""",
    "season_totals": """
        SELECT season, CAST(sum(total_runs) AS BIGINT) AS total_runs,
               count(DISTINCT match_id) AS total_matches,
               round(sum(total_runs) * 100 / count(DISTINCT match_id)) / 100 AS avg_runs_per_match
        FROM fact_deliveries GROUP BY season ORDER BY season NULLS FIRST""",
    "team_wins": """
        SELECT match_winner AS team, count(*) AS wins FROM dim_matches
        WHERE match_winner IS NOT NULL GROUP BY match_winner ORDER BY wins DESC, team""",
    "toss_impact": """
        SELECT toss_decision, count(*) AS total_matches,
               count(*) FILTER (WHERE toss_winner = match_winner) AS toss_wins_match,
               round(count(*) FILTER (WHERE toss_winner = match_winner) * 10000 / count(*)) / 100
                   AS win_pct_after_toss
        FROM dim_matches WHERE toss_winner IS NOT NULL AND match_winner IS NOT NULL
        GROUP BY toss_decision""",
    "top_venues": """
        SELECT venue, city, count(*) AS matches_hosted FROM dim_matches GROUP BY venue, city
        ORDER BY matches_hosted DESC, venue NULLS FIRST, city NULLS FIRST LIMIT 10""",
    "best_strike_rates": """
        SELECT batsman, CAST(sum(batsman_runs) AS BIGINT) AS runs, count(ball) AS balls_faced,
               round(sum(batsman_runs) * 10000 / count(ball)) / 100 AS strike_rate
        FROM fact_deliveries GROUP BY batsman HAVING count(ball) >= 590
        ORDER BY strike_rate DESC, batsman LIMIT 10""",
    "most_sixes_in_season": """
        SELECT batsman, season, CAST(sum(is_six) AS BIGINT) AS sixes
        FROM fact_deliveries GROUP BY batsman, season
        ORDER BY sixes DESC, batsman, season NULLS FIRST LIMIT 10""",
    "powerplay_economy": """
        SELECT bowler, count(DISTINCT match_id) AS matches,
               round(sum(total_runs) * 600 / count(ball)) / 100 AS powerplay_economy
        FROM fact_deliveries WHERE "over" BETWEEN 1 AND 2
        GROUP BY bowler HAVING count(ball) >= 165
        ORDER BY powerplay_economy NULLS FIRST, bowler LIMIT 10""",
    "player_of_match": """
        SELECT player_of_match, count(*) AS awards FROM dim_matches
        WHERE player_of_match IS NOT NULL GROUP BY player_of_match
        ORDER BY awards DESC, player_of_match LIMIT 10""",
    "milestones": """
        SELECT batsman, count(*) FILTER (WHERE runs >= 12) AS centuries,
               count(*) FILTER (WHERE runs BETWEEN 6 AND 11) AS half_centuries
        FROM (SELECT batsman, match_id, inning, sum(batsman_runs) AS runs
              FROM fact_deliveries GROUP BY batsman, match_id, inning)
        GROUP BY batsman""",
    "win_loss": """
        SELECT team, count(*) AS played,
               count(*) FILTER (WHERE match_winner = team) AS won,
               count(*) FILTER (WHERE match_winner <> team AND match_winner = other) AS lost,
               count(*) FILTER (WHERE match_winner IS NULL) AS no_result,
               count(*) FILTER (WHERE match_winner <> team AND match_winner IS DISTINCT FROM other) AS unclear
        FROM (SELECT team1 AS team, team2 AS other, match_winner FROM dim_matches
              UNION ALL SELECT team2, team1, match_winner FROM dim_matches)
        WHERE team IS NOT NULL GROUP BY team""",
    "season_top_batters": """
        SELECT season, CAST(place AS INTEGER) AS rank, batsman, total_runs
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY season ORDER BY total_runs DESC, batsman) AS place
              FROM batting_stats) WHERE place <= 10""",
    "season_top_bowlers": """
        SELECT season, CAST(place AS INTEGER) AS rank, bowler, wickets
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY season ORDER BY wickets DESC, bowler) AS place
              FROM bowling_stats) WHERE place <= 10""",
    "venue_scoring": """
        SELECT venue, city, count(DISTINCT match_id) AS matches,
               CAST(sum(total_runs) AS BIGINT) AS total_runs,
               CAST(sum(is_wicket) AS BIGINT) AS wickets,
               round(sum(total_runs) * 100 / count(DISTINCT match_id)) / 100 AS avg_runs_per_match
        FROM fact_deliveries LEFT JOIN dim_matches USING (match_id) GROUP BY venue, city""",
    "runs_per_dismissal": """
        SELECT batsman, total_runs, coalesce(dismissals, 0) AS dismissals,
               round(total_runs * 100 / nullif(coalesce(dismissals, 0), 0)) / 100
                   AS runs_per_dismissal
        FROM (SELECT batsman, CAST(sum(batsman_runs) AS BIGINT) AS total_runs
              FROM fact_deliveries GROUP BY batsman)
        LEFT JOIN (SELECT player_dismissed, count(*) AS dismissals FROM fact_deliveries
                   WHERE player_dismissed IS NOT NULL GROUP BY player_dismissed)
        ON batsman = player_dismissed""",
}


_COUNT = "SELECT '{0}' AS table_name, count(*) AS row_count FROM {0}"
_TABLES = [name for name in PARTS if not name.startswith(("raw_", "clean_"))]

CHECKS = {
    "table_counts": " UNION ALL ".join(_COUNT.format(name) for name in _TABLES),
    "load_after_failure": " UNION ALL ".join(_COUNT.format(name) for name in _TABLES),
    "created_tables": " UNION ALL ".join(
        [_COUNT.format("dim_matches"), _COUNT.format("fact_deliveries"),
         "SELECT 'dim_seasons' AS table_name, 0 AS row_count"]
    ),
    "dim_matches_sql": "SELECT * FROM dim_matches",
    "fact_deliveries_sql": "SELECT * FROM fact_deliveries",
    "csv_round_trip": "SELECT * FROM raw_deliveries",
    "csv_multi_line": """
        SELECT * REPLACE (venue || ', "' || city || '"' || chr(10)
            || CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN chr(10) || chr(10) ELSE '' END || 'end' AS venue)
        FROM raw_matches""",
    "table_round_trip": "SELECT * FROM dim_matches",
    "fact_by_season": "SELECT * FROM fact_deliveries",
    "fact_by_curve": "SELECT * FROM fact_deliveries",
    "created_matches": "SELECT * FROM dim_matches",
    "created_deliveries": "SELECT * FROM fact_deliveries",
    **{f"flow_{name}": f"SELECT * FROM {name}" for name in _TABLES},
    "flow_after_failure": "SELECT * FROM fact_deliveries",
}


# ---- files with careless text and faulty lines -------------------------------


def _as_read(columns: dict[str, str], faults: dict[str, str], raw: str) -> str:
    """Rows of such a file as a reader sees them, with the fault of each."""
    *most, last = columns
    fault = " ".join(f"WHEN {rows} THEN '{name}'" for name, rows in faults.items())
    read = ", ".join(f"nullif(nullif({sql}, 'NA'), '') AS \"{name}\"" for name, sql in columns.items() if name != last)
    end = f"CASE fault WHEN 'too few fields' THEN NULL WHEN 'unclosed quote' THEN '{mapping.OPEN}' ELSE nullif(nullif({columns[last]}, 'NA'), '') END"
    return f"""
        SELECT {read}, {end} AS \"{last}\", fault
        FROM (SELECT *, CASE {fault} END AS fault FROM ({raw}))"""


def _whole(text: str, kind: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '^([0-9]+)(\\.[0-9]*)?$', 1), '') AS {kind})"


def _key(text: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '^([0-9]+)(\\.0*)?$', 1), '') AS BIGINT)"


def _cleansed(columns: dict[str, str], kinds: dict[str, str], key: str, source: str, required: tuple[str, ...] = ()) -> str:
    forms = {key: _key(key)} | {c: _whole(f'"{c}"', k) for c, k in kinds.items() if k == "int"}
    items = ", ".join(f'{forms.get(c, chr(34) + c + chr(34))} AS "{c}"' for c in columns)
    keep = " AND ".join([f"{_key(key)} IS NOT NULL", *[f"{c} IS NOT NULL" for c in required]])
    return f"SELECT DISTINCT {items} FROM {source} WHERE {keep}"


_DATE = "TRY_CAST(regexp_replace(regexp_replace(date, '-([0-9])-', '-0\\1-'), '-([0-9])$', '-0\\1') AS DATE)"

SLOPPY = PARTS | {
    "sloppy_matches": _as_read(mapping.SLOPPY_MATCHES, mapping.MATCH_FAULTS, PARTS["raw_matches"]),
    "sloppy_deliveries": _as_read(mapping.SLOPPY_DELIVERIES, mapping.DELIVERY_FAULTS, PARTS["raw_deliveries"]),
    "clean_matches": _cleansed(mapping.SLOPPY_MATCHES, schemas.RAW_MATCHES, "id", "sloppy_matches"),
    "clean_deliveries": _cleansed(
        mapping.SLOPPY_DELIVERIES, schemas.RAW_DELIVERIES, "match_id", "sloppy_deliveries", ("batsman", "bowler")
    ),
    "dim_matches": PARTS["dim_matches"].replace("TRY_CAST(date AS DATE)", _DATE),
}

_REASONS = [
    ("matches", "id is missing", "id IS NULL", f"{_key('id')} IS NULL"),
    ("matches", "id is no whole number", f"id IS NOT NULL AND {_key('id')} IS NULL", "true"),
    ("deliveries", "match_id is no whole number", f"{_key('match_id')} IS NULL", "true"),
    ("deliveries", "bowler is missing", "bowler IS NULL", "true"),
    *[("matches", fault, f"fault = '{fault}'", f"{_key('id')} IS NULL") for fault in mapping.MATCH_FAULTS],
    *[
        ("deliveries", fault, f"fault = '{fault}'", f"({_key('match_id')} IS NULL OR bowler IS NULL)")
        for fault in mapping.DELIVERY_FAULTS
    ],
]
_REJECTED = " UNION ALL ".join(
    f"SELECT '{file}' AS file, '{reason}' AS reason, {refused} AS refused, count(*) AS row_count "
    f"FROM sloppy_{file} WHERE {rows} GROUP BY ALL"
    for file, reason, rows, refused in _REASONS
)

SLOPPY_CHECKS = {
    "rejected_rows": _REJECTED,
    "sloppy_dim_matches": "SELECT * FROM dim_matches",
    "sloppy_dim_matches_sql": "SELECT * FROM dim_matches",
    "sloppy_fact_deliveries": "SELECT * FROM fact_deliveries",
    "sloppy_fact_deliveries_sql": "SELECT * FROM fact_deliveries",
    "sloppy_batting_stats": "SELECT * FROM batting_stats",
}


def _with_parts(sql: str, parts: dict[str, str] = PARTS) -> str:
    """``sql`` preceded by all named parts; the engine skips the unused ones."""
    named = ", ".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {named} {sql}"


def _ordered(parts: dict[str, str]) -> dict[str, str]:
    """Parts so that each uses only earlier ones: what is read comes first."""
    first = [name for name in parts if name.startswith(("raw_", "sloppy_"))]
    return {name: parts[name] for name in [*first, *(n for n in parts if n not in first)]}


def statements() -> dict[str, str]:
    tables = {name: _with_parts(f"SELECT * FROM {name}") for name in PARTS}
    sloppy = {name: _with_parts(sql, _ordered(SLOPPY)) for name, sql in SLOPPY_CHECKS.items()}
    return tables | sloppy | {name: _with_parts(sql) for name, sql in (REPORTS | CHECKS).items()}
