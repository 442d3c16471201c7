"""Hand-made matches: raw rows and the mart rows a plain reading of the rules gives."""

from __future__ import annotations

import datetime as dt
import random

MATCH_SCHEMA = (
    "match_id bigint, match_date date, matchday int, season_id bigint, competition_id bigint,"
    " competition_name string, competition_code string, home_team_id bigint, home_team_name string,"
    " away_team_id bigint, away_team_name string, home_goals int, away_goals int, home_goals_ht int,"
    " away_goals_ht int, total_goals int, goal_diff int, total_goals_ht int, result string,"
    " ht_leader string, is_high_scoring boolean, is_ht_lead_dropped boolean"
)


def _sign(a, b):
    if a is None or b is None:
        return None
    return "home" if a > b else "away" if b > a else "draw"


def mart_row(mid, day, comp, home, away, score, half=(0, 0), matchday=1):
    hg, ag = score
    hh, ah = half
    result, leader = _sign(hg, ag), _sign(hh, ah)
    total = None if hg is None else hg + ag
    dropped = leader in ("home", "away") and result is not None and result != leader
    start = day.year - (day.month < 7)
    return (
        mid, day, matchday, comp * 10000 + start, comp, f"League {comp}", f"L{comp}",
        home, f"Team {home}", away, f"Team {away}", hg, ag, hh, ah, total,
        None if hg is None else hg - ag, hh + ah, result, leader,
        total is not None and total >= 4, dropped,
    )


def _rows():
    rng = random.Random(7)
    rows = []
    for mid in range(1, 121):
        home, away = rng.sample(range(1, 7), 2)
        day = dt.date(2023, 8, 1) + dt.timedelta(days=rng.randrange(0, 40) * 9)
        score = (rng.randrange(0, 4), rng.randrange(0, 4))
        half = (min(score[0], rng.randrange(0, 3)), min(score[1], rng.randrange(0, 3)))
        rows.append(mart_row(mid, day, rng.choice([1, 1, 1, 2]), home, away, score, half, rng.randrange(1, 5)))
    rows.append(mart_row(500, dt.date(2023, 9, 1), 1, 1, 2, (None, None), (0, 0)))
    rows.append(mart_row(501, dt.date(2024, 7, 1), 1, 1, 2, (3, 6), (1, 3), 18))
    rows.append(mart_row(502, dt.date(2024, 6, 30), 2, 5, 6, (1, 1), (1, 0), 38))
    return rows


MATCH_ROWS = _rows()
NAMES = [c.split()[0] for c in MATCH_SCHEMA.split(",")]
MATCH_DICTS = [dict(zip(NAMES, r)) for r in MATCH_ROWS]


def legs():
    """Every match from both sides, by hand."""
    out = []
    for m in MATCH_DICTS:
        for side, other in (("home", "away"), ("away", "home")):
            r = m["result"]
            out.append(
                {
                    "match_id": m["match_id"], "match_date": m["match_date"], "season_id": m["season_id"],
                    "competition_id": m["competition_id"], "competition_code": m["competition_code"],
                    "venue": side, "team_id": m[f"{side}_team_id"], "team_name": m[f"{side}_team_name"],
                    "opponent": m[f"{other}_team_name"],
                    "gf": m[f"{side}_goals"], "ga": m[f"{other}_goals"],
                    "team_result": None if r is None else "draw" if r == "draw" else "win" if r == side else "loss",
                    "points": 3 if r == side else 1 if r == "draw" else 0,
                }
            )
    return out
