import datetime as dt
import random
import re
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where, percentage, ratio
from tallyline.functions.season import (
    CURRENT_PHRASES, NEXT_PHRASES, PREVIOUS_PHRASES, in_season, parse_season, season_bounds, season_label, season_of_date,
)
from tallyline.functions.statements import judge_statements, strip_fences
from tallyline.functions.text import BLANKS, strip, text_chunks
from tallyline.functions.vectors import cosine_distance, cosine_similarity
from tallyline.plans.tools import current_season, resolve_season

TODAY = dt.date(2031, 2, 10)
THIS = 2030  # the season that TODAY falls in


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def days():
    """First, middle and last day of every month of five years."""
    firsts = [dt.date(y, m, 1) for y in range(2027, 2032) for m in range(1, 13)]
    return [d for f in firsts for d in (f, f + dt.timedelta(days=14), f - dt.timedelta(days=1))]


@pytest.mark.parametrize("cut", [7, 8])
def test_season_begins_with_its_cut_month(spark, cut):
    frame = spark.createDataFrame([(d,) for d in days()], "d date")
    rows = frame.select("d", season_of_date(F.col("d"), cut).alias("start")).collect()
    assert len(rows) == len(days())
    for r in rows:
        assert r.start == (r.d.year if r.d.month >= cut else r.d.year - 1)


def test_current_season_agrees_with_the_column(spark):
    for day in days()[::7]:
        assert current_season(day) == one(spark, season_of_date(day))


def phrases():
    """(text, season) from the rule: words by offset, counted seasons, years and spans, and noise."""
    for offset, words in ((0, CURRENT_PHRASES), (-1, PREVIOUS_PHRASES), (1, NEXT_PHRASES)):
        for word in words:
            yield from ((shaped, THIS + offset) for shaped in (word, word.upper(), word.title(), f" \t{word}\n"))
    for n in range(13):
        yield f"{n} season{'s' * (n != 1)} ago", THIS - n
    for year in range(1996, 2034, 4):
        after = year + 1
        yield from ((t, year) for t in (f"{year}", f" {year} ", f"{year}-{after}", f"{year}/{after % 100:02d}"))
        yield from ((t, THIS) for t in (f"in {year}", f"the {year}-{after} one"))
    yield from ((noise, THIS) for noise in ("", "soon", "19", "ago 3 seasons", "-", "last"))


def test_parse_season(spark):
    cases = dict(phrases())
    frame = spark.createDataFrame([(p,) for p in cases], "phrase string")
    rows = frame.select("phrase", parse_season(F.col("phrase"), TODAY).alias("start")).collect()
    assert {r.phrase: r.start for r in rows} == cases


def test_resolve_season_labels_the_century(spark):
    frame = spark.createDataFrame([(str(y),) for y in range(1990, 2012)], "ref string")
    for r in resolve_season(frame, "ref", TODAY).collect():
        assert r.season_start_year == int(r.ref)
        assert r.season_label == f"{r.ref}/{str(int(r.ref) + 1)[-2:]}" == one(spark, season_label(F.lit(int(r.ref))))


def test_season_bounds_are_half_open(spark):
    frame = spark.createDataFrame([(d,) for d in days()], "d date")
    for start in (2028, 2029):
        first, after = season_bounds(start)
        assert (first.year, after.year, first.day, after.day) == (start, start + 1, 1, 1) and first.month == after.month
        inside = {r.d for r in frame.filter(in_season(F.col("d"), start)).collect()}
        assert inside == {d for d in days() if first <= d < after}


def test_ratio_rounds_half_up_exactly(spark):
    pairs = [(a, b) for b in range(0, 60) for a in range(0, 60)]
    rows = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", ratio(F.col("a"), F.col("b"), 2).alias("r"), percentage(F.col("a"), F.col("b")).alias("p")
    )
    for r in rows.collect():
        if r.b == 0:
            assert r.r is None and r.p is None
        else:
            assert r.r == ((200 * r.a + r.b) // (2 * r.b)) / 100
            assert r.p == ((2000 * r.a + r.b) // (2 * r.b)) / 10


def test_count_where_treats_null_as_no(spark):
    rows = spark.createDataFrame([(True,), (None,), (False,)], "c boolean")
    assert rows.agg(count_where(F.col("c"))).first()[0] == 1
    assert rows.filter("false").agg(count_where(F.col("c"))).first()[0] == 0


# -- text ------------------------------------------------------------------------------


GAP = re.compile(r"(?<=[.!?])\s+")


def follows_the_rule(text, size, chunks):
    """Every character in order, nothing too long but a lone sentence, no sentence that still fitted before."""
    assert " ".join(chunks) == GAP.sub(" ", text.strip())
    for c in chunks:
        assert len(c) <= size or not GAP.search(c)
    for left, right in pairwise(chunks):
        assert len(left) + 1 + len(GAP.split(right)[0]) > size
        assert left[-1] in ".!?"


def chunk(spark, texts, size):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return [r.c for r in frame.select("id", text_chunks(F.col("t"), size).alias("c")).orderBy("id").collect()]


def test_texts_up_to_the_size_stay_whole(spark):
    texts = ["Goalless at the harbour.", "Rain stopped play! Was it ever on? They left.", "", " \n ", "no stop"]
    assert chunk(spark, texts, 60) == [[t] if t.strip() else [] for t in texts]
    assert chunk(spark, texts[1:2], 10) == [["Rain stopped play!", "Was it ever on?", "They left."]]


def test_chunks_follow_the_packing_rule(spark):
    rng = random.Random(3)
    blanks = [" ", "  ", "\n", " ", "\x1f ", "　", "\t\r\n"]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(rng.randrange(0, 60)):
            word = "".join(rng.choice("abé.!?x😀\n") for _ in range(rng.randrange(1, 30)))
            words.append(word + rng.choice(["", ".", "!", "?", "..."]) + rng.choice(blanks))
        texts.append(rng.choice(blanks) + "".join(words))
    for size in (1, 20, 40, 300):
        for text, chunks in zip(texts, chunk(spark, texts, size), strict=True):
            follows_the_rule(text, size, chunks)


def test_chunks_of_a_long_text_keep_every_character(spark):
    sentence = "word " * 11 + "end. "
    text = sentence * 20_000 + "x" * 500_000 + ". Done."
    follows_the_rule(text, 300, chunk(spark, [text], 300)[0])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="aZ .!?\n\t é", max_size=200), min_size=30, max_size=30))
def test_chunks_property(spark, texts):
    for text, chunks in zip(texts, chunk(spark, texts, 25), strict=True):
        follows_the_rule(text, 25, chunks)


def test_blanks_are_pythons(spark):
    assert set(BLANKS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert one(spark, strip(F.lit(f"{BLANKS}a b{BLANKS}"))) == "a b"


# -- vectors ---------------------------------------------------------------------------


def test_cosine(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([-4.0, 3.0],)], "v array<float>")
    query = F.array(F.lit(3.0), F.lit(4.0))
    assert [r[0] for r in rows.select(cosine_similarity(F.col("v"), query)).collect()] == [1.0, None, 0.0]
    assert [r[0] for r in rows.select(cosine_distance(F.col("v"), query)).collect()] == [0.0, None, 1.0]


# -- statements ------------------------------------------------------------------------

MART = "select team_name from marts.mart_league_table"
STATEMENTS = {
    MART: None,
    f"  {MART};  ": None,
    f"-- drop nothing\n{MART}": None,
    f"with t as ({MART}) select * from t": None,
    "": "Empty query",
    "  \n": "Empty query",
    "drop table marts.mart_league_table": "Only SELECT statements are allowed (got DROP)",
    "with t as (select 1) delete from marts.x": "Only SELECT statements are allowed (got DELETE)",
    "hello": "Only SELECT statements are allowed (got UNKNOWN)",
    f"{MART}; {MART}": "Only one statement is allowed",
    f"{MART} where team_name = '--'; {MART}": "Only one statement is allowed",
    f"{MART} where team_name = '/*' -- it's */ ; {MART}": None,
    f"{MART} where team_name = 'drop it'": r"Forbidden keyword detected: \bdrop\b",
    f"{MART} where pg_sleep(1)": r"Forbidden keyword detected: \bpg_",
    f"{MART} where a = 'x;y'": None,
    "select backdrop from marts.t": None,
    "select 1": "Query must reference at least one marts. table",
}


def test_statement_rules(spark):
    frame = spark.createDataFrame([(s,) for s in STATEMENTS], "s string")
    assert {r.s: r.problem for r in judge_statements(frame, "s").collect()} == STATEMENTS


def test_statement_tables(spark):
    texts = [MART, "select * from marts.secret", "select marts.x from parquet.`/etc`", f"with t as ({MART}) select * from t"]
    frame = spark.createDataFrame([(s,) for s in texts], "s string")
    problems = [r.problem for r in judge_statements(frame, "s", ["mart_league_table"]).collect()]
    refused = "Query may only read the known marts"
    assert problems == [None, refused, refused, None]


def test_strip_fences(spark):
    for text in ("```sql\nselect 1\n```", "select 1", "```\nselect 1```", " select 1 \n"):
        assert one(spark, strip_fences(F.lit(text))) == "select 1"
