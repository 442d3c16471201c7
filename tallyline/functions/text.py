"""Report text as column expressions: sentence packing, prompts and context blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_SIZE = 300

# The characters that count as blank around and between sentences.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SENTENCE_GAP = f"([.!?])[{BLANKS}]++"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def text_chunks(text: Column, size: int = CHUNK_SIZE) -> Column:
    """Pack whole sentences into chunks of at most ``size`` characters.

    Sentences are joined by one space; a sentence longer than ``size`` is a chunk by itself.
    After every gap is reduced to one space, a chunk is the longest run of at most ``size``
    characters that ends at a gap, else the shortest longer run. That is one regular
    expression, linear in the text, with no growing array to copy.
    """
    joined = F.regexp_replace(strip(text), _SENTENCE_GAP, "$1 ")
    chunk = rf"(?s)(.{{1,{size}}}|.{{{size + 1},}}?)(?:(?<=[.!?]) |\z)"
    return F.regexp_extract_all(joined, F.lit(chunk), F.lit(1))


# The labels and line breaks of the two formats below, which their readers expect.


def match_prompt(preface: str = "") -> Column:
    """Fixed-format description of a mart_match_results row, for a report writer."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    def flag(name: str) -> Column:
        return F.when(F.col(name).isNull(), "None").when(F.col(name), "True").otherwise("False")

    return F.concat(
        F.lit(f"{preface}Match: "), shown("home_team_name"), F.lit(" "),
        shown("home_goals"), F.lit("-"), shown("away_goals"), F.lit(" "),
        shown("away_team_name"), F.lit(", HT: "), shown("home_goals_ht"), F.lit("-"),
        shown("away_goals_ht"), F.lit(", Matchday "), shown("matchday"), F.lit(", "),
        shown("competition_code"),
        F.lit("\nHalf-time leader: "),
        F.coalesce(F.nullif(F.col("ht_leader"), F.lit("")), F.lit("none")),
        F.lit("\nHT lead dropped: "), flag("is_ht_lead_dropped"),
        F.lit("\nHigh scoring: "), flag("is_high_scoring"),
        F.lit("\nWrite the match report:"),
    )


def context_entry() -> Column:
    """One retrieved chunk with its heading, as it appears inside a context block."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    return F.concat(
        F.lit("["), shown("home_team"), F.lit(" vs "), shown("away_team"), F.lit(", "),
        shown("competition_code"), F.lit(", "), shown("match_date"), F.lit(", similarity: "),
        F.round(F.col("similarity").cast("decimal(9,6)"), 2).cast("string"),
        F.lit("]\n"), F.col("chunk_text"), F.lit("\n\n"),
    )


CONTEXT_HEADING = "## Relevant match reports\n\n"
