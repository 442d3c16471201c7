"""Rules that decide whether a text is an acceptable read-only statement on the marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.once import evaluated_once
from tallyline.functions.text import strip

# Words that make a statement unacceptable, as they are shown in the reason; the texts of
# the other reasons below are fixed too.
FORBIDDEN = (
    r"\bdrop\b",
    r"\bdelete\b",
    r"\binsert\b",
    r"\bupdate\b",
    r"\btruncate\b",
    r"\balter\b",
    r"\bcreate\b",
    r"\bpg_",
)
VERBS = ("select", "insert", "update", "delete", "merge", "replace", "upsert", "create", "alter", "drop")

_LITERALS = r"'(?:[^']|'')*'"
#: A literal is consumed first and kept, so dashes inside quotes begin no comment.
_COMMENTS = rf"(?s)({_LITERALS})|--[^\n]*|/\*.*?\*/"
_TAIL = r"[\s;]+\z"


def strip_fences(text: Column) -> Column:
    """Drop a Markdown code fence around a statement."""
    opened = F.regexp_replace(strip(text), r"\A```[^\n]*\n?", "")
    return strip(F.regexp_replace(opened, r"```\z", ""))


def judge_statements(frame: DataFrame, column: str, tables: Iterable[str] | None = None) -> DataFrame:
    """Add ``statement_type`` and ``problem``: NULL if acceptable, else the first reason against.

    The type is the first verb, or for WITH the verb after the named queries. ``tables``
    limits which marts may be read.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    bare = F.lower(F.regexp_replace(text, _COMMENTS, "$1 "))
    cleaned = evaluated_once(frame, _bare=bare)

    first = F.regexp_extract("_bare", r"\A[\s(]*([a-z]+)", 1)
    after_with = F.regexp_extract("_bare", r"\)\s*(select|insert|update|delete|merge)\b", 1)
    body = F.regexp_replace(F.regexp_replace("_bare", _LITERALS, "''"), _TAIL, "")
    opened = evaluated_once(cleaned, _verb=F.when(first == "with", after_with).otherwise(first), _body=body)

    verb, body, bare = F.col("_verb"), F.col("_body"), F.col("_bare")
    kind = F.when(verb.isin(*VERBS), F.upper(verb)).otherwise("UNKNOWN")
    only_select = F.concat(F.lit("Only SELECT statements are allowed (got "), kind, F.lit(")"))
    problem = (
        F.when(~text.rlike(r"(?U)\S"), "Empty query")
        .when(kind != "SELECT", only_select)
        .when(body.contains(";"), "Only one statement is allowed")
        .when(bare.rlike("|".join(FORBIDDEN)), _first_forbidden(bare))
        .when(~bare.contains("marts."), "Query must reference at least one marts. table")
    )
    if tables is not None:
        sources = F.lit(r"\b(?:from|join)\s+([\w`./]+[.`][\w`./]*)")
        allowed = F.array(*[F.lit(f"marts.{t}") for t in tables])
        unknown = F.size(F.array_except(F.regexp_extract_all(body, sources, F.lit(1)), allowed)) > 0
        problem = problem.when(unknown, "Query may only read the known marts")
    judged = opened.withColumns({"statement_type": kind, "problem": problem})
    return judged.drop("_bare", "_verb", "_body")


def _first_forbidden(text: Column) -> Column:
    def reason(pattern: str) -> str:
        return f"Forbidden keyword detected: {pattern}"

    named = F.when(text.rlike(FORBIDDEN[0]), reason(FORBIDDEN[0]))
    for pattern in FORBIDDEN[1:]:
        named = named.when(text.rlike(pattern), reason(pattern))
    return named
