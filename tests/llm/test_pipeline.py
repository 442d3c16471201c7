import hashlib
import random
import re

import duckdb
import pytest

import corpus_pipeline
from tallyline.llm import queries
from tests.llm.corpora import DIRECTORY, SCHEMA, awkward, documents, prose, rows_of
from tests.llm.test_odd_sketch import brute as groups
from tests.llm.test_skip_chain import brute as base_spans
from tests.llm.test_suffix_levels import brute as repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_on_sample(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.stored(stages["language"](spark, docs, DIRECTORY), "t")
    assert kept.columns == COLUMNS and docs.count() - 2 <= kept.count() <= docs.count()

    deduped = corpus_pipeline.stored(stages["near_dedup"](spark, kept, DIRECTORY), "t")
    assert {i for i, _ in pairs(deduped)} == {i for i, _, _, own in groups(pairs(kept), 5) if own}

    cut = corpus_pipeline.stored(stages["suffix_dedup"](spark, deduped, DIRECTORY), "t")
    left = {r[0]: r[4] for r in repeats(pairs(deduped))}
    changed = 0
    for r in cut.collect():
        same = hashlib.sha256(r["text"].encode()).hexdigest() == left[r["doc_id"]]
        changed += not same  # only where a character was cut in two
        assert r["n_chars"] == len(r["text"])
    assert changed <= 0.2 * len(left)

    clean = corpus_pipeline.stored(stages["pii"](spark, cut, DIRECTORY), "t")
    before = dict(pairs(cut))
    for i, text in pairs(clean):
        assert not any(s.startswith(("email", "phone")) for s in base_spans(re.sub("<[A-Z]+>", " ", text)))
        assert text == before[i] or re.search("<(EMAIL|IP|CARD|PHONE)>", text)

    packed = stages["packing"](spark, clean, DIRECTORY)
    assert {r["doc_id"] for r in packed.collect()} == set(before)


def test_language_drops_what_is_in_none(spark):
    """Random letters go; short texts, odd words and unlabelled prose stay."""
    draw = random.Random(8)
    noise = ["".join(draw.choice("qxzjkvwyQXZ#%&@!") for _ in range(n)) for n in (400, 2000, 9000)]
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    extra = [(10**6 + k, t, None, "s", 1) for k, t in enumerate(noise)]
    extra += [(2 * 10**6, "A.", "en", "s", 1), (2 * 10**6 + 1, "1234 5678", "en", "s", 1), (2 * 10**6 + 2, None, "en", "s", 1)]
    # A text without its label gets it back.
    plain = docs.filter("lang = 'en' and length(text) > 400").limit(1).first()
    extra.append((2 * 10**6 + 3, plain["text"], None, "s", 1))
    table = docs.select(COLUMNS).unionByName(spark.createDataFrame(extra, SCHEMA))
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language(spark, table, DIRECTORY).collect()}
    assert {i for i in kept if i >= 10**6} == {2 * 10**6, 2 * 10**6 + 3} and kept[2 * 10**6 + 3] == "en"
    assert len(kept) >= docs.count()


def test_near_dedup_tells_rows_apart(spark):
    base, other = prose(1, 80), prose(2, 80)
    rows = [
        (5, base), (5, base), (3, base), (7, other), (7, base + " more"), (None, other), (None, prose(3, 60)),
        (8, ""), (8, ""), (9, None), (9, None), (9, ""), (4, prose(4, 60)), (4, prose(5, 60)),
    ]
    kept = corpus_pipeline.near_dedup(spark, documents(spark, rows), DIRECTORY)
    assert kept.columns == COLUMNS
    assert sorted(pairs(kept), key=repr) == sorted(
        [(3, base), (7, other), (None, prose(3, 60)), (8, ""), (9, None), (9, ""), (4, prose(4, 60)), (4, prose(5, 60))], key=repr
    )


def test_run_on_sample(spark):
    assert corpus_pipeline.run(spark, DIRECTORY).count() >= 150


def test_awkward_rows_go_through(spark):
    docs = documents(spark, awkward())
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIRECTORY)
    assert docs.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, DIRECTORY)
        assert empty.columns == COLUMNS
    assert corpus_pipeline.STAGES[-1][1](spark, empty, DIRECTORY).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    cursor = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert rows_of(queries.QUERIES[name](spark, DIRECTORY).select(columns)) == sorted(cursor.fetchall(), key=repr)
