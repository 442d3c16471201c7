import hashlib
import random
import re

import numpy as np
import pytest

from tallyline.llm import wu_manber as W
from tests.llm.corpora import DIRECTORY, SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents

ITEMS = "item_id long, text string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        ws = words_of(text)
        k = min(width, len(ws))
        for i in range(len(ws) - k + 1 if k else 0):
            windows.setdefault(tuple(ws[i : i + k]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        ws, hit, found = words_of(text), set(), set()
        for k in sizes:
            for i in range(len(ws) - k + 1):
                owners = windows.get(tuple(ws[i : i + k]))
                if owners is not None:
                    hit.update(range(i, i + k))
                    found |= {str(o) for o in owners if o is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def pairs(frame, key):
    return [(r[key], r["text"]) for r in frame.collect()]


@pytest.mark.parametrize("block_bytes", [W.BLOCK_BYTES, 600])
def test_sample_equals_brute_force(spark, block_bytes):
    docs, items = sample_documents(spark), spark.read.parquet(f"{DIRECTORY}/benchmark.parquet")
    got = rows_of(W.digests(W.found(docs, items, block_bytes=block_bytes)))
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def planted():
    """Items of every length, with repeated ids and windows, none at all, odd letters and a null id."""
    base = prose(5, 60, 50)
    items = [
        (1, base), (2, " ".join(base.split()[20:45])), (2, "second text, of ITEM two!"), (3, "one"), (4, "x"),
        (5, "a b"), (6, None), (7, ""), (8, " .,- "), (9, "Größe 東京 wörter"), (None, "nobody owns this text"),
        (10, " ".join(base.split()[:9])), (11, "w" * 300 + " " + "v" * 500), (30, "two words"), (200, "two words"),
    ]
    docs = awkward() + [
        (100, base.upper().replace(" ", "; ")), (101, "x"), (102, "a b a b"), (103, "xx x"), (104, "größe 東京 WÖRTER"),
        (105, "Nobody owns this text? Größe"), (106, "GRÖSSE 東京"), (107, "one\x00one\x7fone"), (108, "second text of item"),
        (109, "second text of item two " * 50), (110, "w" * 300 + "." + "v" * 500 + " w"), (111, base + " " + base),
        (112, " ".join(base.split()[3:12])), (113, " ".join(base.split()[3:13])), (None, base), (None, "x one"),
    ]
    return docs, items


@pytest.mark.parametrize("block_bytes", [W.BLOCK_BYTES, 400])
@pytest.mark.parametrize("width", [10, 3])
def test_planted_cases_equal_brute_force(spark, block_bytes, width):
    docs, items = planted()
    frame = spark.createDataFrame(items, ITEMS)
    got = rows_of(W.digests(W.found(clashing(documents(spark, docs)), frame, width, block_bytes)))
    assert got == brute(docs, items, width)


def test_spans_and_columns(spark):
    docs = documents(spark, [(1, "zero one two three four"), (2, None)])
    items = spark.createDataFrame([(7, "ONE two"), (8, "two three"), (9, "four")], ITEMS)
    rows = {r["doc_id"]: r for r in W.found(docs, items).collect()}
    assert [tuple(s) for s in rows[1]["spans"]] == [(1, 5)] and sorted(rows[1]["items"]) == ["7", "8", "9"]
    assert rows[2]["n_words"] == 0 and rows[2]["spans"] == [] and rows[1]["text"] == "zero one two three four"


def test_long_items_are_cut_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(W, "PIECE_BYTES", 200)
    text = prose(9, 400, 5000)
    ws = text.split()
    docs = [(i, " ".join(ws[i : i + 10])) for i in range(391)]
    got = W.digests(W.found(documents(spark, docs), spark.createDataFrame([(1, text)], ITEMS), block_bytes=500))
    assert rows_of(got) == brute(docs, [(1, text)])


def test_long_texts_and_lanes(spark):
    """Strings that begin and end anywhere, also across lanes, in a text far beyond a slice."""
    draw = random.Random(4)
    passage = prose(21, 14, 3000)
    parts = [p for s in range(60) for p in (prose(100 + s, draw.randint(50, 700), 3000), passage)]
    long = " ".join(parts) * 20
    docs = [(1, long), (2, "short"), (3, passage)]
    got = rows_of(W.digests(W.found(documents(spark, docs), spark.createDataFrame([(1, passage)], ITEMS))))
    assert got == brute(docs, [(1, passage)]) and len(long) > W.SLICE_BYTES


def test_empty_tables(spark):
    docs, none = documents(spark, [(1, "some words here")]), spark.createDataFrame([], ITEMS)
    ((_, n_words, n_hit, n_items, _, dirty),) = rows_of(W.digests(W.found(docs, none)))
    assert (n_words, n_hit, n_items, dirty) == (3, 0, 0, False)
    assert W.found(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "x")], ITEMS)).count() == 0


def test_most_positions_are_skipped():
    items = [(str(i), W.normalised(np.frombuffer(prose(i, 30).encode(), np.uint8), np.array([0, len(prose(i, 30))]))[1:].tobytes()) for i in range(50)]
    for group in W.tables(items).classes:
        assert group.skip.mean() > 0.8 * (group.least - group.size + 1)
