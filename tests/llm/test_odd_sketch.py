import re

import numpy as np
import pytest

from tallyline.llm import odd_sketch as O
from tallyline.llm.arrowtext import SLICE_BYTES, word_hashes
from tallyline.llm.components import components
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    least = {i: i for i in sets}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                least[q] = p
    out = [(i, len(shingles(t, width)), None if i is None else top(i), None if i is None else top(i) == i) for i, t in rows]
    return sorted(out, key=repr)


def edits(base, share, seed):
    draw = np.random.default_rng(seed)
    words = base.split()
    for at in draw.choice(len(words), int(share * len(words)), replace=False):
        words[at] = f"edit{draw.integers(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force(spark, width):
    base = prose(50, 150)
    rows = awkward() + [(100 + k, edits(base, 0.01 * (k % 12), k)) for k in range(90)]
    assert rows_of(O.near_duplicates(clashing(documents(spark, rows)), width)) == brute(rows, width)


def test_tiles(spark, monkeypatch):
    """A group in many blocks: chains of edits that the hub alone does not link."""
    monkeypatch.setattr(O, "TILE_ROWS", 7)
    base = prose(51, 120)
    rows = [(k, edits(base, 0.005 * k, 7)) for k in range(40)]
    assert rows_of(O.near_duplicates(documents(spark, rows), 2)) == brute(rows, 2)


def test_equals_brute_force_on_sample(spark):
    docs = sample_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(O.near_duplicates(docs, 2)) == brute(rows, 2)


def test_empty_table(spark):
    assert O.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = dict(rows_of(components(spark.createDataFrame(links, "u long, v long"))))
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 130)) and len(got) == 70


def test_sketch_estimates_distance():
    draw = np.random.default_rng(0)
    common = draw.integers(0, 2**62, 900, dtype=np.uint64)
    a, b = (O.odd_sketch(O.minhashes(np.concatenate([common, draw.integers(0, 2**62, n, dtype=np.uint64)]))) for n in (50, 60))
    assert np.bitwise_count(a ^ b).sum() <= O.most_bits(0.8)
    c = O.odd_sketch(O.minhashes(draw.integers(0, 2**62, 900, dtype=np.uint64)))
    assert np.bitwise_count(a ^ c).sum() > O.most_bits(0.8)


def test_words_of_very_long_texts():
    words = prose(1, 30_000).split()
    text = " ".join(words * 40 + ["y" * (3 * SLICE_BYTES // 2)])
    data = np.frombuffer(text.encode() * 1, np.uint8)
    assert len(data) > 4 * SLICE_BYTES
    hashes, bounds = word_hashes(data, np.array([0, len(data)]))
    part = np.frombuffer(" ".join(words).encode(), np.uint8)
    few, _ = word_hashes(part, np.array([0, len(part)]))
    assert bounds[1] == len(words) * 40 + 1 and (hashes[: len(few)] == few).all()
    assert (hashes[len(few) : 2 * len(few)] == few).all()
