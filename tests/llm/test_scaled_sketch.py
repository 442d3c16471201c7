import hashlib

import numpy as np

from tallyline.llm import scaled_sketch as K
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents
from tests.llm.test_odd_sketch import shingles


def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edited_texts(spark):
    rows = awkward()
    got = K.edited_likeness(clashing(documents(spark, rows)))
    assert rows_of(got.select("doc_id", "n_chars", "edited_sha256")) == edited(rows)
    same = {r["fingerprint"] for r in got.filter("doc_id in (0, 4, 12)").collect()}
    assert len(same) == 1
    assert got.filter("near_edited < 0 or near_edited > 1 or near_next < 0 or near_next > 1").count() == 0


def test_edited_texts_on_sample(spark):
    docs = sample_documents(spark).repartition(7)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = K.edited_likeness(docs)
    assert rows_of(got.select("doc_id", "n_chars", "edited_sha256")) == edited(rows)
    # Likeness of sketches is close to that of the full sets in the mean.
    ordered, errors = sorted(rows), []
    near = {r["doc_id"]: r["near_edited"] for r in got.collect()}
    for k, (i, t) in enumerate(ordered):
        half = len(t) // 2
        a, b = shingles(t, 5), shingles(t[: len(t) - half] + ordered[(k + 1) % len(ordered)][1][:half], 5)
        errors.append(near[i] - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.03


def test_one_row_and_no_row(spark):
    (row,) = K.edited_likeness(documents(spark, [(5, "some words of one text here")])).collect()
    assert row["near_next"] == 1.0
    assert K.edited_likeness(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows_of(K.fingerprints(documents(spark, [(1, None), (2, "a b")])))[0] == (1, "")


def test_sketches_merge_and_contain():
    a, b = prose(1, 3000), prose(2, 300)
    big, small, both = K.sketches([a, b, a + " " + b])
    joined = K.merged(big, small)
    assert len(np.setdiff1d(joined, both)) == 0
    likeness, contained = K.shares(small, both)
    assert contained == 1.0 and likeness < 0.3
    assert (K.read(K.written(big)) == big).all()
    assert K.shares(K.sketches([""])[0], small) == (0.0, 1.0)
