import hashlib
import struct

import numpy as np
import pytest

from tallyline.llm import suffix_levels as S
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents


def brute(rows):
    """The contract, byte by byte; one document for fully repeated rows."""
    seen, done = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: -1 if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = True
            seen.add(window)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        done[doc_id, text] = (doc_id, len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return sorted((done[r] for r in rows), key=repr)


def passages():
    shared = prose(5, 60)
    return [(i, f"{prose(100 + i, 30)} {shared[i : 300 + i % 7]} {prose(200 + i, 20)}") for i in range(40)] + [
        (90, "ab" * 400), (91, "ab" * 60 + "c" + "ba" * 90), (92, shared[:100]), (93, shared[:99]), (94, "é" * 200),
    ]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_equals_brute_force(spark, batches):
    rows = awkward() + [(i + 100, t) for i, t in passages()]
    assert rows_of(S.removal(clashing(documents(spark, rows)), batches)) == brute(rows)


def test_equals_brute_force_on_sample(spark):
    docs = sample_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(S.removal(docs)) == brute(rows)


def test_long_text_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE_BYTES", 700)
    data = prose(3, 900).encode()
    text = np.frombuffer(data + data[100:2000], np.uint8)
    whole = S.runs(text, np.array([0, len(text)]))
    starts = np.concatenate([np.arange(a, a + n) for a, n in zip(whole[0], whole[1], strict=True)])
    assert (starts == np.arange(len(text) - 99)).all()


def test_empty_table(spark):
    assert S.removal(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    text = prose(9, 60)
    got = rows_of(S.removal(documents(spark, [(1, text), (1, text + " more")])).select("n_bytes", "n_removed"))
    assert sum(n for _, n in got) == len(text) and len(got) == 2


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_texts_of_one_id(spark, doc_id):
    shared = [prose(5000 + k, 60) for k in range(3)]
    own = [(prose(6000 + i, 20 + i % 30), prose(8000 + i, 25)) for i in range(900)]
    texts = [f"{head} {shared[i % 3][i % 50 :]} {end}" for i, (head, end) in enumerate(own)]
    texts = sorted(texts, key=lambda t: struct.unpack(">qq", hashlib.sha256(t.encode()).digest()[:16]))
    expected = sorted(r[1:] for r in brute(list(enumerate(texts))))
    docs = documents(spark, [(doc_id, t) for t in texts])
    got = S.removal(docs).collect()
    assert {r["doc_id"] for r in got} == {doc_id} and sorted(tuple(r)[1:] for r in got) == expected
    cleaned = [r["text"] for r in S.without_repeats(docs).collect()]
    kept = "\n".join(cleaned)
    assert all(head[:-12] in kept and end[12:] in kept for head, end in own)  # whatever text comes first; seams may agree by chance
    assert sorted(hashlib.sha256(t.encode()).hexdigest() for t in cleaned) == sorted(r[-1] for r in expected)


def test_levels_merge_geometrically(spark):
    index = S.SuffixLevels()
    for k in range(5):
        index.scan(documents(spark, [(10 * k + i, prose(10 * k + i, 60)) for i in range(3)]))
        assert sorted(index.levels) == [b for b in range(3) if (k + 1) >> b & 1]
    again, contested = index.scan(documents(spark, [(99, prose(21, 60))]))
    assert again.count() > 0 and contested.count() == 0


def test_cleaned_text(spark):
    docs = clashing(documents(spark, awkward()))
    cleaned = S.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert by_id[0] == prose(1, 120) and by_id[4] == "" and by_id[1] is None and by_id[12] == ""


def test_query_merges_levels(spark, monkeypatch):
    """Four batches by default: two levels become one before the third."""
    scan, seen = S.SuffixLevels.scan, []

    def watched(self, *args, **options):
        out = scan(self, *args, **options)
        seen.append(sorted(self.levels))
        return out

    monkeypatch.setattr(S.SuffixLevels, "scan", watched)
    rows = [(i, f"{prose(i, 60)} {prose(1000 + i % 7, 40)}") for i in range(60)]
    docs = documents(spark, rows)
    assert rows_of(S.removal(docs)) == brute(rows)
    assert S.without_repeats(docs).count() == len(rows)
    assert seen == 2 * [[0], [1], [0, 1], [0, 1]]


def test_levels_are_in_suffix_order(spark):
    """A merged level holds the suffixes of both batches, each file sorted by their bytes."""
    texts = {i: f"{prose(i, 150)} é東 {'ÿ' * (i % 5)} {prose(300 + i % 4, 30)}" for i in range(40)}
    index = S.SuffixLevels()
    for half in (range(20), range(20, 40)):
        index.scan(documents(spark, [(i, texts[i]) for i in half]))
    assert sorted(index.levels) == [1]
    level = index.levels[1].selectExpr("*", "input_file_name() as file", f"{S.START} + ({S.LEAD}) as at", "place & 3 as kind")
    files, held = {}, set()
    for r in level.collect():
        spelled = b"".join((r[w] + 2**63).to_bytes(8, "big") for w in S.WORDS)
        if r["kind"] != S.MARKER:
            assert texts[r["doc_id"]].encode()[r["at"] : r["at"] + S.KEY] == spelled
            held.add(r["doc_id"])
        files.setdefault(r["file"], []).append(spelled)
    assert held == set(texts)
    assert all(f == sorted(f) for f in files.values()) and max(map(len, files.values())) > 20
