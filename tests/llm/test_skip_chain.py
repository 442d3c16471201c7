import hashlib
import itertools
import re

import numpy as np
import pytest

from tallyline.llm import skip_chain as C
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, rows_of, sample_documents


def checked(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p.lstrip("0") or "0") <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, text or "") if checked(k, m[0])]


CASES = [
    "mail a.b+c@x-y.example.com, or q@host (no dot) and z@w.org.", "ip 10.0.0.256 but 10.0.0.25 and 1.2.3.4.5.6",
    "card 4539 1488 0343 6467 and 4539-1488-0343-6467 or 4539148803436468", "call +49 (30) 123-4567 89, +1 2, or +12345678901234567",
    "é" * 30 + "ü@x.de ١٢٣ 1.1.1.1", "0" * 5000 + ".1.1.1", "@@@ 999999999999999999999999 +", "none here",
]


@pytest.mark.parametrize("rows", [awkward() + [(100 + k, t) for k, t in enumerate(CASES)]])
def test_base_equals_patterns(spark, rows):
    docs = clashing(documents(spark, rows))
    got = C.found_in(docs, C.fitted(docs)).collect()
    expected = sorted((i is None, i, hashlib.sha256(",".join(brute(t)).encode()).hexdigest()) for i, t in rows if i is not None)
    assert sorted((False, r["doc_id"], r["base_sha256"]) for r in got if r["doc_id"] is not None) == expected
    texts = {i: t for i, t in rows}
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(brute(texts[r["doc_id"]])) <= set(spans)
        assert sum(r[f"n_{k}"] for k in C.KINDS) + r["n_added"] == len(spans)


def test_base_on_sample(spark):
    docs = sample_documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in C.found_in(docs, C.fitted(docs)).collect():
        assert r["base_sha256"] == hashlib.sha256(",".join(brute(texts[r["doc_id"]])).encode()).hexdigest()


def test_repeated_number_is_found_without_its_prefix(spark):
    rows = [(k, f"call +1 (555) 867-{1000 + k} today") for k in range(60)]
    rows += [(100 + k, f"order 867-{2000 + k} of 17 in 2021") for k in range(40)]
    rows += [(200 + k, f"call +1 (555) 444-{1000 + k}; again: 444-{1000 + k} please") for k in range(20)]
    rows.append((300, "call +1 (555) 321-7654 or later, text " + "far away " * 50 + "321-7654 please"))
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in C.found_in(docs, C.fitted(docs), sure=0.6).collect()}
    assert got[300]["n_added"] == 1 and got[300]["spans"].count("phone") == 2
    assert all(got[100 + k]["n_added"] == 0 for k in range(40))


GROUPED = [
    ("+34 612 345 678", "612 345 678"), ("+33 6 12 34 56 78", "6 12 34 56 78"), ("+33 6 12 34 56 79", "612 345 679"),
    ("+1 (743) 555-3824", "743-555-3824"), ("+1 743-555-3825", "(743) 555-3825"), ("+17435553826", "743 555 3826"),
]


def test_repeats_in_short_groups_or_other_marks_are_found(spark):
    rows = [(k, f"call +1 (555) 867-{1000 + k} today") for k in range(60)]
    rows += [(100 + k, f"items 12 34 {k} 56 and 12 {300 + k} of 345 678 in 2021, page {k} 612 {345 + k}") for k in range(200)]
    rows += [(600 + k, f"chapter {k % 9} of {k % 7}, then {k % 8}") for k in range(100)]
    rows += [(400 + k, f"serial {k} 200 {310 + k} 410 and again {k} 200 {310 + k} 410") for k in range(40)]
    rows += [(500 + k, f"call {full} or later, " + "far away " * 50 + f"{short} please, not 12 345 {k}") for k, (full, short) in enumerate(GROUPED)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in C.found_in(docs, C.fitted(docs)).collect()}
    texts = dict(rows)
    for k, (_, short) in enumerate(GROUPED):
        start, end = (int(x) for x in got[500 + k]["spans"].split(":phone")[0].split(",phone:")[1].split(":"))
        assert got[500 + k]["n_added"] == 1 and texts[500 + k][start:end] == short.lstrip("("), short
    assert all(got[i]["n_added"] == 0 for i in [*range(100, 300), *range(400, 440), *range(600, 700)])


def test_links_of_runs_by_joined_digits():
    graph, _ = C.graph_of(["+33 6 12 34 56 78 or 612 345 678, 6 12 34 56 78 or 99 12", "12 34 56 12 34 56", "1111111 11111111 1111"])
    words = [graph.spans[a] + graph.spans[b] for a, b in graph.skip if graph.doc[a] == 0]
    spelled = {("+33 6 12 34 56 78 or 612 345 678, 6 12 34 56 78 or 99 12"[a:b], "+33 6 12 34 56 78 or 612 345 678, 6 12 34 56 78 or 99 12"[c:d]) for a, b, c, d in words}
    assert {("6", "612"), ("12", "612"), ("34", "345"), ("56", "345"), ("56", "678"), ("78", "678"), ("612", "6"), ("678", "78")} <= spelled
    assert not any("99" in pair for pair in spelled)
    assert all(a < b for a, b in graph.skip) and len(set(graph.skip)) == len(graph.skip)


def test_marginals_are_exact_on_trees():
    draw = np.random.default_rng(3)
    graph = C.Graph(doc=[0] * 4, spans=[(0, 1)] * 4, signatures=["a", "b", "a", "c"], labels=[C.OUTSIDE] * 4)
    graph.chain, graph.skip = [(0, 1), (1, 2)], [(1, 3)]
    table = {s: draw.normal(size=C.LABELS) for s in "abc"}
    symmetric = [x + x.T for x in draw.normal(size=(2, C.LABELS, C.LABELS))]
    potentials = C.Potentials(table, np.zeros(C.LABELS), *symmetric)
    exact = np.zeros((4, C.LABELS))
    for labels in itertools.product(range(C.LABELS), repeat=4):
        score = sum(table[s][y] for s, y in zip(graph.signatures, labels, strict=True))
        score += sum(symmetric[0][labels[a], labels[b]] for a, b in graph.chain)
        score += sum(symmetric[1][labels[a], labels[b]] for a, b in graph.skip)
        for i, y in enumerate(labels):
            exact[i, y] += np.exp(score)
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(C.marginals(graph, potentials, rounds=60), exact, atol=1e-4)


def test_masked(spark):
    docs = clashing(documents(spark, [(1, "a@b.org and 1.1.1.1"), (2, None), (3, "plain")]))
    got = C.masked(docs, C.fitted(docs))
    assert got.columns == docs.columns
    assert [r["text"] for r in got.orderBy("doc_id").collect()] == ["<EMAIL> and <IP>", None, "plain"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert C.found_in(docs, C.fitted(docs)).count() == 0
