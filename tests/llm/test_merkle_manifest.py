import hashlib
import string
import zlib

from tallyline.llm import merkle_manifest as M
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents

FIELDS = ("doc_id", "source", "lang", "n_chars")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    shown = [*(row[f] for f in FIELDS), text]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in shown))


def lowered(row):
    text = row["text"]
    if text is None or row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 5:
        return text
    return "".join(c.lower() if c in string.ascii_uppercase else c for c in text)


def tree(nodes):
    """The root, and for each leaf its runs from the lowest level up as (place, run)."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [(nodes[a : a + 16], below[a : a + 16]) for a in range(0, len(nodes), 16)]
        for run, leaves in runs:
            for place, own in enumerate(leaves):
                for i in own:
                    paths[i].append((place, run))
        nodes = [digest(*run) for run, _ in runs]
        below = [[i for own in leaves for i in own] for _, leaves in runs]
    return nodes[0], paths


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        leaves = sorted(
            sources[source],
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), leaf_of(r, lowered(r))),
        )
        trees.append((leaves, *tree([leaf_of(r, r["text"]) for r in leaves])))
    root, tops = tree([subroot for _, subroot, _ in trees])
    for (leaves, subroot, paths), top in zip(trees, tops, strict=True):
        for row, path in zip(leaves, paths, strict=True):
            folded, siblings = leaf_of(row, lowered(row)), []
            for place, run in path + top:
                siblings += run[:place] + run[place + 1 :]
                folded = digest(*run[:place], folded, *run[place + 1 :])
            yield row["doc_id"], leaf_of(row, row["text"]), subroot, root, digest(*siblings), folded, folded == root


def found(spark, docs):
    return rows_of(M.digests(M.proofs(spark, M.manifest(docs, M.tampered()))))


def expected(docs):
    return sorted(brute(docs.collect()), key=repr)


def test_sample_equals_brute_force(spark):
    docs = sample_documents(spark)
    got = found(spark, docs)
    assert got == expected(docs)
    assert 0 < sum(not r[-1] for r in got) <= sum(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in got)


def test_deep_tree_nulls_and_many_sources(spark, monkeypatch):
    """One source of three levels, sources of one, sixteen and seventeen rows, none, and an empty name."""
    monkeypatch.setattr(M, "GROUPS_PER_COPY", 2)  # nodes in several copies
    rows = [(i, f"Text {i}", "en", "big", i) for i in range(5000)]
    rows += [(1000 + i, prose(i, 5), None, f"s{i:02d}", None) for i in range(20)]
    rows += [(2000 + i, None, "de", "a", 0) for i in range(16)] + [(3000 + i, "", "de", "ä", 0) for i in range(17)]
    rows += [(4000, "nameless", None, None, 8), (4001, "Other", None, None, 5), (4002, "empty", "x", "", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(spark, docs) == expected(docs)


def test_awkward_rows(spark):
    docs = documents(spark, awkward() + [(None, "A"), (None, "B"), (None, None), (9, "Y" * 2_000_000)])
    got = found(spark, docs)
    assert got == expected(docs)
    assert found(spark, clashing(docs)) == got


def test_one_document_is_the_root(spark):
    docs = documents(spark, [(3, "Alone")])
    ((_, leaf, subroot, root, proof, folded, verified),) = found(spark, docs)
    assert leaf == subroot == root and proof == digest() and verified == (folded == root)


def test_empty_table(spark):
    assert found(spark, spark.createDataFrame([], SCHEMA)) == []


def test_changed_node_is_noticed(spark):
    """A proof is checked against the stored tree, not against itself."""
    docs = documents(spark, [(i, f"t{i}") for i in range(40)])
    assert all(r[-1] for r in rows_of(M.digests(M.proofs(spark, M.manifest(docs)))))
