import math
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallyline.llm import ppm_language as M
from tallyline.llm.arrowtext import slices
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, sample_documents

TEXTS = {"aa": ["abracadabra abra", "barbara"], "bb": ["mississippi miss", "abba miss"]}


def grams(texts, order):
    found = {}
    for lang, own in texts.items():
        for text in own:
            data = text.encode()
            for length in range(1, order + 2):
                for i in range(len(data) - length + 1):
                    key = (lang, length, int.from_bytes(data[i : i + length], "big"))
                    found[key] = found.get(key, 0) + 1
    return pd.DataFrame([(*k, n) for k, n in found.items()], columns=["lang", "length", "gram", "n"])


def slow_bits(texts, order, data):
    """Code length by walking the contexts down from the longest, with exclusion."""
    counts = {}
    for text in (t.encode() for t in texts):
        for size in range(order + 1):
            for i in range(len(text) - size):
                own = counts.setdefault(text[i : i + size], {})
                own[text[i + size]] = own.get(text[i + size], 0) + 1
    total = 0.0
    for i, byte in enumerate(data):
        ruled = set()
        for size in range(min(order, i), -1, -1):
            own = {b: n for b, n in counts.get(data[i - size : i], {}).items() if b not in ruled}
            if not own:
                continue
            whole = sum(own.values()) + len(own)
            if byte in own:
                total -= math.log2(own[byte] / whole)
                break
            total -= math.log2(len(own) / whole)
            ruled |= own.keys()
        else:
            total += math.log2(256 - len(ruled))
    return total


@pytest.mark.parametrize("order", [1, 2, 3])
def test_code_lengths_equal_slow_coder(order):
    model = M.built(grams(TEXTS, order), order)
    texts = ["abra miss", "zebra", "mississippi", "x", "ü abba", "barbarab"]
    ((_, data, offsets),) = slices(pa.array(texts))
    got = model.code_lengths(data, offsets)
    expected = [[slow_bits(TEXTS[lang], order, t.encode()) for lang in ("aa", "bb")] for t in texts]
    assert np.allclose(got, expected, atol=1e-3)


def test_few_hashes_of_a_hot_language_are_ranked_at_once(spark):
    rows = spark.range(20_000, numPartitions=3).selectExpr(
        "concat('text ', id % 15000) as text", "if(id % 15000 % 50 = 0, 'aa', 'en') as lang", "xxhash64(concat('text ', id % 15000)) as draw")
    every = {lang: sorted({r["draw"] for r in rows.collect() if r["lang"] == lang}) for lang in ("aa", "en")}
    ranked = M.candidates(rows, 7).collect()
    assert len(ranked) == len(set(ranked)) and len(ranked) <= 2 * M.SALTS * 7 and len(every["en"]) > 10_000
    got = M.sampled(rows.select("text", "lang"), 7).selectExpr("lang", "xxhash64(text) as draw").collect()
    assert sorted(tuple(r) for r in got) == [(lang, d) for lang in ("aa", "en") for d in every[lang][:7]]


def test_probabilities_add_up_to_one():
    model = M.built(grams(TEXTS, 2), 2)
    table = model.cost.reshape(-1, model.columns, 2)
    alike = np.ones(model.columns)
    alike[-1] = 256 - (model.columns - 1)
    assert np.allclose((np.exp2(-table) * alike[None, :, None]).sum(axis=1), 1, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = sample_documents(spark)
    found = M.language_of(clashing(docs).drop("score").withColumnRenamed("bucket", "score"))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in found.collect() if r["held_out"]]
    assert len(rows) > 20 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    rows = awkward() + [(50, "12 34 !?"), (51, "\U0001f600")]
    got = M.language_of(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    pred = {r["doc_id"]: r["lang_pred"] for r in got}
    assert all(pred[i] == "und" for i in (1, 2, 3, 50, 51)) and pred[0] == "en" and pred[8] == "en"
    assert all(r["held_out"] for r in got if r["doc_id"] is None)


def test_nothing_to_learn(spark):
    docs = documents(spark, [(1, "some text")]).withColumn("lang", M.F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in M.language_of(docs).collect()] == ["und"]
    assert M.language_of(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_large_batch_leaves_in_parts():
    texts = [f"zebra {i}" if i % 3 else None for i in range(3 * M.SCORED_ROWS + 7)]
    shared = SimpleNamespace(value=M.Trees(grams(TEXTS, 2), 2))
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    parts = list(M._scored(shared)(iter([whole])))
    assert max(p.num_rows for p in parts) == M.SCORED_ROWS and len(parts) == 4
    together = pa.Table.from_batches(parts).to_pydict()
    assert together["doc_id"] == list(range(len(texts))) and together["text"] == texts
    alone = [r for i in range(len(texts)) for r in list(M._scored(shared)(iter([whole.slice(i, 1)])))]
    assert together["bits_per_byte"] == pa.Table.from_batches(alone).to_pydict()["bits_per_byte"]
