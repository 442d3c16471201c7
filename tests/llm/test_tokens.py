import pyarrow as pa
from pathlib import Path
import re
import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyline.llm import bit_planes as P
from tallyline.llm import chunked_bpe as B
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, prose, rows_of, sample_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a'reb'll'RE 's", "  two  spaces \n\n\n ends  ", "x" * 700, "12 345,67 八百", "tab\tand\x0bvt\x1c\x85 wide",
    "<|endoftext|> and <|startoftext|>", "İstanbul ΑΣ ﬁne é Å ŉ", "İıǅ ß", "",
]


def cases():
    """Awkward rows with distinct ids, so that their order is defined."""
    rows = [(i, t) for i, t in awkward() if i is not None] + [(100 + k, t) for k, t in enumerate(ODD)]
    return rows + [(200, " ".join(ODD * 30)), (201, " " * 500 + "a" + "\n" * 300 + "b" * 900)]


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.read(RANKS, public_tokenizers.PATTERN)


def expected(rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        ids = coder.encode_ordinary(t or "")
        joined = ",".join(map(str, ids)).encode()
        out.append((i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "overlap"), [(B.CHUNK, B.OVERLAP), (64, 16), (37, 9), (200, 150)])
def test_bpe_equals_library(spark, vocabulary, chunk, overlap):
    rows = cases() + [(None, prose(4, 200)), (12, prose(1, 120))]
    ids = B.encoded(clashing(documents(spark, rows)), vocabulary, chunk, overlap)
    assert rows_of(B.digests(ids, vocabulary)) == expected(rows)


def test_bpe_on_sample(spark, vocabulary):
    docs = sample_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids = B.encoded(docs, vocabulary, 500, 60)
    assert rows_of(B.digests(ids, vocabulary)) == expected(rows)
    back = {r["doc_id"]: bytes(r["data"]).decode() for r in B.decoded(ids, vocabulary).collect()}
    assert back == dict(rows)


def test_bpe_empty_table(spark, vocabulary):
    assert B.encoded(spark.createDataFrame([], SCHEMA), vocabulary).count() == 0


def filed(rows):
    tokenizer, start, out = Tokenizer.from_file(WORDS), 0, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "bits"), [(1 << 16, 8), (64, 8), (100, 1), (1, 8)])
def test_files_hold_the_library_ids(spark, tmp_path, block, bits):
    rows = [r for n, r in enumerate(cases()) if n != 0 or block > 1]
    rows = list({i: (i, t) for i, t in rows}.values())
    path = str(tmp_path / "files")
    P.write(clashing(documents(spark, rows)), path, WORDS, block_ids=block, plane_bits=bits)
    assert rows_of(P.summary(spark, path)) == filed(rows)


def test_files_on_sample(spark, tmp_path):
    docs = sample_documents(spark)
    P.write(docs, str(tmp_path / "f"), WORDS, block_ids=5000)
    assert rows_of(P.summary(spark, str(tmp_path / "f"))) == filed([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_files_of_nothing_and_of_repeats(spark, tmp_path):
    P.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), WORDS)
    assert P.summary(spark, str(tmp_path / "none")).count() == 0
    P.write(documents(spark, [(None, "a"), (3, "b c"), (3, "b c")]), str(tmp_path / "some"), WORDS)
    got = rows_of(P.summary(spark, str(tmp_path / "some")))
    assert sorted(r[1] for r in got) == [0, 2, 5] and {r[0] for r in got} == {None, 3}


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    ids = np.random.default_rng(1).integers(0, 2**32, 1003, dtype=np.uint32)
    assert (P.restored(P.transposed(ids, bits), bits, len(ids)) == ids).all()


def test_pieces_are_those_of_the_library():
    """Every plain character beside letters, quotes, digits and itself, and the contractions."""
    content = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    whole = Tokenizer.from_str(content)
    encode = P.Encoder(content)
    assert encode.pieces
    plain = [chr(c) for c in range(0x250) if re.search(P.PLAIN, chr(c))]
    texts = [f"a{c}b {c}{c} 7{c}'s{c} x'{c} Don't{c}THEY'RE {c}" for c in plain]
    texts += [f"{a}{b}" for a in ("'", ".'", "s'", "9", "é", "Ž") for b in ("s", "t", "re", "ve", "m", "ll", "d", "S", "really", "1", "!")]
    texts += ["", None, " \n ", "İstanbul ĳ ŉ", "a b", "é", "\x00x", "<|endoftext|> a", "東京 tower", "ab" * 5000]
    got = encode(pa.array(texts))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def test_pieces_met_by_one_task_are_known_to_the_next(monkeypatch):
    content = Path(WORDS).read_text()
    texts = pa.array([prose(70 + i, 80) for i in range(5)])
    P._encoder(content)._forget()
    first = P._encoder(content)(texts)
    coded = []
    monkeypatch.setattr(P.Encoder, "_of_pieces", lambda self, pieces: coded.append(pieces) or iter(()))
    again = P._encoder(content)(texts)
    assert not coded and [x.tolist() for x in again] == [x.tolist() for x in first]
