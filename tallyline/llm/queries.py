"""One query for each operator over the test tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    bit_planes, bit_sliced, chebyshev_whitening, chunked_bpe, length_buckets, merkle_manifest, role_repair,
    scaled_sketch, skip_chain, suffix_levels, wu_manber,
)
from tallyline.llm.odd_sketch import near_duplicates
from tallyline.llm.ppm_language import language_of
from tallyline.workspace import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of(documents(spark, sf_dir).select("doc_id", "text", "lang"))


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=2, percent=80)


ORACLES["op4_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
        ELSE [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), both_ways AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, both_ways.v FROM reach JOIN both_ways ON reach.other = both_ways.u
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.doc_id = d.doc_id
"""


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = chunked_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return chunked_bpe.digests(chunked_bpe.encoded(documents(spark, sf_dir), vocabulary), vocabulary)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    bit_planes.write(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return bit_planes.summary(spark, path)


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edited_likeness(documents(spark, sf_dir))


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return skip_chain.found_in(docs, skip_chain.fitted(docs))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_levels.removal(documents(spark, sf_dir))


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return bit_sliced.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op8_topk_search"] = """
WITH numbers AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""


@query
def op9_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.packed(documents(spark, sf_dir))


def _packing_sql(longest: int, buckets: int, budget: int) -> str:
    """Dynamic programming with one common table per bucket; ``came`` is where the bucket below ends."""
    steps = ["least1 AS (SELECT j, size * n_rows - n_tokens AS cost, 0::BIGINT AS came FROM sums)"]
    for k in range(2, buckets + 1):
        steps.append(
            f"least{k} AS (SELECT b.j, min(a.cost + b.size * (b.n_rows - s.n_rows) - (b.n_tokens - s.n_tokens)) AS cost, "
            f"arg_min(a.j, (a.cost + b.size * (b.n_rows - s.n_rows) - (b.n_tokens - s.n_tokens)) * 100000 + a.j) AS came "
            f"FROM sums b JOIN (SELECT j, cost FROM least{k - 1} UNION ALL SELECT 0, 0) a ON a.j < b.j "
            f"JOIN (SELECT j, n_rows, n_tokens FROM sums UNION ALL SELECT 0, 0, 0) s ON s.j = a.j GROUP BY b.j)"
        )
    back = [f"end{buckets} AS (SELECT max(j) AS j FROM sums)"]
    for k in range(buckets, 1, -1):
        back.append(f"end{k - 1} AS (SELECT came AS j FROM least{k} JOIN end{k} USING (j))")
    ends = " UNION ".join(f"SELECT j FROM end{k}" for k in range(1, buckets + 1))
    return f"""
WITH sized AS (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents
), pieces AS (
    SELECT doc_id, piece, piece * {longest} AS start, least(n - piece * {longest}, {longest}) AS n_tokens
    FROM (SELECT doc_id, n, unnest(range(0, greatest((n + {longest - 1}) // {longest}, 1))) AS piece FROM sized)
), counts AS (
    SELECT n_tokens AS size, count(*) AS c FROM pieces WHERE n_tokens > 0 GROUP BY 1
), sums AS (
    SELECT row_number() OVER w AS j, size, (sum(c) OVER w)::BIGINT AS n_rows, (sum(size * c) OVER w)::BIGINT AS n_tokens
    FROM counts WINDOW w AS (ORDER BY size)
), {", ".join(steps)}, {", ".join(back)}, chosen AS (
    SELECT size FROM sums WHERE j IN ({ends})
), bucketed AS (
    SELECT p.*, (SELECT min(size) FROM chosen WHERE size >= p.n_tokens AND p.n_tokens > 0) AS bucket_len FROM pieces p
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY doc_id, piece, n_tokens) - 1 AS place,
        greatest({budget} // bucket_len, 1) AS room FROM bucketed
)
SELECT doc_id, piece, start, n_tokens, bucket_len,
    CASE WHEN bucket_len IS NOT NULL THEN place // room END AS batch,
    CASE WHEN bucket_len IS NOT NULL THEN place % room END AS slot
FROM numbered
"""


ORACLES["op9_length_packing"] = _packing_sql(length_buckets.LONGEST, length_buckets.BUCKETS, length_buckets.BUDGET)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chebyshev_whitening.whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return wu_manber.digests(wu_manber.found(docs, tests).drop("text"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES["op12_decontamination"] = f"""
WITH docs AS (
    SELECT doc_id, {_WORDS} AS ws FROM documents
), tests AS (
    SELECT item_id, ws, least(len(ws), 10) AS k FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0
), windows AS (
    SELECT DISTINCT item_id, k, unnest([array_to_string(ws[i : i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) AS win
    FROM tests
), runs AS (
    SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i,
        unnest([array_to_string(ws[i : i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) AS win
    FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(ws) >= k
), matched AS (
    SELECT r.doc_id, r.i, r.k, w.item_id FROM runs r JOIN windows w ON w.k = r.k AND w.win = r.win
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM matched) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM matched) GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
    coalesce(i.items_sha256, sha256('')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = merkle_manifest.manifest(documents(spark, sf_dir), merkle_manifest.tampered())
    return merkle_manifest.digests(merkle_manifest.proofs(spark, made))


def _merkle_sql(levels: int) -> str:
    """Levels as one common table each; a tree that has one node left keeps it unchanged on higher levels."""

    def enc(column: str) -> str:
        return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(enc, ('doc_id', 'source', 'lang', 'n_chars')))} || {enc(text)})"

    def climb(name: str, below: str, tree: str) -> list[str]:
        """``name``0 to ``name``<levels>, each with its parent's number, place and the nodes of the run."""
        steps = []
        for k in range(levels):
            source = below if k == 0 else f"{name}{k}"
            steps.append(
                f"{name}run{k} AS (SELECT {tree}, number // 16 AS parent, list(hash ORDER BY number) AS brood, max(n) AS n "
                f"FROM {source} GROUP BY ALL)"
            )
            steps.append(
                f"{name}{k + 1} AS (SELECT {tree}, parent AS number, (n + 15) // 16 AS n, "
                f"CASE WHEN n = 1 THEN brood[1] ELSE sha256(array_to_string(brood, '')) END AS hash FROM {name}run{k})"
            )
        return steps

    def path(name: str, tree: str, start: str, number: str) -> str:
        """Fold along the runs of one tree: each level replaces the digest at its place in the run."""
        out, folded, proof = [], start, "''" if name == "s" else "proof"
        for k in range(levels):
            came = f"{name}path{k}" if k else ("placed" if name == "s" else f"spath{levels}")
            place = f"(({number} // {16**k}) % 16)::INTEGER"
            out.append(
                f"{name}path{k + 1} AS (SELECT p.* EXCLUDE (folded, proof), "
                f"CASE WHEN r.n = 1 THEN p.folded ELSE sha256(array_to_string(r.brood[:{place}] || [p.folded] || r.brood[{place} + 2:], '')) END AS folded, "
                f"CASE WHEN r.n = 1 THEN p.proof ELSE p.proof || array_to_string(r.brood[:{place}] || r.brood[{place} + 2:], '') END AS proof "
                f"FROM {came} p JOIN {name}run{k} r ON {f'r.tree IS NOT DISTINCT FROM p.tree AND ' if tree == 'tree' else ''}r.parent = p.{number} // {16 ** (k + 1)})"
            )
        return ", ".join(out)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8
), checked AS (
    SELECT *, xor(list_reduce(
        list_concat([4294967295::BIGINT], [ascii(x)::BIGINT for x in regexp_extract_all(doc_id::VARCHAR, '.')]),
        lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) % 5 = 0 AS struck
    FROM documents, crc
), leaves AS (
    SELECT doc_id, source AS tree, {leaf("text")} AS hash,
        CASE WHEN struck THEN {leaf(f"({lower})")} ELSE {leaf("text")} END AS shown,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS number,
        count(*) OVER (PARTITION BY source) AS n
    FROM checked
), {", ".join(climb("s", "leaves", "tree"))}, subroots AS (
    SELECT tree, hash, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS number, count(*) OVER () AS n FROM s{levels}
), {", ".join(climb("t", "subroots", "0 AS whole"))}, placed AS (
    SELECT l.doc_id, l.tree, l.hash AS leaf, s.hash AS subroot, l.number, s.number AS top, l.shown AS folded, '' AS proof
    FROM leaves l JOIN subroots s ON s.tree IS NOT DISTINCT FROM l.tree
), {path("s", "tree", "shown", "number")}, {path("t", "", "", "top")}
SELECT doc_id, leaf, subroot, t{levels}.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
    folded = t{levels}.hash AS verified
FROM tpath{levels}, t{levels}
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql(6)
