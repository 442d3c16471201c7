"""Merkle manifest of a document table, and an inclusion proof for every document.

Documents of one source, in order of doc_id, are the leaves of that source's tree; sixteen
neighbours at a time become their parent until one node, the subroot, remains. The subroots, in
order of source, give the root in the same way. Every built level is stored as node rows that
name their parent and their place in it, and hold the digests of their own children.

A recursive query climbs from every leaf to the root: at each step it appends the siblings to
the proof and puts the folded digest in its place among them. Leaves below one node of the second
level have all siblings above it in common, so those at most 256 climb as one row: an array of
their folded digests beside one proof. Their siblings below that node are put before it at the end.

* A source without a name is a tree of its own and the first one. A lone leaf is its subroot.
* Repeated doc_ids, and documents without one (first in their source), follow the order of
  their leaf digests; equal rows are equal leaves beside each other.
* Null values have a mark of their own (``-``), an empty text has length 0. Whole texts are hashed.
* Further columns are ignored. An empty table has no root and no proofs.

Digests are kept as 32 bytes and hashed as lower-case hex text. No step gathers more than 256 leaves
or sixteen nodes. A node below which many groups climb is stored in as many copies as it takes to
meet at most GROUPS_PER_COPY of them each, so neither a large source nor the root becomes a hot key.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.once import evaluated_once
from tallyline.workspace import stored

FAN = 16
BYTES = 32
GROUPS_PER_COPY = 1024
UNNAMED, NAMED, TOP = "-", "=", ""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _part(value: Column) -> Column:
    """A value with its length in bytes before it, so that neighbouring values cannot run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a document that shows this text."""
    values = (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    return F.unhex(F.sha2(F.concat(*map(_part, values)), 256))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tampered() -> Column:
    """The text of a document after one in five had its letters A-Z lowered."""
    struck = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(struck, lowered(F.col("text"))).otherwise(F.col("text"))


def _hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest(digests: Column) -> Column:
    return F.unhex(F.sha2(_hexed(digests), 256))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.unhex(F.lit("")), lambda all_, one: F.concat(all_, one))


def _before(brood: Column, place: Column) -> Column:
    return F.substring(brood, F.lit(1), (place * BYTES).cast("int"))


def _after(brood: Column, place: Column) -> Column:
    return F.substring(brood, ((place + 1) * BYTES + 1).cast("int"), F.lit(FAN * BYTES))


def _folded(brood: Column, place: Column, digest: Column) -> Column:
    """The parent's digest with ``digest`` in the place of the child."""
    return _digest(F.concat(_before(brood, place), digest, _after(brood, place)))


def _node_id(level: Column, number: Column, tree: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), number.cast("string"), tree)


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``number`` of each row in its ``tree`` from 0 and ``n``, the rows of the tree.

    Rows are dealt by range, so that a large tree is spread over many tasks; where a tree's rows
    begin in a task is a running sum over tasks.
    """
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    spread = stored(spread.withColumn("spot", F.monotonically_increasing_id()), "merkle-ordered")
    spread = spread.withColumn("task", F.shiftright("spot", 33))
    pieces = spread.groupBy("tree", "task").agg(F.min("spot").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "tree", "task", "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("skipped"),
        F.sum("size").over(tree).alias("n"),
    )
    number = F.col("spot") - F.col("first") + F.col("skipped")
    placed = spread.join(pieces, ["tree", "task"]).withColumn("number", number)
    return placed.drop("spot", "task", "first", "skipped")


def _levels(nodes: DataFrame, level: int) -> list[DataFrame]:
    """Stored levels above ``nodes`` (tree, number, n, hash, groups); trees of one node are done."""
    built = []
    below = nodes.filter("n > 1")
    while not below.isEmpty():
        level += 1
        kids = F.array_sort(F.collect_list(F.struct("number", "hash")))
        parents = below.groupBy("tree", F.expr(f"number div {FAN}").alias("parent")).agg(
            F.ceil(F.max("n") / FAN).alias("n"), kids.alias("kids"), F.sum("groups").alias("groups")
        )
        parents = parents.select(
            "tree", F.lit(level).alias("level"), F.col("parent").alias("number"), "n",
            _joined(F.col("kids.hash")).alias("brood"), "groups",
        )
        built.append(stored(parents.withColumn("hash", _digest(F.col("brood"))), "merkle-level"))
        below = built[-1].filter("n > 1")
    return built


@dataclass(frozen=True)
class Manifest:
    """Stored node rows, and the groups of leaves from which a climb begins.

    ``nodes``: node, copy, parent, parent_copies, place, brood, hash, subroot (null but for subroots).
    ``groups``: node, parent, parent_copies, place, doc_ids, folded, broods of its runs, brood, hash, subroot.
    """

    nodes: DataFrame
    groups: DataFrame


def _grouped(leaves: DataFrame) -> DataFrame:
    """Two levels at once: leaves to runs, and sixteen runs to a node, with every leaf folded up to it.

    A lone leaf is not hashed again, nor is a lone run; the node is then the subroot.
    """
    kids = F.array_sort(F.collect_list(F.struct("number", "hash", "shown", "doc_id")))
    rows = leaves.groupBy("tree", F.expr(f"number div {FAN * FAN}").alias("group")).agg(
        kids.alias("kids"), F.max("n").alias("leaves")
    )
    one_leaf, one_run = F.col("leaves") == 1, F.col("leaves") <= FAN
    last_run = F.floor((F.size("kids") - 1) / FAN).cast("int")
    run = F.transform(
        F.sequence(F.lit(0), last_run), lambda r: _joined(F.slice(F.col("kids.hash"), r * FAN + 1, F.lit(FAN)))
    )
    rows = evaluated_once(rows, broods=run)
    rows = evaluated_once(
        rows, brood=_joined(F.transform("broods", lambda b: F.when(one_leaf, b).otherwise(_digest(b))))
    )

    def climber(kid: Column, i: Column) -> Column:
        run_no, place = F.floor(i / FAN).cast("int"), i % FAN
        in_run = F.when(one_leaf, kid["shown"]).otherwise(
            _folded(F.element_at("broods", run_no + 1), place, kid["shown"])
        )
        return F.when(one_run, in_run).otherwise(_folded(F.col("brood"), run_no, in_run))

    return rows.select(
        "tree", F.lit(2).alias("level"), F.col("group").alias("number"), F.ceil(F.col("leaves") / (FAN * FAN)).alias("n"),
        "brood", F.lit(1).cast("long").alias("groups"), "broods", F.col("kids.doc_id").alias("doc_ids"),
        F.transform("kids", climber).alias("folded"),
        F.when(one_run, F.col("brood")).otherwise(_digest(F.col("brood"))).alias("hash"),
    )


def manifest(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """Build and store the trees of ``docs`` (doc_id, source, lang, n_chars, text).

    ``shown`` is the text that each document presents when it is checked, by default its own.
    """
    text = F.col("text")
    tree = F.coalesce(F.concat(F.lit(NAMED), F.col("source")), F.lit(UNNAMED))
    own = docs.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(text).alias("hash"),
        leaf(text if shown is None else shown).alias("shown"),
    )
    leaves = _numbered(stored(own, "merkle-leaves"), "doc_id", "hash", "shown")
    groups = stored(_grouped(leaves), "merkle-groups")

    narrow = ["tree", "level", "number", "n", "hash", "groups"]
    inner = _levels(groups.select(*narrow), 2)
    subroots = reduce(DataFrame.unionByName, [level.select(*narrow) for level in (groups, *inner)])
    subroots = subroots.filter("n = 1").select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "hash", "groups"
    )
    tops = stored(_numbered(subroots, "of"), "merkle-subroots")
    upper = _levels(tops.drop("of"), 0)

    above = tops.select(
        F.col("of").alias("tree"),
        F.when(F.col("n") > 1, _node_id(F.lit(1), F.expr(f"number div {FAN}"), F.lit(TOP))).alias("top_parent"),
        (F.col("number") % FAN).alias("top_place"),
    )
    inner_nodes = reduce(DataFrame.unionByName, [*inner, *upper] or [groups.select(*narrow, "brood").limit(0)])
    nodes = _linked(inner_nodes, above).withColumn("copies", F.ceil(F.col("groups") / GROUPS_PER_COPY))
    copies = nodes.select(F.col("node").alias("parent"), F.col("copies").alias("parent_copies"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    nodes = nodes.join(copies, "parent", "left").withColumn("copy", each)
    links = ["node", "parent", "parent_copies", "place", "brood", "hash", "subroot"]
    nodes = stored(nodes.select("copy", *links), "merkle-nodes")
    groups = _linked(groups, above).join(copies, "parent", "left")
    return Manifest(nodes, stored(groups.select(*links, "doc_ids", "folded", "broods"), "merkle-climbers"))


def _linked(level: DataFrame, above: DataFrame) -> DataFrame:
    """Every node with the id of its parent and its place below it; the root has none."""
    done = (F.col("n") == 1) & (F.col("tree") != TOP)
    inside = _node_id(F.col("level") + 1, F.expr(f"number div {FAN}"), F.col("tree"))

    def row(frame: DataFrame, parent: Column, place: Column, subroot: Column) -> DataFrame:
        kept = [c for c in level.columns if c not in ("tree", "level", "number", "n")]
        node = _node_id(F.col("level"), F.col("number"), F.col("tree"))
        return frame.select(
            node.alias("node"), parent.alias("parent"), place.cast("long").alias("place"), *kept, subroot.alias("subroot")
        )

    within = row(
        level.filter(~done), F.when(F.col("n") > 1, inside), F.col("number") % FAN, F.lit(None).cast("binary")
    )
    ended = row(level.filter(done).join(above, "tree"), F.col("top_parent"), F.col("top_place"), F.col("hash"))
    return within.unionByName(ended)


_CLIMB = f"""
WITH RECURSIVE climb(node, parent, parent_copies, place, folded, hash, subroot, proof) AS (
    SELECT node, parent, parent_copies, place, folded, hash, subroot, unhex('') FROM {{groups}}
    UNION ALL
    SELECT c.node, n.parent, n.parent_copies, n.place,
        transform(c.folded, digest -> unhex(sha2(lower(hex(concat(
            substring(n.brood, 1, int(c.place * {BYTES})), digest,
            substring(n.brood, int((c.place + 1) * {BYTES} + 1), {FAN * BYTES})))), 256))),
        n.hash, coalesce(c.subroot, n.subroot),
        concat(c.proof, substring(n.brood, 1, int(c.place * {BYTES})),
            substring(n.brood, int((c.place + 1) * {BYTES} + 1), {FAN * BYTES}))
    FROM climb c JOIN {{nodes}} n ON n.node = c.parent AND n.copy = pmod(xxhash64(c.node), c.parent_copies)
)
SELECT node, folded, hash, subroot, proof FROM climb WHERE parent IS NULL
"""


def proofs(spark: SparkSession, made: Manifest) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof (digests one after the other), folded_root, verified."""
    names = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("groups", "nodes")}
    made.groups.createOrReplaceTempView(names["groups"])
    made.nodes.createOrReplaceTempView(names["nodes"])
    limit = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")  # read when the query runs, and it runs inside this call
    try:
        arrived = stored(spark.sql(_CLIMB.format(**names)), "merkle-climb")
    finally:
        spark.conf.unset(ROW_LIMIT) if limit is None else spark.conf.set(ROW_LIMIT, limit)
        for name in names.values():
            spark.catalog.dropTempView(name)
    whole = arrived.join(made.groups.select("node", "doc_ids", "broods", F.col("brood").alias("runs")), "node")
    of_run = [F.slice(c, F.col("run") * FAN + 1, F.lit(FAN)).alias(c) for c in ("doc_ids", "folded")]
    shared = F.concat(_before(F.col("runs"), F.col("run")), _after(F.col("runs"), F.col("run")), F.col("proof"))
    runs = whole.select("*", F.posexplode("broods").alias("run", "brood"))
    runs = runs.select("hash", "subroot", shared.alias("proof"), "brood", F.arrays_zip(*of_run).alias("climbers"))
    one = runs.select("hash", "subroot", "proof", "brood", F.posexplode("climbers").alias("spot", "climber"))
    siblings = F.concat(_before(F.col("brood"), F.col("spot")), _after(F.col("brood"), F.col("spot")), F.col("proof"))
    return one.select(
        F.col("climber.doc_ids").alias("doc_id"),
        F.substring("brood", F.col("spot") * BYTES + 1, F.lit(BYTES)).alias("leaf"),
        "subroot", F.col("hash").alias("root"), siblings.alias("proof"),
        F.col("climber.folded").alias("folded_root"), (F.col("climber.folded") == F.col("hash")).alias("verified"),
    )


def digests(found: DataFrame) -> DataFrame:
    """``proofs`` as text: hex digests, and one digest for the whole proof."""
    return found.select(
        "doc_id", *(_hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        F.sha2(_hexed(F.col("proof")), 256).alias("proof_sha256"),
        _hexed(F.col("folded_root")).alias("folded_root"), "verified",
    )
