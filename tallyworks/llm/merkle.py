"""Merkle manifest of a dataset by a nested-struct rollup.

Leaves get their rank within their group by a distributed numbering. The lower `BITS` binary digits of the rank are columns, the
rest names the block of 2^BITS leaves. One shuffle brings a block together; then the digits are grouped away one after
another, each time nesting the nodes below into the struct of their parent, so every block ends as one row that holds its
subtree. `transform` walks that struct down, handing each node its siblings, and `explode` emits the leaves with their
paths: within a block nothing is joined. The rows of the blocks are leaves of the next tier, treated alike; its paths
come back by the number of the block, a row for 2^BITS leaves. No task holds more than a block, however large a group is.

A step of a path is what stands before and after the node in its run, so a fold of H(before, node, after) gives the root.

Cases: null fields are written `-`; a null doc_id comes first and is never tampered with; leaves that share a doc_id are ordered by
their digest, equal ones are leaves of their own; null is a group of its own, before all others; a group of one leaf has that leaf as
its subroot, a single group has its subroot as the root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.llm.staging import staged
from tallyworks.operators.ranking import number_rows, rank_within

BITS = 8
TAMPER_EVERY = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count and text, a null as `-`: no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, group: str = "lang") -> DataFrame:
    """(doc_id, group_name, group, leaf, tampered): `tampered` is the leaf after tampering, null where nothing changes."""
    columns = {"doc_id": F.col("doc_id").cast("long"), "n_chars": F.col("n_chars").cast("long")}
    own = [field(columns.get(c, F.col(c))) for c in FIELDS]
    changed = [field(F.col("n_chars").cast("long") + 1) if c == "n_chars" else part for c, part in zip(FIELDS, own)]
    chosen = (F.crc32(columns["doc_id"].cast("string").cast("binary")) % TAMPER_EVERY == 0) & F.col("n_chars").isNotNull()
    return docs.select(columns["doc_id"].alias("doc_id"), F.col(group).cast("string").alias("group_name"),
                       field(F.col(group)).alias("group"), digest(*own).alias("leaf"),
                       F.when(chosen, digest(*changed)).alias("tampered"))


def _rollup(nodes: DataFrame, bits: int) -> DataFrame:
    """(group, block, size, node, children): one row per block, its subtree nested.

    `nodes` has group, rank (from 0), size (nodes of the group), node (its digest) and payload.
    """
    digits = [F.shiftright("rank", k).bitwiseAND(F.lit(1)).cast("byte").alias(f"digit_{k}") for k in range(bits)]
    rows = (nodes.select("group", F.shiftright("rank", bits).alias("block"), "size", *digits, "node", "payload")
            .repartition("group", "block"))
    below = "payload"
    for k in range(bits):
        keys = ["group", "block", "size", *[f"digit_{j}" for j in range(k + 1, bits)]]
        child = F.struct(F.col(f"digit_{k}").alias("digit"), "node", F.col(below).alias("below"))
        rows = rows.groupBy(keys).agg(F.sort_array(F.collect_list(child)).alias("children"))
        # A level exists while the group has several nodes.
        joined = F.sha2(F.array_join(F.col("children.node"), "").cast("binary"), 256)
        rows = rows.withColumn("node", F.when(F.col("size") > (1 << k), joined).otherwise(F.col("children")[0]["node"]))
        below = "children"
    return rows


def _walk(children: Column, size: Column, above: list[Column], level: int) -> Column:
    """All leaves under `children` as (payload, node, steps); `above` holds the steps from there to the top."""

    def visit(child: Column, at: Column) -> Column:
        first, second = F.get(children, F.lit(0))["node"], F.get(children, F.lit(1))["node"]
        none = F.lit("")
        step = F.struct(F.when(at == 1, first).otherwise(none).alias("before"),
                        F.when(at == 0, F.coalesce(second, none)).otherwise(none).alias("after"))
        path = [F.when(size > (1 << level), F.array(step)).otherwise(F.array().cast(_STEPS)), *above]
        if level == 0:
            return F.array(F.struct(child["below"].alias("payload"), child["node"].alias("node"),
                                    F.concat(*path).alias("steps")))
        return _walk(child["below"], size, path, level - 1)

    return F.flatten(F.transform(children, visit))


def paths(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(group, payload, node, steps, top): every node with its path to the top of its group's tree."""
    blocks = staged(_rollup(nodes, bits), "merkle-blocks")
    if blocks.where(F.col("size") > (1 << bits)).isEmpty():
        upper = blocks.withColumn("above", F.array().cast(_STEPS)).withColumn("top", F.col("node"))
    else:
        higher = blocks.select("group", F.col("block").alias("rank"), F.ceil(F.col("size") / (1 << bits)).alias("size"),
                               "node", F.col("block").alias("payload"))
        known = paths(higher, bits).select("group", F.col("payload").alias("block"), F.col("steps").alias("above"), "top")
        upper = blocks.join(known, ["group", "block"])
    leaf = F.explode(_walk(F.col("children"), F.col("size"), [F.col("above")], bits - 1)).alias("leaf")
    return upper.select("group", "top", leaf).select("group", "leaf.payload", "leaf.node", "leaf.steps", "top")


def _sized(ranked: DataFrame) -> DataFrame:
    sizes = ranked.groupBy("group").agg(F.count("*").alias("size"))
    return ranked.join(sizes, "group")


def fold(node: Column, steps: Column) -> Column:
    """The root that a node and its path give."""
    return F.aggregate(steps, node, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]).cast("binary"), 256))


def manifest(docs: DataFrame, group: str = "lang", bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, tampered, subroot, root, steps): the proof of every row of `docs`, by groups, in order of doc_id."""
    rows = staged(leaves(docs, group), "merkle-leaves")
    ranked = rank_within(rows, ["group"], ["doc_id", "leaf", "tampered"]).withColumn("rank", F.col("rank") - 1)
    nodes = _sized(ranked).select("group", "rank", "size", F.col("leaf").alias("node"),
                                  F.struct("doc_id", "tampered", "group_name").alias("payload"))
    below = staged(paths(nodes, bits), "merkle-paths")

    roots = below.groupBy("group").agg(F.first("payload.group_name").alias("group_name"), F.first("top").alias("node"))
    placed = number_rows(roots, ["group_name"]).withColumn("rank", F.col("position") - 1)
    over = paths(_sized(placed.select(F.lit("").alias("group"), "rank", "node", F.col("group").alias("payload")))
                 .select("group", "rank", "size", "node", "payload"), bits)
    over = over.select(F.col("payload").alias("group"), F.col("steps").alias("last_steps"), F.col("top").alias("root"))
    return below.join(over, "group").select(
        "payload.doc_id", F.col("node").alias("leaf"), "payload.tampered", F.col("top").alias("subroot"), "root",
        F.concat("steps", "last_steps").alias("steps"))


def verified(proofs: DataFrame) -> DataFrame:
    """The contract's columns: the root folded from each row as it reads now, and whether it is the known one."""
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), "")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return (proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                          folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
