"""The Merkle manifest against plain Python: trees of all small sizes, tiers of blocks, tampering, edge rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import edge
from compare import connect, difference
from tallyworks.llm import merkle
from tallyworks.llm.oracle import ORACLE
from tallyworks.llm.queries import op13_merkle_manifest
from tallyworks.llm.staging import staged


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """(top, path of each node): a path is a list of (before, after)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, own in enumerate(at):
            run = level[own // 2 * 2:own // 2 * 2 + 2]
            paths[k].append(("".join(run[:own % 2]), "".join(run[own % 2 + 1:])))
            at[k] = own // 2
        level = [h(*level[k:k + 2]) for k in range(0, len(level), 2)]
    return (level[0] if level else None), paths


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        other = None
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            other = h(*map(field, (doc_id, source, lang, n_chars + 1, text)))
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, other, doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3] + (r[3] or "",))
        subs[name] = tree([r[2] for r in groups[name]])
    root, crown = tree([subs[name][0] for name in names])
    out = []
    for name, last in zip(names, crown):
        for (_, _, leaf, other, doc_id), path in zip(groups[name], subs[name][1]):
            folded = other or leaf
            for before, after in path + last:
                folded = h(before, folded, after)
            proof = h(*[b + a for b, a in path + last])
            out.append((doc_id, leaf, subs[name][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def frame(spark, rows):
    wide = [(*r, 1, 2, "n", "p", "g") for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, rank long, "
                                       "size long, node string, payload string, group string").repartition(4)


def got(docs, **options):
    return sorted((tuple(r) for r in merkle.verified(merkle.manifest(docs, **options)).collect()), key=str)


def sample(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((rng.choice([None, *range(10**6)]), rng.choice([None, "", "tëxt " * rng.randint(1, 9)]), lang,
                         rng.choice([None, "s"]), rng.choice([None, 0, 9, 99, 10**12])))
    return rows


@pytest.mark.parametrize("sizes, options", [
    ({"a": 1}, {}), ({None: 2}, {}), ({"a": 1, "b": 2, None: 3, "": 4, "-": 5, "Z": 9}, {}),
    ({"a": 37, "b": 5, "ü": 17, None: 1, "c": 64}, {"bits": 2}), ({"a": 300, "b": 257, "c": 256}, {}),
    ({"a": 33, "b": 32}, {"bits": 1}),
])
def test_equals_the_definition(spark, sizes, options):
    rows = sample(sizes)
    assert got(frame(spark, rows), **options) == plain(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(7, "t", "l", "s", 3)] * 3 + [(7, "u", "l", "s", 3), (7, "t", "l", None, None)] + [(None, None, None, None, None)] * 2
    assert got(frame(spark, rows)) == plain(rows)


def test_only_tampered_rows_fail(spark):
    rows = [(k, "text", "l", "s", 4) for k in range(100)]
    bad = {r[0] for r in got(frame(spark, rows)) if not r[6]}
    assert bad == {k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 0} and bad


def test_many_groups(spark):
    rows = [(k, f"t{k}", f"lang {k % 300}", None, k) for k in range(600)]
    assert got(frame(spark, rows), bits=4) == plain(rows)


def test_edge_rows_and_empty_table(spark):
    docs = edge.documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert got(docs) == plain(rows)
    assert got(edge.no_documents(spark)) == []


def test_paths_inside_a_block_need_no_join(spark):
    nodes = staged(spark.range(200).select(F.lit("g").alias("group"), F.col("id").alias("rank"), F.lit(200).alias("size"),
                                           F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("node"),
                                           F.struct("id").alias("payload")), "nodes")
    plan = merkle._rollup(nodes, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    found = merkle.paths(nodes)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 200


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    assert difference(op13_merkle_manifest(spark, d), connect(d), ORACLE["op13_merkle_manifest"]) is None
