"""Keyed tables, ranking, sampling, integrity and surrogate ids."""

import random

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import integrity, keyed, ranking, sampling, surrogates
from tallyworks.sources.intake import split_keyed


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([(1, 10, "a"), (2, 10, "b")], "k int, t int, v string")


def test_insert_ignore_keeps_the_first(spark, stored):
    new = spark.createDataFrame([(2, 99, "x"), (3, 6, "late"), (3, 5, "early"), (4, 1, "d")], stored.schema)
    merged = keyed.insert_ignore(stored, new, ["k"], [F.asc("t")])
    assert rows(merged) == [(1, 10, "a"), (2, 10, "b"), (3, 5, "early"), (4, 1, "d")]
    assert rows(keyed.insert_ignore(merged, new, ["k"], [F.asc("t")])) == rows(merged)


def test_insert_ignore_of_rows_of_the_target_itself(stored):
    assert rows(keyed.insert_ignore(stored, stored.filter("k = 1"), ["k"], [F.asc("t")])) == rows(stored)


def test_upsert_keeps_the_last_and_is_idempotent(spark, stored):
    new = spark.createDataFrame([(1, 11, "new"), (1, 12, "newer"), (2, 9, "older"), (3, 1, "c")], stored.schema)
    merged = keyed.upsert(stored, new, ["k"], ["t"])
    assert rows(merged) == [(1, 12, "newer"), (2, 10, "b"), (3, 1, "c")]
    assert rows(keyed.upsert(merged, new, ["k"], ["t"])) == rows(merged)


def test_upsert_tie_goes_to_the_new_row(spark, stored):
    new = spark.createDataFrame([(1, 10, "A")], stored.schema)
    assert (1, 10, "A") in rows(keyed.upsert(stored, new, ["k"], ["t"]))


def test_newest_per_key_with_ties_and_hot_key(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), (F.col("id") % 11).alias("t"), "id")
    got = rows(keyed.newest_per_key(df, ["k"], [F.desc("t"), F.asc("id")], 3))
    by_key = {}
    for k, t, i in (tuple(r) for r in df.collect()):
        by_key.setdefault(k, []).append((-t, i, k, t))
    want = sorted((k, t, i) for group in by_key.values() for _, i, k, t in sorted(group)[:3])
    assert got == want


def test_number_rows_is_dense_and_exact(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v // 2000, v) for v in values], "tie int, v int").repartition(7)
    got = ranking.number_rows(df, [F.desc("tie"), "v"]).collect()
    order = sorted(got, key=lambda r: (-r["tie"], r["v"]))
    assert [r["position"] for r in order] == list(range(1, 5001))


def test_rank_within_with_hot_group_and_null_group(spark):
    data = [("hot", i % 50, i) for i in range(2000)] + [("cold", 1, 1), ("cold", 2, 2)] + [(None, 5, 1), (None, 6, 2)]
    df = spark.createDataFrame(data, "g string, m int, k int")
    got = {(r["g"], r["k"]): r["rank"] for r in ranking.rank_within(df, ["g"], [F.desc("m"), "k"]).collect()}
    want = {}
    for g in ("hot", "cold", None):
        for i, (_, m, k) in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2])), 1):
            want[(g, k)] = i
    assert got == want


def test_ranking_an_empty_frame(spark):
    assert ranking.number_rows(spark.range(0), ["id"]).count() == 0


def test_top_n_tie_at_the_cut(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "name string, m int")
    assert [r["name"] for r in ranking.top_n(df, [F.desc("m"), "name"], 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("n", [5, 12_000, 60_000])
def test_bounded_sample_is_the_first_rows(spark, n):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("v"), "id").repartition(5)
    got = sorted(r["v"] for r in sampling.bounded_sample(df, n, ("v", "id")).collect())
    assert got == list(range(min(n, 50_000)))


def test_bounded_sample_with_one_hot_value_and_nulls(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 100, None).when(F.col("id") < 20_000, 1).otherwise(2).alias("v"), "id")
    got = sorted(r["id"] for r in sampling.bounded_sample(df, 11_000, ("v", "id")).collect())
    assert got == list(range(11_000))


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,2)", "double", "string"])
def test_bounded_sample_by_other_types(spark, kind):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 300).cast("int"))
    lead = (F.col("id") * 7 % 300).cast(kind) if kind in ("decimal(12,2)", "double", "string") else day.cast(kind)
    df = spark.range(9_000).select(lead.alias("v"), "id").repartition(3)
    got = sorted(r["id"] for r in sampling.bounded_sample(df, 2_000, ("v", "id")).collect())
    assert got == sorted(r["id"] for r in df.orderBy("v", "id").collect()[:2_000])


def test_bounded_sample_narrows_down_a_wide_range(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, 10 ** 15).otherwise(F.col("id") * 3).alias("v"))
    assert sorted(r["v"] for r in sampling.bounded_sample(df, 1_500, ("v",)).collect()) == [
        3 * i for i in range(1_501) if i != 7]


def test_bounded_sample_of_equal_rows(spark):
    assert sampling.bounded_sample(spark.range(5_000).select(F.lit(1).alias("v")), 1_200, ("v",)).count() == 1_200


def test_bounded_sample_has_no_limit_in_one_task(spark):
    df = spark.range(3_000).select(F.col("id").cast("string").alias("event_id"))
    plan = sampling.bounded_sample(df, 1_000)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(integrity.orphans(child, "fk", parent, "id")) == [(9, 2)]
    assert rows(integrity.orphan_report([("c.fk", child, "fk", parent, "id")])) == [("c.fk", 1, 2)]


def test_cascade(spark):
    junction = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3)], "u int, i int")
    users = spark.createDataFrame([(1,), (3,)], "u int")
    interests = spark.createDataFrame([(1,), (3,)], "i int")
    assert rows(integrity.cascade(junction, [("u", users), ("i", interests)])) == [(1, 1), (3, 3)]


def test_lookup_dimension(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("B",), ("é",)], "x string")
    assert rows(surrogates.lookup_dimension(df, "x", "id", "name")) == [(1, "B"), (2, "a"), (3, "b"), (4, "é")]


def test_lookup_dimension_with_collation(spark):
    df = spark.createDataFrame([("Café",), ("cafe",), ("CAFE",), ("tea",)], "x string")
    assert rows(surrogates.lookup_dimension(df, "x", "id", "name", "UNICODE_CI_AI")) == [(1, "CAFE"), (2, "tea")]


def test_attach_ids(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "name string, n int")
    dim = spark.createDataFrame([("a", 10), ("a", 11), ("b", 12)], "name string, id int")
    assert rows(surrogates.attach_ids(facts, "name", dim, "name", "id").select("n", "id")) == [(1, 11), (2, 12)]
    kept = surrogates.attach_ids(facts, "name", dim, "name", "id", "left").select("n", "id").collect()
    assert {r["n"]: r["id"] for r in kept} == {1: 11, 2: 12, 3: None, 4: None}


def test_split_keyed(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (2, None)], "a int, b string")
    good, bad = split_keyed(df, "a", "b")
    assert rows(good) == [(1, "x")] and bad.count() == 2
