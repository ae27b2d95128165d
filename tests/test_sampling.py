import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import sampling


def place(seed, *key):
    return hashlib.md5("|".join(map(str, (seed, *key))).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds most of the rows.
    data = [(i, "hot" if i % 10 < 8 else f"c{i % 3}") for i in range(3000)] + [(9001, "single"), (9002, None)]
    return spark.createDataFrame(data, "k int, g string"), data


def lowest(data, seed, size):
    groups = {}
    for k, g in data:
        groups.setdefault(g, []).append(k)
    return {k for g, ks in groups.items() for k in sorted(ks, key=lambda k: place(seed, k))[: max(0, size(g, len(ks)))]}


def test_split_is_exact_and_seeded(rows):
    df, data = rows
    known = [(k, g) for k, g in data if g is not None]
    out = sampling.split(df, ["g"], 0.8, 7, ["k"]).collect()
    assert len(out) == len(data)
    got = {r.k for r in out if r.in_train and r.g is not None}
    assert got == lowest(known, 7, lambda g, n: round(0.8 * n))


def test_take_sizes_from_table_and_edges(spark, rows):
    df, data = rows
    sizes = spark.createDataFrame([("hot", 100), ("c0", 10**6), ("c1", 0)], "g string, want int")
    got = {r.k for r in sampling.take(df, ["g"], F.col("want"), 3, ["k"], sizes).collect()}
    want = {"hot": 100, "c0": 10**6}
    assert got == lowest([d for d in data if d[1] in want], 3, lambda g, n: want[g])


def test_sample_n_over_whole_table(rows):
    df, data = rows
    got = {r.k for r in sampling.sample_n(df, 17, 5, ["k"]).collect()}
    assert got == set(sorted((k for k, _ in data), key=lambda k: place(5, k))[:17])


def test_draw_with_replacement_matches_brute_force(spark):
    data = [(i, "ab"[i % 4 == 0]) for i in range(200)]
    df = spark.createDataFrame(data, "k int, g string")
    got = sorted((r.g, r.draw_no, r.k) for r in sampling.draw(df, ["g"], F.col("_total") * 2 + 1, 13, ["k"]).collect())
    want = []
    for g in "ab":
        ranked = sorted((k for k, x in data if x == g), key=lambda k: place(13, k))
        for j in range(2 * len(ranked) + 1):
            want.append((g, j, ranked[int(place(13, "draw", g, j)[:15], 16) % len(ranked)]))
    assert got == sorted(want)


def test_upsample_and_resample_counts(spark, rows):
    df, data = rows
    before = Counter(g for _, g in data)
    up = Counter(r.g for r in sampling.upsample(df, "g", {"c0": 10, "single": 2}, 1, ["k"]).collect())
    assert up["c0"] == 10 * before["c0"] and up["single"] == 2 and up["hot"] == before["hot"] and up[None] == 1
    targets = spark.createDataFrame([("hot", 50), ("c0", 500), ("single", 4)], "g string, target int")
    out = sampling.resample(df, "g", targets, 1, ["k"]).collect()
    after = Counter(r.g for r in out)
    assert (after["hot"], after["c0"], after["single"], after["c1"]) == (50, 500, 4, before["c1"])
    kept = {r.k for r in out if r.g == "c0" and r.draw_no is None}
    assert kept == {k for k, g in data if g == "c0"}


def test_three_way(rows):
    df, data = rows
    known = df.where("g is not null")
    parts = Counter(r.part for r in sampling.three_way(known, ["g"], 2, ["k"]).collect())
    assert sum(parts.values()) == len(data) - 1 and parts["train"] > parts["valid"] > 0 and parts["test"] > 0


def test_three_way_splits_off_the_same_rows_twice(rows):
    df, data = rows
    want = {}
    for g in {g for _, g in data}:
        left = sorted((k for k, c in data if c == g), key=lambda k: place(2, k))
        cut = round(0.75 * len(left))
        want |= dict.fromkeys(left[cut:], "test")
        left = sorted(left[:cut], key=lambda k: place(3, k))
        cut = round(0.75 * len(left))
        want |= dict.fromkeys(left[:cut], "train") | dict.fromkeys(left[cut:], "valid")
    split = sampling.three_way(df, ["g"], 2, ["k"])
    assert {r.k: r.part for r in split.collect()} == want
    # the rows are read once for the result; the rest are the two cuts
    found = split._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = sorted(found.apply(i).nodeName() for i in range(found.size()))
    assert len(leaves) == 3 and leaves[:2] == ["InMemoryRelation"] * 2


def test_rows_outside_are_not_marked(rows):
    df, data = rows
    even = F.col("k") % 2 == 0
    got = {r.k for r in sampling.flag_sample(df, ["g"], F.lit(5), 4, ["k"], within=even).where("in_sample").collect()}
    for g in {g for _, g in data}:
        inside = sorted((k for k, c in data if c == g and k % 2 == 0), key=lambda k: place(4, k))
        assert got & {k for k, c in data if c == g} == set(inside[:5])


def test_flagging_does_not_shuffle_the_rows(rows):
    df, _ = rows
    plan = sampling.split(df.where("g is not null"), ["g"], 0.5, 1, ["k"])._jdf.queryExecution().executedPlan().toString()
    top = plan.split("InMemoryTableScan")[0]
    assert "Exchange hashpartitioning" not in top


def test_rows_without_a_class_are_a_class(spark):
    df = spark.createDataFrame([(i, "a" if i < 40 else None) for i in range(80)], "k int, g string")
    assert sampling.split(df, ["g"], 0.75, 1, ["k"]).where("in_train and g is null").count() == 30
    parts = {(r.g, r.part): r["count"] for r in sampling.three_way(df, ["g"], 1, ["k"]).groupBy("g", "part").count().collect()}
    assert parts[None, "test"] == parts["a", "test"] == 10 and sum(parts.values()) == 80
    assert sampling.take(df, ["g"], F.lit(7), 1, ["k"]).groupBy("g").count().count() == 2
    drawn = sampling.draw(df, ["g"], F.lit(50), 1, ["k"])
    assert {r.g: r["count"] for r in drawn.groupBy("g").count().collect()} == {"a": 50, None: 50}


def test_repeated_keys_across_a_cut_fail(spark):
    df = spark.createDataFrame([(i // 10, i) for i in range(40)], "k int, v int")
    assert sampling.sample_n(df, 20, 1, ["k"]).count() == 20
    with pytest.raises(Exception, match="repeated key"):
        sampling.sample_n(df, 7, 1, ["k"]).count()


def test_ranks_are_the_order_of_places(rows):
    df, data = rows
    got = {r.k: r["rank"] for r in sampling.ranked(df, ["g"], 5, ["k"]).collect()}
    hot = sorted((k for k, g in data if g == "hot"), key=lambda k: place(5, k))
    assert [got[k] for k in hot] == list(range(len(hot))) and len(got) == len(data)
