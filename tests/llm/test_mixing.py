"""The mix against its contract and a plain walk over slots."""

import math
import re

import pytest

from zoneflow.llm import mixing

from .conftest import frame


def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_fill_up():
    held = [("a", 100), ("b", 1000), ("c", 0), ("d", 50), (None, 10)]
    out = mixing.targets(held, (5, 2, 1), 1.5, 2)
    assert out[0] == 200 and out[2] == 0
    assert sum(out) == pytest.approx(1.5 * 1160)
    assert all(t <= 2 * n + 1e-9 for t, (_, n) in zip(out, held, strict=True))
    assert mixing.targets([], (5, 2, 1), 1.5, 2) == [] and mixing.targets([("a", 0)], (5,), 1.5, 2) == [0.0]


def test_schedule_is_even_everywhere(spark):
    wanted = [500.0, 300.0, 0.0, 200.0]
    rows = sorted(mixing.schedule(spark, wanted, 1).collect())
    seen = [0] * 4
    for slot, source, rank in rows:
        assert rank == seen[source]
        u = (slot + 1) * mixing.PHI % 1
        assert source == (0 if u < 0.5 else 1 if u < 0.8 else 3)
        seen[source] += 1
        assert all(abs(seen[s] - (slot + 1) * w / 1000) < 4 for s, w in enumerate(wanted))
    assert all(n >= w for n, w in zip(seen, wanted, strict=True))


def check(spark, rows, **params):
    got = mixing.mix(frame(spark, rows), **params).collect()
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5), **params).collect()
    key = lambda r: repr((r["doc_id"], r["size"], r["start"]))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    held = {}
    for r in rows:
        held[r[3]] = held.get(r[3], 0) + words_in(r[1])
    order = sorted(held, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([(s, held[s]) for s in order], (5, 2, 1), 1.5, 2), strict=True))
    assert sorted((repr(r["doc_id"]), r["size"]) for r in got) == sorted((repr(r[0]), words_in(r[1])) for r in rows)
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == held[s] and r["target"] == pytest.approx(target[s]) for r in own)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        limit = math.floor(target[s])
        assert sum(r["taken"] for r in own) == limit
        for r in own:  # whole passes, and what the last one reaches
            a, n = r["start"], held[s]
            want = sum(max(0, min(limit - p * n, a + r["size"]) - a) for p in range(2))
            assert r["taken"] == want
    return sorted(got, key=key)


@pytest.mark.parametrize("params", [{}, {"block": 7, "bucket_rows": 9}])
def test_contract(spark, params):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), None, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(400)]
    rows += [(400, None, None, "s1"), (401, "", None, "empty"), (402, "x y\tz", None, None), (403, " ".join("v" * 9000), None, "s2")]
    check(spark, rows, **params)


def test_messy_rows(spark, messy_rows):
    check(spark, messy_rows)


def test_nothing(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]
