"""Exact and line deduplication against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from zoneflow.llm import exact_dedup, line_dedup

from .conftest import frame

WS = re.compile(r"[\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[WS.sub(" ", r[1] or "")].append(r[0])
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_messy_rows(spark, messy_rows):
    assert order(exact_dedup.exact_dedup(frame(spark, messy_rows)).collect()) == order(brute_exact(messy_rows))


def test_colliding_keys_are_told_apart_and_buckets_split(spark):
    rows = [(i, f"text {i % 150}") for i in range(400)]
    docs = frame(spark, rows)
    whole = exact_dedup.build_index(docs, capacity=4, key_bits=6)
    index = whole.records.cache()
    assert index.count() == 150 and index.where("chain > 0").count() > 0
    per = {(r["bucket"], r["depth"]): r["n"] for r in index.groupBy("bucket", "depth").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert len(per) > 8
    assert all(b >> d == 1 for b, d in per)
    assert all(n <= 4 or d >= 6 for (_, d), n in per.items())
    assert order(exact_dedup.lookup(exact_dedup.keyed(docs, 6), whole).collect()) == order(brute_exact(rows))


def test_a_wrong_directory_loses_documents(spark):
    """Documents are found, and texts compared, only where the directory leads."""
    rows = [(i, f"text {i % 150}") for i in range(400)]
    docs = frame(spark, rows)
    keys = exact_dedup.keyed(docs)
    index = exact_dedup.build_index(docs, capacity=4)
    astray = index.directory.withColumn("bucket", F.col("bucket") + 1)
    assert exact_dedup.lookup(keys, index._replace(directory=astray)).count() == 0
    one = exact_dedup.directory(keys, 1_000)
    assert one.select("bucket").distinct().count() == 1
    assert exact_dedup.lookup(keys, index._replace(directory=one)).count() == 0


def test_copies_are_added_up_over_parts_of_the_input(spark):
    rows = [(i, "one  text" if i % 3 else f"other {i}") for i in range(300)]
    docs = frame(spark, rows).repartition(20)
    assert order(exact_dedup.exact_dedup(docs, capacity=16).collect()) == order(brute_exact(rows))
    owners = exact_dedup.build_index(docs, capacity=16).records.groupBy("bucket").count()
    assert owners.count() > 4


def test_directory_without_splits_has_one_bucket(spark):
    index = exact_dedup.build_index(frame(spark, [(i, str(i)) for i in range(20)])).records
    assert {(r["bucket"], r["depth"]) for r in index.collect()} == {(1, 0)}


def test_empty_tables(spark):
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def brute_lines(rows, least):
    split = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UP)
    docs = defaultdict(set)
    for at, (i, ls) in enumerate(split):
        docs[("row", at) if i is None else i] |= {key(x) for x in ls if key(x)}
    seen = Counter(k for keys in docs.values() for k in keys)
    out = []
    for i, ls in split:
        kept = [x for x in ls if seen[key(x)] < least or not key(x)]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return out


def test_lines(spark, messy_rows):
    rows = messy_rows + [(100 + i, f"Shared LINE here\r\nown {i}\n\nÉcole\n  ") for i in range(6)]
    rows += [(200 + i, "École\nécole\n shared line here  ") for i in range(4)]
    rows.append((300, "shared line here\n" * 3000 + "end\n" + "École"))
    for least, limit in ((10, 1000), (10, 0), (2, 1000)):
        got = line_dedup.line_dedup(frame(spark, rows), least, limit).collect()
        assert order(got) == order(brute_lines(rows, least))


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "copied\nline")] * 12 + [(None, "no id")] * 10 + [(i % 3, f"spread\n{i}") for i in range(20)]
    got = line_dedup.line_dedup(frame(spark, rows)).collect()
    assert order(got) == order(brute_lines(rows, 10))
    assert {r["n_dropped"] for r in got if r["doc_id"] == 1} == {0} and {r["n_dropped"] for r in got if r["doc_id"] is None} == {1}


def test_native_plans(spark, messy_rows):
    for df in (exact_dedup.exact_dedup(frame(spark, messy_rows)), line_dedup.line_dedup(frame(spark, messy_rows))):
        assert "Python" not in df._jdf.queryExecution().toString()
