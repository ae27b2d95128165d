"""Decontamination and substring deduplication: planted passages and plain Python."""

import random

import numpy as np
import pytest

from zoneflow.llm import decontaminate, substring_dedup

from .conftest import frame


def prose(rng, n):
    return " ".join("".join(rng.choice("bdfklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [2, 20_000])
def test_planted_passages(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    rng = random.Random(3)
    bench = [(i, prose(rng, rng.randint(10, 50))) for i in range(12)]
    bench += [(20, None), (21, ""), (22, "too short"), (None, prose(rng, 20))]
    docs, want = [], set()
    for d in range(120):
        words = prose(rng, 200).split()
        if d % 3 == 0:
            i, t = bench[d % 12]
            own = t.split()
            for at in range(3, len(own), 11):  # replaced words
                own[at] = "zzz"
            at = rng.randint(0, 200)
            words[at:at] = ["«"] * (d % 2) + [w.upper() + "," if d % 2 else w for w in own]
            want.add((d, i))
        docs.append((d, "  ".join(words)))
    docs += [(500, None), (501, ""), (None, bench[-1][1]), (502, bench[0][1]), (502, bench[0][1])]
    got = decontaminate.overlaps(frame(spark, docs), items(spark, bench)).collect()
    pairs = [(r["doc_id"], r["item_id"]) for r in got]
    assert set(pairs) == want | {(None, None), (502, bench[0][0])} and pairs.count((502, bench[0][0])) == 2
    assert all(r["n_agree"] >= 0.75 * r["n_tokens"] for r in got)
    kept = decontaminate.decontaminate(frame(spark, docs), items(spark, bench))
    assert kept.columns == frame(spark, docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs if d[0] is not None} - {d for d, _ in want} - {502}


def brute_overlaps(docs, bench, least, share, masks):
    """Every stretch of every diagonal that has an equal window, word by word."""
    out = set()
    for d, text in docs:
        own = [str(w, "utf-8") for w in decontaminate.tokens(text)]
        for i, t in bench:
            item, best = [str(w, "utf-8") for w in decontaminate.tokens(t)], None
            whole = ["1" * len(item)] + ["1" * k + "0" + "1" * (len(item) - k - 1) for k in range(1, len(item) - 1)]
            mine = whole if 4 <= len(item) < min(map(len, masks)) else masks
            for diagonal in range(-len(item), len(own)):
                places = [p for p in range(len(item)) if 0 <= p + diagonal < len(own)]
                same = {p: item[p] == own[p + diagonal] for p in places}
                if not any(all(m == "0" or same.get(p + k, False) for k, m in enumerate(mask)) and p + len(mask) - 1 in same
                           for mask in mine for p in places):
                    continue
                agree = [p for p in places if same[p]]
                stretches = [(p, q + 1, sum(same[x] for x in range(p, q + 1))) for p in agree for q in agree if q >= p]
                gain = lambda s: s[2] - decontaminate.PENALTY * (s[1] - s[0] - s[2])
                top = max(map(gain, stretches))
                got = min((s for s in stretches if gain(s) == top), key=lambda s: (s[1], -s[0]))
                if got[2] < share * (got[1] - got[0]):
                    got = max((s for s in stretches if s[2] >= share * (s[1] - s[0])), key=lambda s: s[1] - s[0])
                n = got[1] - got[0]
                if n >= min(least, len(item)) and (best is None or got[2] > best):
                    best = got[2]
            if best is not None:
                out.add((d, i, best))
    return out


def test_against_every_stretch(spark):
    rng = random.Random(11)
    few = [prose(rng, 1) for _ in range(40)]
    bench = [(i, " ".join(rng.choice(few) for _ in range(n))) for i, n in enumerate([3, 4, 5, 7, 7, 8, 9, 12, 20, 30, 40, 40])]
    docs = []
    for d in range(90):
        words = [rng.choice(few) for _ in range(60)]
        own = bench[d % 12][1].split()
        for at in range(d % 5, len(own), 3 + d % 4):
            own[at] = rng.choice(few)
        words[20:20] = own
        docs.append((d, " ".join(words)))
    for masks in (decontaminate.MASKS, ("11101011",)):
        got = decontaminate.overlaps(frame(spark, docs), items(spark, bench), masks=masks).collect()
        assert {(r["doc_id"], r["item_id"], r["n_agree"]) for r in got} == brute_overlaps(docs, bench, 10, 0.75, masks)


def test_every_fourth_word_replaced_and_short_items(spark):
    rng = random.Random(12)
    bench = [(1, prose(rng, 40)), (2, prose(rng, 7)), (3, prose(rng, 4)), (4, prose(rng, 3))]
    docs = []
    for off in range(4):
        own = bench[0][1].split()
        own[off::4] = ["zzz"] * len(own[off::4])
        docs.append((off, " ".join([prose(rng, 30 + off), *own, prose(rng, 30)])))
    docs += [(10 + i, f"{prose(rng, 20)} {t} {prose(rng, 20)}") for i, t in bench]
    hole = bench[1][1].split()
    docs.append((20, " ".join([*hole[:3], "zzz", *hole[4:]])))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(frame(spark, docs), items(spark, bench)).collect()}
    assert got == {*((d, 1) for d in range(4)), (11, 1), (12, 2), (13, 3), (20, 2)}


def test_enough_of_a_loose_stretch(spark):
    """Two of three words agree over most of it, but twelve words in a row all do."""
    rng = random.Random(13)
    item = prose(rng, 48)
    own = item.split()
    own[0:36:3] = ["zzz"] * 12
    got = decontaminate.overlaps(frame(spark, [(1, " ".join(own))]), items(spark, [(7, item)])).collect()
    assert len(got) == 1 and got[0]["n_tokens"] >= 12 and got[0]["n_agree"] >= 0.75 * got[0]["n_tokens"]


def test_empty_sides(spark):
    some, none = frame(spark, [(1, "a b c d e f g h i j k l")]), frame(spark, [])
    assert decontaminate.overlaps(none, items(spark, [(1, "a b")])).count() == 0
    assert decontaminate.overlaps(some, items(spark, [])).count() == 0
    assert decontaminate.decontaminate(some, items(spark, [])).count() == 1


def test_given_benchmark_is_found(spark, documents):
    from .conftest import SF
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r["item_id"]: " ".join(r["text"].split()) for r in bench.collect()}
    want = {r["doc_id"] for r in documents.collect() if any(t in " ".join(r["text"].split()) for t in texts.values())}
    got = {r["doc_id"] for r in decontaminate.overlaps(documents, bench).collect()}
    assert want and want <= got


def test_gear_hash_is_the_rolling_one():
    data = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    want, h = [], 0
    for b in data.tolist():
        h = (h << 1) + int(substring_dedup.GEAR[b]) & 0xFFFF
        want.append(h)
    assert substring_dedup.gear_hash(data).tolist() == want
    assert substring_dedup.gear_hash(data[:5]).tolist() == want[:5]


def test_chunks_cover_and_resist_shifts():
    data = prose(random.Random(1), 3000).encode()
    ends = substring_dedup.chunks(data, 20, 16, 256)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= 256 and (sizes[:-1] >= 16).all()
    moved = substring_dedup.chunks(b"inserted " + data, 20, 16, 256)
    assert len({e - 9 for e in moved} & set(ends)) > 0.95 * len(ends)
    assert substring_dedup.chunks(b"a" * 5000, 20, 16, 256)[-1] == 5000


def brute_spans(rows, one_in, least, most, min_bytes):
    own, seen = [], {}
    for i, t in rows:
        data, at, mine = (t or "").encode(), 0, []
        for e in substring_dedup.chunks(data, one_in, least, most) if data else []:
            mine.append((at, e, data[at:e]))
            at = e
        own.append((i, mine))
        for n, (_, _, c) in enumerate(mine):
            seen.setdefault(c, []).append((i, n))
    out = []
    for i, mine in own:
        run = []
        for n, (a, e, c) in enumerate([*mine, (0, 0, None)]):
            if c is not None and len(seen[c]) > 1:
                run.append((a, e, e - a if min(seen[c]) != (i, n) else 0))
            elif run:
                if run[-1][1] - run[0][0] >= min_bytes:
                    out.append((i, run[0][0], run[-1][1], len(run), sum(x[2] for x in run)))
                run = []
    return sorted(out)


def planted(rng):
    shared = [prose(rng, 60) for _ in range(4)]
    rows = []
    for d in range(60):
        words = prose(rng, 150)
        if d % 4 == 0:
            at = rng.randint(0, 300)
            words = words[:at] + " " + shared[d % 16 // 4] + " " + words[at:]
        rows.append((d, words))
    return rows + [(100, rows[1][1]), (101, shared[0] + " x " + shared[0]), (102, None), (103, "")]


def test_spans(spark):
    rows = planted(random.Random(5))
    got = substring_dedup.repeated_spans(frame(spark, rows)).select("doc_id", "start", "stop", "n_chunks", "n_bytes_dropped").collect()
    assert sorted(map(tuple, got)) == brute_spans(rows, 20, 16, 1024, 120)
    assert {r["doc_id"] for r in got} == {d for d in range(0, 60, 4)} | {1, 100, 101}


def test_texts(spark):
    rows = planted(random.Random(6))
    got = {r["doc_id"]: r["text"] for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and got[1] == rows[1][1] and got[100] == "" and got[102] == got[103] == ""
    drop = {}
    for i, _, _, _, n in brute_spans(rows, 20, 16, 1024, 120):
        drop[i] = drop.get(i, 0) + n
    assert all(len(got[i]) == len(t or "") - drop.get(i, 0) for i, t in rows)


def test_of_texts_under_one_id_or_none_one_copy_stays(spark):
    rng = random.Random(9)
    shared = prose(rng, 80)
    for ids in ([None] * 3, [5, 5, 5], [5, None, None], [5, 5, None]):
        rows = [(i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for i in ids]
        texts = [r["text"] for r in substring_dedup.substring_dedup(frame(spark, [*rows, rows[0]])).where("text <> ''").collect()]
        middle = shared[200:-200]
        # the first row stands twice, and its repeat drops nothing by itself
        assert sum(middle in t for t in texts) in (1, 2) and len({t for t in texts if middle in t}) == 1
        assert sum(len(t) < 700 for t in texts) >= 2


def test_messy_and_empty(spark, messy_rows):
    spans = substring_dedup.repeated_spans(frame(spark, messy_rows), min_bytes=20).collect()
    assert {5} <= {r["doc_id"] for r in spans} and not {2, 3, 8} & {r["doc_id"] for r in spans}
    assert substring_dedup.substring_dedup(frame(spark, messy_rows)).count() == len(messy_rows)
    assert substring_dedup.repeated_spans(frame(spark, [])).count() == 0
