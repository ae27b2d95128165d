"""The pipeline, stage by stage, against plain Python over its own input."""

import public_tokenizers
import pytest

import corpus_pipeline
from zoneflow.llm import decontaminate, language_id, mixing
from zoneflow.llm.queries import ORACLES, QUERIES

from .conftest import SCHEMA, SF, with_clashes
from .test_simhash import brute_fingerprint, brute_groups
from .test_tokens import brute_files


@pytest.fixture(scope="module")
def steps(spark, documents):
    given = spark.createDataFrame([(900, None, None, None, 0), (901, "12 !", None, "s", 4), (902, documents.first()["text"], "en", None, 9)], SCHEMA)
    docs, out = documents.select("doc_id", "text", "lang", "source", "n_chars").union(given), []
    docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(SF)).cache()
        out.append((name, docs))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_language_stage(steps, documents):
    got = steps[0][1]
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in documents.collect()} | {902}
    assert got.columns == documents.columns


def test_language_stage_without_languages(spark):
    given = [(1, "some text", None, "s", 9), (2, None, None, "s", 0), (3, "12 !", None, None, 4), (None, "é", None, None, 1), (4, "", None, "s", 0)]
    got = corpus_pipeline.find_language(spark, spark.createDataFrame(given, SCHEMA), str(SF))
    assert rows(got) == sorted([given[0], given[3]], key=repr)


def test_a_language_may_be_called_und(spark):
    given = [(i, f"some clean text number {i}", "und" if i % 2 else "en", "s", 9) for i in range(30)] + [(90, "12 !", "und", "s", 4)]
    got = corpus_pipeline.find_language(spark, spark.createDataFrame(given, SCHEMA), str(SF))
    assert {r["doc_id"] for r in got.collect()} == set(range(30))


def test_stages_with_map_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    given = [(i % 9, f"text {i % 4} of many words " * 3, "en", f"s{i % 2}", 9) for i in range(24)]
    docs = with_clashes(spark.createDataFrame(given, SCHEMA)).withColumn("tags", F.create_map(F.lit("k"), F.col("n_chars")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(SF)).cache()
        assert "tags" in docs.columns and docs.count() > 0, name
    # one row of each (id, text) class's group is left, and the mix gives it once or twice
    assert docs.select("doc_id", "text").distinct().count() <= 4


def test_stages_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(SF))
        assert docs.count() == 0


def test_near_dedup_stage(steps):
    before = steps[0][1].collect()
    keep = {i for i, _, c in brute_groups([(r["doc_id"], brute_fingerprint(r["text"])) for r in before]) if i == c}
    assert rows(steps[1][1]) == sorted((tuple(r) for r in before if r["doc_id"] in keep), key=repr)


def test_near_dedup_decides_by_row(spark):
    """Null and repeated ids: a row goes for a near copy only, whatever rows share its id."""
    text = {c: " ".join(f"{c}{i * 7919 % 1000}" for i in range(60)) for c in "abcdefgh"}
    given = [(1, text["a"]), (None, text["a"]), (None, text["b"]), (None, text["c"]), (None, text["c"]), (5, text["d"]), (5, text["e"]),
             (3, text["e"]), (7, text["f"]), (7, text["g"]), (7, text["g"]), (9, text["g"]), (None, text["h"])]
    want = [(1, "a"), (None, "b"), (None, "c"), (5, "d"), (3, "e"), (7, "f"), (7, "g"), (None, "h")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], SCHEMA)
    got = corpus_pipeline.near_dedup(spark, docs, str(SF))
    assert got.columns == docs.columns
    assert rows(got) == sorted([(i, text[c], "en", "s", len(text[c])) for i, c in want], key=repr)


def test_decontamination_stage(steps, spark):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    block = decontaminate.Block(bench, decontaminate.MASKS)
    want = [tuple(r) for r in steps[1][1].collect() if not block.find(r["text"], 10, 0.75)]
    assert rows(steps[2][1]) == sorted(want, key=repr) and len(want) < steps[1][1].count()


def test_mixing_stage(steps):
    docs = steps[2][1]
    want = []
    by = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    for r in docs.collect():
        m = by[r["doc_id"]]
        limit = int(m["target"])
        want += [tuple(r)] * (((m["start"] < limit) + (m["start"] + m["source_size"] < limit)) if m["size"] else 0)
    assert rows(steps[3][1]) == sorted(want, key=repr)
    taken = sum(r["taken"] for r in by.values())
    assert taken <= sum(len(w[1].split()) for w in want) < 1.2 * taken


def test_mixing_stage_follows_the_schedule(spark, monkeypatch):
    """Rows are taken where slots begin them: with null and repeated ids, and other slots give other rows."""
    given = [(None if i % 5 == 0 else i // 2, f"{i} " + "w " * (i % 37), None, "ab"[i % 2] if i % 7 else None, i) for i in range(300)]
    given += [(1, "same text here", "en", "a", j) for j in range(6)]
    docs = spark.createDataFrame(given, SCHEMA)
    known, schedule = {}, mixing.schedule

    def every_other(spark, wanted, block):
        known.update(block=block)
        return schedule(spark, wanted, block).where("rank % 2 = 0")

    def want(slot):
        out = []
        for r in mixing.mix(docs).collect():
            begun = [r["start"] + k * r["source_size"] for k in range(2) if r["size"]]
            out += [(r["doc_id"], r["source"], r["size"])] * sum(at < int(r["target"]) and slot(at) for at in begun)
        return sorted(out, key=repr)

    def got():
        return sorted([(r["doc_id"], r["source"], len(r["text"].split())) for r in corpus_pipeline.mix(spark, docs, str(SF)).collect()], key=repr)

    whole = got()
    assert whole == want(lambda at: True)
    monkeypatch.setattr(mixing, "schedule", every_other)
    half = got()
    assert half == want(lambda at: at // known["block"] % 2 == 0) and 0 < len(half) < len(whole)


def test_token_stage(steps):
    want = brute_files([tuple(r) for r in steps[3][1].collect()], 2)
    assert rows(steps[4][1]) == sorted(want, key=repr)


def test_run_reads_documents(spark):
    assert corpus_pipeline.run(spark, str(SF)).count() > 100


def test_registered():
    assert len([q for q in QUERIES if q.startswith("op")]) == 13 and set(ORACLES) <= set(QUERIES)
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER)
    assert language_id.SIZE == 300
