from datetime import date

from zoneflow.functions import text as tx
from zoneflow.operators import extract
from zoneflow.plans.rules import PATH_TERMS, ZONING
from zoneflow.session import checked_broadcast, is_small, kept, release
from zoneflow.sources import corpus, images


def write(root, rel, data):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_read_select_and_extract_from_files(spark, tmp_path):
    root = tmp_path / "policies"
    write(root, "alpha/01-02-20/zoning code.part.txt", "old building height of 20 feet\n")
    write(root, "alpha/11-02-20/zoning code.part.txt", "new building height of 30 feet\nR1\n")
    write(root, "beta/01-02-20/zoning code.part.txt", b"bad \xff byte building height of 40 feet")
    write(root, "beta/01-02-20/Title 9 parks.txt", "building height of 50 feet")
    write(root, "beta/01-02-20/deep/land+use 100%.txt", "none")
    write(root, "beta/01-02-20/image.png", "x")
    listed = [r.path for r in corpus.list_documents(spark, str(root)).collect()]
    assert listed == sorted(listed) and len(listed) == 5 and listed[0].startswith("policies/alpha/")
    docs = corpus.read_documents(spark, str(root))
    assert sorted(r.path for r in docs.collect()) == listed
    chosen = corpus.select_documents(docs, whitelist=PATH_TERMS, most_recent=True)
    got = {(r.city, r.scrape_date, r.title, r.section) for r in chosen.collect()}
    assert got == {("alpha", date(2020, 11, 2), "zoning code.part.txt", "zoning code"),
                   ("beta", date(2020, 1, 2), "zoning code.part.txt", "zoning code")}
    lines = corpus.lines(chosen.withColumnRenamed("path", "doc_id"))
    hits = extract.attributes(lines, ZONING).collect()
    assert {(h.city, h["values"], h.context) for h in hits} == {
        ("alpha", "30.0", "new building height of 30 feet"), ("beta", "40.0", "bad  byte building height of 40 feet")}
    assert {r.city for r in corpus.cities(docs).collect()} == {"alpha", "beta"}
    assert corpus.city_documents(docs, "Beta").count() == 3


def test_whitelist_is_by_word(spark):
    df = spark.createDataFrame([("r/oakland/d/parks.txt",), ("r/x/d/Land use.txt",), ("r/walnut creek/d/a.txt",)], "path string")
    kept = df.where(corpus.on_whitelist("path", ["land", "Walnut"])).collect()
    assert [r.path for r in kept] == ["r/x/d/Land use.txt", "r/walnut creek/d/a.txt"]


def test_lines_keep_blank_and_last_line(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n"), (2, ""), (3, None)], "doc_id int, text string")
    got = sorted((r.doc_id, r.line_no, r.line, r.n_lines) for r in corpus.lines(df).collect())
    assert got == [(1, 1, "a", 4), (1, 2, "", 4), (1, 3, "b", 4), (1, 4, "", 4), (2, 1, "", 1)]


def test_line_plan_has_no_shuffle_and_one_split(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id int, text string")
    plan = extract.attributes(
        corpus.lines(df.selectExpr("doc_id", "'c' city", "'s' section", "text")), ZONING
    )._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("split(translate(text") == 1


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "path string, text string")
    assert corpus.select_documents(df, PATH_TERMS, most_recent=True).count() == 0


def test_session_size_check(spark):
    df = spark.createDataFrame([("x" * 100, [1, 2])] * 5, "s string, a array<int>")
    assert is_small(df) and not is_small(df, max_rows=4) and not is_small(df, max_bytes=500)


def test_image_inventory(spark, tmp_path):
    for f in ("res/a.jpg", "res/b.jpg", "com/c.jpg", "com/n.txt", "com/.hidden.jpg"):
        write(tmp_path, f, "x")
    got = {(r.image_file, r.label, r.image_path.rsplit("/", 1)[-1]) for r in images.inventory(spark, str(tmp_path)).collect()}
    assert got == {("a.jpg", "res", "res"), ("b.jpg", "res", "res"), ("c.jpg", "com", "com")}


def test_folders_that_repeat_the_roots_name(spark, tmp_path):
    write(tmp_path, "policies/policies/01-02-20/zoning.txt", "a")
    write(tmp_path, "policies/town/01-02-20/policies/b c.txt", "b")
    root = str(tmp_path / "policies")
    want = {"policies/policies/01-02-20/zoning.txt", "policies/town/01-02-20/policies/b c.txt"}
    assert {r.path for r in corpus.list_documents(spark, root).collect()} == want
    assert {r.path for r in corpus.read_documents(spark, f"file://{root}/").collect()} == want
    assert {r.city for r in corpus.path_columns(corpus.read_documents(spark, root)).collect()} == {"policies", "town"}


def test_kept_frames_are_released(spark):
    small = checked_broadcast(spark.range(5).toDF("k"))
    assert small.count() == 5
    release()
    with kept(spark.range(3).toDF("k")) as df:
        assert df.is_cached
    assert not df.is_cached
