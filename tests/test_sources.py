import pytest
from pyspark.sql import functions as F

from topicloom.operators.summary import sort_summary
from topicloom.schemas import CATEGORIZED, DOCS, MODEL_INPUT
from topicloom.sources import tables
from topicloom.sources.layout import SessionLayout
from topicloom.sources.markdown_files import file_key, file_listing, scan_markdown, with_file_key

TREE = {
    "top.md": "# Top", "a/b/c.md": "# Deep", "a-b/c.md": "# Clash", "a/with space+plus%.md": "# Odd",
    "a/skip.txt": "x", "a/UPPER.MD": "x", ".git/x.md": "x", "_dir/y.md": "# Under", "a/_z.md": "# Hidden",
    "a/.dot.md": "# Dot", "a/.h/n.md": "x", "empty.md": "",
}


@pytest.fixture
def tree(tmp_path):
    for name, text in TREE.items():
        path = tmp_path / "root" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(tmp_path / "root")


@pytest.mark.parametrize("end", ["", "/"])
def test_scan(spark, tree, end):
    files = with_file_key(scan_markdown(spark, tree + end, skip_hidden_names=True), tree + end)
    got = sorted((r.File, r.content) for r in files.filter("content <> ''").collect())
    assert got == sorted([
        ("top.md", "# Top"), ("a-b-c.md", "# Deep"), ("a-b-c.md", "# Clash"), ("a-with space+plus%.md", "# Odd"),
    ])
    listing = file_listing(scan_markdown(spark, tree + end, skip_hidden_names=True), tree + end).orderBy("level", "file", "fileName")
    levels = {(r.level, r.fileName) for r in listing.collect()} - {(1, "empty.md")}
    assert levels == {(1, "top.md"), (3, "a-b-c.md"), (2, "a-b-c.md"), (2, "a-with space+plus%.md")}


@pytest.mark.parametrize("end", ["", "/"])
def test_scan_keeps_hidden_names(spark, tree, end):
    files = with_file_key(scan_markdown(spark, tree + end), tree + end)
    assert {r.File for r in files.collect()} == {
        "top.md", "a-b-c.md", "a-with space+plus%.md", "_dir-y.md", "a-_z.md", "a-.dot.md", "empty.md",
    }


def test_file_key(value):
    assert value(file_key, "a/b/c.md") == "a-b-c.md"
    assert value(file_key, "a\\b.md") == "a-b.md"


def test_missing_root_raises(spark, tmp_path):
    with pytest.raises(Exception):
        scan_markdown(spark, str(tmp_path / "none")).count()


def test_layout():
    assert SessionLayout("/x/", 7).docs == "/x/session7/docs"
    assert SessionLayout("/x", 7, "/own").summary == "/own/summary"
    with pytest.raises(ValueError):
        SessionLayout("/x", "seven")


DOC_ROWS = [
    ("f1.md", "Ends with \\", "a,b", None, "", "x", "y", "some words"),
    ("f2.md", 'Has "quotes"', None, None, None, None, None, None),
    ("f3.md", 'Ends "so"', '"', 'a "b" c \\ "', ",", "\\", '""', "w"),
]
BROKEN = ("f4.md", "Title with\nbreak", "a\r\nb", "\rc", None, None, None, "w")


def test_line_breaks_stay_inside_their_row(spark, tmp_path):
    tables.write_docs(spark.createDataFrame([*DOC_ROWS, BROKEN], DOCS), str(tmp_path / "d"), "csv")
    rows = {r.File: r for r in tables.read_docs(spark, str(tmp_path / "d"), "csv").collect()}
    assert set(rows) == {"f1.md", "f2.md", "f3.md", "f4.md"}
    assert tuple(rows["f4.md"])[1:4] == ("Title with break", "a b", " c")


def test_torn_lines_fail(spark, tmp_path):
    (tmp_path / "d.csv").write_text(",".join(f'"{n}"' for n in DOCS.names) + '\r\n"f","cut short"\r\n')
    with pytest.raises(Exception):
        tables.read_docs(spark, str(tmp_path / "d.csv"), "csv").collect()


def test_quotes_are_untouched_in_parquet(spark, tmp_path):
    row = ("f", '"already quoted"', '"Foo" bar', *[None] * 4, 3, "< 1 minute", "top", 2)
    df = spark.createDataFrame([row], CATEGORIZED)
    for fmt, want in (("parquet", ('"already quoted"', '"Foo" bar')), ("csv", ("already quoted", '"Foo" bar'))):
        tables.write_categorized(df, str(tmp_path / fmt), fmt)
        back = tables.read_categorized(spark, str(tmp_path / fmt), fmt).first()
        assert (back.Title, back.Subtitle1) == want


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_docs_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame(DOC_ROWS, DOCS)
    tables.write_docs(df, str(tmp_path / "d"), fmt)
    back = [tuple(r) for r in tables.read_docs(spark, str(tmp_path / "d"), fmt).orderBy("File").collect()]
    empty = None if fmt == "csv" else ""
    assert back == [tuple(empty if v == "" else v for v in row) for row in DOC_ROWS]


def test_csv_form(spark, tmp_path):
    tables.write_docs(spark.createDataFrame(DOC_ROWS[:1], DOCS).coalesce(1), str(tmp_path / "d"), "csv")
    text = next((tmp_path / "d").glob("*.csv")).read_bytes()
    assert text.startswith(b'"File","Title","Subtitle1"') and text.count(b"\r\n") == 2


def test_training_rows_ignore_further_columns(spark, tmp_path):
    header = ",".join(f'"{n}"' for n in [*MODEL_INPUT.names, "Words"])
    (tmp_path / "m.csv").write_text(header + '\r\n"f","t","","","","","","top words",12,"< 1 minute",""\r\n')
    row = tables.read_model_input(spark, str(tmp_path / "m.csv"), "csv").first()
    assert (row.File, row.Title, row.Top20Words, row.WordCount, row.ReadingTime) == (
        "f", "t", "top words", 12, "< 1 minute")


def test_categorized_keeps_quoted_values(spark, tmp_path):
    df = spark.createDataFrame(
        [("f", '"already quoted"', *[None] * 5, 3, "< 1 minute", "top", 2)], CATEGORIZED)
    tables.write_categorized(df, str(tmp_path / "c"), "csv")
    row = tables.read_categorized(spark, str(tmp_path / "c"), "csv").first()
    assert (row.Title, row.WordCount, row.PredictedLabel) == ("already quoted", 3, 2)


def test_summary_files_are_in_order(spark, tmp_path):
    lines = spark.range(2000).select(
        (F.col("id") % 5).cast("int").alias("category"), F.lit(1).alias("ord"),
        F.format_string("\t%05d", F.col("id")).alias("line"), F.lit("f").alias("File"),
    ).repartition(7)
    want = [r.line for r in sort_summary(lines).collect()]
    tables.write_summary(lines, str(tmp_path / "s"))
    parts = sorted((tmp_path / "s").glob("part-*"))
    assert [x for p in parts for x in p.read_text().splitlines()] == want


def test_sessions_share_tables(spark, tmp_path):
    base = str(tmp_path / "shared")
    first, second = (SessionLayout(base, tag, partitioned=True) for tag in (1, 2))
    assert first.docs == f"{base}/docs/session=1" and first.table("docs") == second.table("docs")
    one = spark.createDataFrame([(f"f{i}", *["x"] * (len(DOCS) - 1)) for i in range(3)], DOCS)
    tables.write_docs(one, first.docs)
    tables.write_docs(one.limit(2), second.docs)
    read = lambda *tags: tables.read_sessions(spark, first.table("docs"), DOCS, tags or None)
    counts = lambda: {r.session: r["count"] for r in read().groupBy("session").count().collect()}
    assert counts() == {1: 3, 2: 2}
    tables.write_docs(one.limit(1), first.docs)
    assert counts() == {1: 1, 2: 2}
    # A session without rows is empty, not its earlier run.
    tables.write_docs(one.limit(0), first.docs)
    assert counts() == {2: 2} and tables.read_docs(spark, first.docs).count() == 0
    # Several at once: those with rows are replaced.
    tables.write_sessions(one.withColumn("session", F.when(F.col("File") == "f0", 2).otherwise(5)), first.table("docs"), DOCS)
    assert counts() == {2: 1, 5: 2}
    assert sorted(r.File for r in read(5, 7).collect()) == ["f1", "f2"]
    assert read(7).count() == 0


def test_sessions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame([(f"f{i}", *["x"] * (len(DOCS) - 1), i % 4) for i in range(40)], [*DOCS.names, "session"])
    tables.write_sessions(rows, path, DOCS)
    read = tables.read_sessions(spark, path, DOCS, [2])
    assert {f.rsplit("/", 2)[1] for f in read.inputFiles()} == {f"session={i}" for i in range(4)}
    plan = read.select("File")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session" in plan or "PartitionFilters: [(session" in plan
    assert read.count() == 10
