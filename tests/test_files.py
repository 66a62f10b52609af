"""Delimited files against Python's csv reader, and layout detection."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from rowtide.catalog.spec import FieldSpec, TableSpec
from rowtide.functions import text
from rowtide.plans.importer import Importer
from rowtide.sources import files

SPEC = TableSpec.parse("t", "", "a int32, b varchar, c date")
LINES = '1|"a|b"|2026-01-01|\n2|x\n3|y|bad|z|extra\n4||\n5|"p\nq"|w\n6|a""b|c\n\n7|"say ""hi|"""|2026-01-02\n'


def load(spark, folder, spec=SPEC, name="t"):
    return files.load_table(spark, str(folder), name, spec)


def test_rows_like_the_csv_reader(spark, tmp_path):
    (tmp_path / "t.tbl").write_text(LINES)
    got = sorted((r["a"], r["b"], str(r["c"])) for r in load(spark, tmp_path).collect())
    assert got == [(1, "a|b", "2026-01-01"), (3, "y", "None"), (4, None, "None"), (5, "p\nq", "None"),
                   (6, 'a""b', "None"), (7, 'say "hi|"', "2026-01-02")]


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("delimiter", ["|", ","])
def test_cells_match_python(spark, tmp_path, whole, delimiter):
    lines = ['1|"x|y"|z', "2|plain|", '3|"q""q"|r|s', "4|short", '5|mid"quote|e', '6|""|f|', '7|"a"|"b"|"c|d"', "||"]
    body = "\n".join(line.replace("|", delimiter) for line in lines) + "\n"
    path = tmp_path / "x.tbl"
    path.write_text(body)
    want = sorted(tuple(r[:3]) for r in csv.reader(io.StringIO(body), delimiter=delimiter) if len(r) >= 3)
    cells = files.read_delimited(spark, [(str(path), len(body))], 3, delimiter, whole)
    got = sorted(tuple("" if v is None else v for v in r) for r in cells.collect())
    assert got == want


def test_open_quotes_are_found(spark, tmp_path):
    cases = {
        'a|"b|c"|d\n1|2|3\n': False,
        'a|"b\nc"|d\n': True,
        'a"|"b\nc"|d\n': True,
        'a"b|c\n': False,
        'a|"x""y"|""|"""z"""\n': False,
        'a|"x""\ny"|d\n': True,
    }
    for i, (body, spans) in enumerate(cases.items()):
        path = tmp_path / f"{i}.txt"
        path.write_text(body)
        assert files.open_quote_files(spark, [str(path)], "|") == [str(path)] * spans, body


def test_large_files_are_split_unless_a_field_spans_lines(spark, tmp_path):
    (tmp_path / "big.tbl").write_text("1|x|2026-01-01\n" * 500_000)
    listed = files.table_files(spark, str(tmp_path), "big", files.Layout("tbl", False))
    cells = files.read_delimited(spark, listed, 3, "|")
    assert cells.rdd.getNumPartitions() > 1 and cells.count() == 500_000


def test_only_files_with_a_quoted_line_break_are_read_whole(spark, tmp_path):
    folder = tmp_path / "a table"
    folder.mkdir()
    for i in range(3):
        (folder / f"plain {i}.csv").write_text(f'{i},"x, y"\n' * 200_000)
    (folder / "broken.csv").write_text('7,"x\ny"\n8,z\n')
    listed = files.table_files(spark, str(tmp_path), "a table", files.Layout("csv", True))
    cells = files.read_delimited(spark, listed, 2, ",")
    assert cells.count() == 600_002 and cells.where("c0 IN ('7', '8')").count() == 2
    assert cells.where("c1 = 'x\ny'").count() == 1
    one_task_each = files.read_delimited(spark, listed, 2, ",", whole_files=True)
    assert one_task_each.exceptAll(cells).isEmpty() and one_task_each.count() == 600_002


def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    """Records with line breaks, some longer than a split, equal those of the csv module, in order."""
    rng = random.Random(4)
    rows = []
    for i in range(6000):
        cell = "".join(rng.choice(['a', 'b ', '""'[:1], ',', '\n', '\r\n', "'"]) for _ in range(rng.randint(0, 12)))
        rows.append([str(i), cell, rng.choice(["", "plain", 'in"side'])])
    rows[3000][1] = "long\n" * 30_000 + '"end"'
    folder = tmp_path / "t"
    folder.mkdir()
    for part in range(2):
        with open(folder / f"t_{part}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\r\n" if part else "\n").writerows(rows[part::2])
    listed = files.table_files(spark, str(tmp_path), "t", files.Layout("csv", True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = files.read_records(spark, [p for p, _ in listed], ",")
        assert records.rdd.getNumPartitions() > 10
        cells = files.read_delimited(spark, listed, 3, ",", positions=True)
        got = cells.orderBy("_at").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [[r["c0"], r["c1"] or "", r["c2"] or ""] for r in got] == rows[0::2] + rows[1::2]


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("a,b", False, True), ('"a', True, False), ('"a"', False, True), ('x"y', False, False), ('"a,""', True, False),
        ('""', False, True), ('"', True, False), ('",b', True, False), ('a,"b', True, False), ('""",c', True, False),
        ('"""', True, False), ('b"', False, False), ('"x","', True, True), ("", False, True),
    ],
)
def test_line_automaton(spark, line, outside, inside, tmp_path):
    (tmp_path / "l.csv").write_text(line + "\n")
    got = files._lines(spark, [str(tmp_path / "l.csv")], ",").first()

    def naive(state):
        at_start = not state
        i = 0
        while i < len(line):
            if state:
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        state = False
                at_start = False
            elif line[i] == '"' and at_start:
                state, at_start = True, False
            else:
                at_start = line[i] == ","
            i += 1
        return state

    assert (got["from_outside"], got["from_inside"]) == (naive(False), naive(True))


@pytest.mark.parametrize(
    "tree, extension, partitioned",
    [
        (["t.csv", "t.TBL"], "tbl", False),
        (["t.csv", "u/u.tbl"], "csv", False),
        (["t/t_1.csv", "t/t.tbl"], "tbl", True),
        (["t/t_1.csv", "u/u.tbl"], "csv", True),
    ],
)
def test_detect_layout(spark, tmp_path, tree, extension, partitioned):
    for name in tree:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("1\n")
    assert files.detect_layout(spark, str(tmp_path)) == files.Layout(extension, partitioned)


def test_detect_layout_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.detect_layout(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="empty"):
        files.detect_layout(spark, str(tmp_path))
    (tmp_path / "x.txt").write_text("1")
    with pytest.raises(ValueError, match="directory"):
        files.detect_layout(spark, str(tmp_path / "x.txt"))
    with pytest.raises(ValueError, match="no .tbl or .csv"):
        files.detect_layout(spark, str(tmp_path))


CELLS = [
    ("int32", "12.5", None), ("int32", " 12 ", 12), ("int32", "+5", 5), ("int32", "1_000", 1000), ("int32", "1__0", None),
    ("int32", "99999999999", None), ("int32", "", None), ("uint8", "255", 255), ("uint8", "-1", None),
    ("uint64", "18446744073709551615", 18446744073709551615),
    ("float64", "nan", "nan"), ("float64", "inf", float("inf")), ("float64", "-Infinity", float("-inf")),
    ("float64", "1.5d", None), ("float64", "0x1p3", None), ("float64", "1_0.5", 10.5), ("float64", "1e3", 1000.0),
    ("boolean", "2", True), ("boolean", "0", False), ("boolean", "true", None), ("boolean", "-1", True),
    ("date", "2026-01-19", "2026-01-19"), ("date", "2026-01-19 07:30:00", "2026-01-19"), ("date", "2026-1-9", "2026-01-09"),
    ("date", "2026-01-19T07:30:00", None), ("date", "2026", None), ("date", "2026-02-30", None), ("date", "0000-01-01", None),
    ("timestamp", "2026-01-19 07:30:00.123", "2026-01-19 07:30:00.123000"), ("timestamp", "2026-01-19", "2026-01-19 00:00:00"),
    ("timestamp", "2026-01-19 7:3:5.1", "2026-01-19 07:03:05.100000"), ("timestamp", "2026-01-19  07:30:00", "2026-01-19 07:30:00"),
    ("timestamp", "2026-01-19 07:30:00.1234567", None), ("timestamp", "2026-01-19 07:30:00Z", None),
    ("timestamp", "2026-01-19 24:00:00", None),
    ("varchar", "  keep me ", "keep me"), ("varchar", " \t　", None), ("bytes", "4865", "4865"),
    ("time", "07:30:00.5", 27_000_500_000), ("time", "25:00", None),
    ("decimal", "12.34", "12.3400000000"), ("decimal", "0.12345678901", None), ("decimal", "abc", None),
]


def test_text_cells(spark):
    rows = spark.createDataFrame([(c,) for _, c, _ in CELLS], "c string")
    listed = spark.createDataFrame([([c for _, c, _ in CELLS],)], "c array<string>")
    cols = []
    for i, (type_, _, _) in enumerate(CELLS):
        field = FieldSpec("x", type_, precision=6, timezone="-")
        cols.append(text.value(field, text.trimmed(F.get("c", F.lit(i)))).alias(f"f{i}"))
    got = listed.select(*cols).first()
    assert rows.count() == len(CELLS)
    for i, (type_, cell, want) in enumerate(CELLS):
        have = got[i]
        if want == "nan":
            assert have != have
        else:
            plain = isinstance(want, (int, float, type(None)))
            assert (have if plain else str(have)) == want, (type_, cell, have)


def test_zoned_text_timestamp_is_utc_and_floored(spark):
    field = FieldSpec("x", "timestamp", precision=3)
    row = spark.range(1).select(F.unix_micros(text.value(field, F.lit("1969-12-31 23:59:59.999999"))))
    assert row.first()[0] == -1000


def test_importer(spark, tmp_path):
    source, root = tmp_path / "src", str(tmp_path / "db")
    for name, n in (("Orders", 3), ("items", 2), ("unlisted", 1)):
        (source / name).mkdir(parents=True)
        for part in range(2):
            body = "".join(f"{part}{i},v{i}\n" for i in range(n))
            (source / name / f"{name}_part_{part}.csv").write_text(body)
    specs = {n: TableSpec.parse(n, "k", "k int32!, v varchar(4)") for n in ("orders", "items")}
    importer = Importer(spark, str(source), specs, root)
    assert importer.import_all() == {"Orders": 6, "items": 4}
    assert importer.import_all("upsert") == {"Orders": 6, "items": 4}
    assert importer.table("orders").read().count() == 6
    assert importer.import_table("orders") == 6
    assert importer.table("orders").read().count() == 12
    assert importer.import_table("nothing") == 0
    assert {tuple(r) for r in importer.summary({"a": 1}).collect()} == {("a", 1)}


def test_import_reads_the_files_again_only_for_refused_rows(spark, tmp_path, monkeypatch):
    from rowtide.catalog.spec import TableSpec
    from rowtide.plans import importer as module

    spec = TableSpec.parse("t", "id", "id int64!, v varchar(5)")
    scans = spark.sparkContext.accumulator(0)
    real = module.load_table

    def counted(*args, **how):
        @F.udf("long")
        def passed(key):
            scans.add(1)
            return key

        return real(*args, **how).withColumn("id", passed("id"))

    monkeypatch.setattr(module, "load_table", counted)
    for name, lines, imported, refused in (("good", "1,a\n2,b\n", 2, []), ("bad", "1,a\nx,b\n", 1, ["b"])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "t.csv").write_text(lines)
        before = scans.value
        made = module.Importer(spark, str(tmp_path / name), {"t": spec}, str(tmp_path / f"{name}-tables"), buckets=2)
        assert made.import_table("t") == imported and made.table("t").count() == imported
        read = scans.value - before
        rejects = spark.read.parquet(f"{made.table('t').path}/rejects")
        assert [r["v"] for r in rejects.collect()] == refused
        assert read == 2 if not refused else read > 2
