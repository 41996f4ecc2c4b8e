"""Reading, writing and typing of review records."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from revlens.functions.text import tokens
from revlens.operators.transform import with_lengths
from revlens.schema import REVIEW_SCHEMA, YEARLY_SCHEMA
from revlens.sources import csv, jsonl

EDGE_LINES = [
    '{"rating": 5.0, "title": "A", "text": "Quite loud", "images": [{"u": 1}], "asin": "B1", '
    '"user_id": "U1", "timestamp": 1400000000000, "helpful_vote": 0, "verified_purchase": true}',
    '{"rating": 4.5, "text": "x <br /><br />y. well-made", "images": [], "asin": "B2", '
    '"user_id": "U2", "timestamp": 0, "helpful_vote": "3", "verified_purchase": "Yes"}',
    "not json",
    '{"rating": null, "timestamp": null, "helpful_vote": "", "verified_purchase": ""}',
    "[1]",
    "",
    '{"rating": "4"}',
]


@pytest.fixture
def edge_file(tmp_path):
    path = tmp_path / "edge.jsonl"
    path.write_text("\n".join(EDGE_LINES) + "\n", encoding="utf-8")
    return str(path)


def test_lenient_keeps_only_objects(spark, edge_file):
    rows = {r.asin or f"{r.rating}": r for r in jsonl.read_lenient(spark, edge_file).collect()}
    assert set(rows) == {"B1", "B2", "None", "4"}
    first, second, empty, text_rating = rows["B1"], rows["B2"], rows["None"], rows["4"]
    assert (first.rating, first.timestamp, first.verified_purchase) == (5, date(2014, 5, 13), True)
    assert first.images == '[{"u":1}]'
    assert (second.rating, second.timestamp, second.helpful_vote) == (4, date(1970, 1, 1), 3)
    assert second.verified_purchase is True
    assert (empty.rating, empty.timestamp, empty.helpful_vote, empty.verified_purchase) == (None,) * 4
    assert empty.text == ""
    assert text_rating.rating == 4
    assert (text_rating.title, text_rating.user_id, text_rating.helpful_vote) == ("", "", None)


def test_lenient_can_be_counted_and_pruned(spark, edge_file):
    records = jsonl.read_lenient(spark, edge_file)
    assert records.count() == 4
    assert records.select("asin").filter("asin <> ''").count() == 2


@pytest.mark.parametrize(
    "line",
    ['{"a": 1', '{"a": 1,}', "{'a': 1}", '"a"', "3", "null", "   ", '[{"a": 1}]', '{"a": 1} trailing'],
)
def test_lenient_drops(spark, line):
    lines = spark.createDataFrame([(line,), ('{"a": 7}',)], "value string")
    assert [r.a for r in jsonl.parse_lenient(lines, ["a"]).collect()] == ["7"]


def test_lenient_does_not_depend_on_the_session_time_zone(spark, edge_file):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        dates = {r.timestamp for r in jsonl.read_lenient(spark, edge_file).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dates == {date(2014, 5, 13), date(1970, 1, 1), None}


def test_strict_reads_good_lines_and_fails_on_bad_ones(spark, tmp_path, edge_file):
    good = tmp_path / "good.jsonl"
    good.write_text(EDGE_LINES[0] + "\n", encoding="utf-8")
    row = jsonl.read_strict(spark, str(good)).first()
    assert (row.rating, row.helpful_vote, row.verified_purchase) == (5.0, 0, True)
    assert len(row.images) == 1
    for bad in ("not json", "[1]"):
        path = tmp_path / f"bad{len(bad)}.jsonl"
        path.write_text(f"{EDGE_LINES[0]}\n{bad}\n", encoding="utf-8")
        with pytest.raises(Exception):
            jsonl.read_strict(spark, str(path)).collect()


def test_pruned_scan_reads_only_the_needed_fields(spark, edge_file, capsys):
    jsonl.read_pruned(spark, edge_file).groupBy("rating").count().explain("formatted")
    assert "ReadSchema: struct<rating:double>" in capsys.readouterr().out


@pytest.mark.parametrize(
    ("raw", "kind", "expected"),
    [
        ("4", "int", 4),
        ("4.9", "int", 4),
        ("-4.9", "int", -4),
        ("9007199254740993", "int", 9007199254740993),
        ("1e3", "int", 1000),
        ("x", "int", None),
        ("", "int", None),
        (None, "int", None),
        ("99999999999999999999", "int", None),
        ("4.5", "float", 4.5),
        ("abc", "float", None),
        ("", "float", None),
        (None, "str", ""),
        ("x", "str", "x"),
        ("T", "bool", True),
        ("YES", "bool", True),
        ("1", "bool", True),
        ("no", "bool", False),
        ("", "bool", None),
        (None, "bool", None),
        ("0", "date", date(1970, 1, 1)),
        ("-1", "date", date(1969, 12, 31)),
        ("1400000000000", "date", date(2014, 5, 13)),
        ("", "date", None),
    ],
)
def test_casts(spark, raw, kind, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert jsonl.typed(df, {"v": kind}).first().v == expected


def test_unknown_cast_is_refused(spark):
    with pytest.raises(ValueError):
        jsonl.typed(spark.createDataFrame([("1",)], "v string"), {"v": "decimal"})


def test_defaults_and_image_count(spark):
    rows = [
        (None, None, None, None, None, None, None, None, None, None),
        (5.0, "t", "x", ["{}", "{}"], "a", "p", "u", 1, 2, True),
    ]
    got = jsonl.with_defaults(jsonl.from_rows(spark, rows)).orderBy("rating").collect()
    assert got[0].asDict() == {
        "asin": "", "parent_asin": "", "title": "", "text": "", "rating": 0.0, "timestamp": 0,
        "user_id": "", "verified_purchase": False, "helpful_vote": 0, "image_count": 0,
    }
    assert (got[1].image_count, got[1].text, got[1].verified_purchase) == (2, "x", True)


def test_lengths_count_characters(spark):
    df = spark.createDataFrame([("é😀é", None), ("", "ab")], "text string, title string")
    got = [(r.text_length, r.title_length) for r in with_lengths(df).collect()]
    assert sorted(got) == [(0, 2), (4, 0)]


def test_tokens_keep_empties_and_residue(spark):
    df = spark.createDataFrame([("x <br /><br />y. well-made",), ("a\nb  c",)], "text string")
    got = [r[0] for r in df.select(tokens(F.col("text"))).collect()]
    assert got == [["x", "<br", "", ">y", "wellmade"], ["a\nb", "", "c"]]


def test_yearly_csv_round_trip(spark, tmp_path):
    rows = [(2001, 4.5, 2), (1999, 3.25, 7), (2000, 1.0, 1)]
    table = spark.createDataFrame(rows, YEARLY_SCHEMA)
    path = str(tmp_path / "trend")
    for _ in range(2):
        csv.write_csv(table, path, ["year"], one_file=True)
    parts = [p for p in (tmp_path / "trend").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == [
        "year,avg_rating,num_ratings", "1999,3.25,7", "2000,1.0,1", "2001,4.5,2",
    ]
    assert [tuple(r) for r in csv.read_csv(spark, path).collect()] == sorted(rows)


def test_csv_refuses_an_existing_path(spark, tmp_path):
    table = spark.range(3)
    csv.write_csv(table, str(tmp_path / "t"), ["id"], mode="errorifexists")
    with pytest.raises(Exception):
        csv.write_csv(table, str(tmp_path / "t"), ["id"], mode="errorifexists")


def test_stamped_path():
    when = datetime(2031, 4, 5, 6, 7, 8, tzinfo=timezone.utc)
    assert csv.stamped_path("scheme://bucket/out/", "trend", when) == "scheme://bucket/out/trend_20310405_060708"


def test_jsonl_round_trip(spark, tmp_path):
    rows = [(5.0, "t", "x\ny", [], "a", "p", "u", 1, 2, True), (1.0, None, "", [], "b", "p", "v", 2, 0, False)]
    records = jsonl.from_rows(spark, rows)
    jsonl.write_jsonl(records, str(tmp_path / "out"))
    back = jsonl.read_strict(spark, str(tmp_path / "out"), REVIEW_SCHEMA)
    assert sorted(back.collect(), key=lambda r: r.asin) == sorted(records.collect(), key=lambda r: r.asin)


def test_head_lines_follow_the_file(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {i}\n" for i in range(50_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 8
        head = jsonl.head_lines(spark, str(path), 5000)
        assert [r.value for r in head.collect()] == [f"line {i}" for i in range(5000)]
        placed = jsonl.read_lines(spark, str(path))
        ordered = placed.orderBy("file", "block", "row").collect()
        assert [r.value for r in ordered] == [f"line {i}" for i in range(50_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_head_lines_of_many_files_and_splits(spark, tmp_path, capsys):
    expected = []
    for name in ("a b", "b", "é", "z"):
        lines = [f"{name} {i}" for i in range(9000 if name == "b" else 700)]
        (tmp_path / f"{name}.txt").write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
        expected += lines if name != "é" else []
    (tmp_path / "é.txt").unlink()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        for n in (0, 1, 699, 700, 701, 5000, 9700, 9701, 10_400, 99_999):
            assert [r.value for r in jsonl.head_lines(spark, str(tmp_path), n).collect()] == expected[:n]
        head = jsonl.head_lines(spark, str(tmp_path), 500)
        head.explain()
        assert "Coalesce" not in capsys.readouterr().out
        # The first file is enough, and the others are not opened.
        (tmp_path / "b.txt").chmod(0)
        (tmp_path / "z.txt").write_bytes(b"changed")
        assert head.count() == 500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_written_unchanged(spark, tmp_path, edge_file):
    jsonl.write_lines(jsonl.head_lines(spark, edge_file, 3), str(tmp_path / "head"))
    got = [r.value for r in spark.read.text(str(tmp_path / "head")).collect()]
    assert got == EDGE_LINES[:3]


HARD_LINES = [
    ('{"a": 1}\t', True),
    ('{"a": 1}\r', True),
    ('  {"a": 1}', True),
    ('{"a": 1} junk}', False),
    ('{"a": 1}{"a": 2}', False),
    ('{"a": 1}, {"a": 2}', False),
    ('{"a": 1}]', False),
    ("{'a': 1}", False),
    ("[1]", False),
    ("null", False),
    ("  ", False),
    ('{"a": 1', False),
]


def test_lenient_keeps_whole_objects_only(spark):
    lines = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(HARD_LINES)], "i int, value string")
    kept = [r.i for r in jsonl.parse_lenient(lines, ["a"]).orderBy("i").collect()]
    assert kept == [i for i, (_, good) in enumerate(HARD_LINES) if good]


def test_strict_refuses_junk_and_skips_blank_lines(spark):
    schema = "a int"
    from pyspark.sql.types import _parse_datatype_string

    def parsed(*lines):
        frame = spark.createDataFrame([(line,) for line in lines], "value string")
        return sorted(r.a for r in jsonl.parse_strict(frame, _parse_datatype_string(schema)).collect())

    assert parsed('{"a": 1}', "", "  ", '[{"a": 2}, {"a": 3}]\r') == [1, 2, 3]
    for bad in ('{"a": 1} trailing', '{"a": 1},{"a": 2}', "null", '{"a": 1}]', "7"):
        with pytest.raises(Exception):
            parsed(bad)


def test_absurd_times_and_ratings_do_not_end_the_job(spark):
    from revlens.operators.transform import with_star

    raw = spark.createDataFrame([("999999999999999999",), ("-999999999999999999",)], "timestamp string")
    assert [r[0] for r in jsonl.typed(raw, {"timestamp": "date"}).collect()] == [None, None]
    rated = spark.createDataFrame([(1e12,), (float("nan"),), (float("inf"),), (-3.0,), (5.9,), (None,)], "rating double")
    assert [r.star for r in with_star(rated).collect()] == [5]
