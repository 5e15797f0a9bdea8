"""Golden dump lines."""

import pytest
from pyspark.sql import functions as F

from stackroom.functions import json
from stackroom.operators import classify, parse

LONG = '{"key":"/works/OL1W","title":"A long enough title to pass sixty-four characters"}'
J1 = f"/type/work\t/works/OL1W\t3\t2020-01-02T03:04:05.6\t{LONG}"


def lines(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "source_offset bigint, line string")


def parsed_rows(df, *columns):
    return [tuple(r) for r in df.orderBy("source_offset").select(*columns).collect()]


def test_json_records(spark):
    short = '{"key":"/works/OL2W"}'
    cases = [
        (J1, ("/works/OL1W", 3, "2020-01-02T03:04:05.6", LONG, None)),
        (f"/type/work\t/works/OL2W\t1\t2020-01-02\t{short}", ("/works/OL2W", 1, short, short, None)),
        ("a\tb\tc", (None, None, "c", None, "no_json")),
        ('a\t{"key":', (None, None, '{"key":', '{"key":', "bad_json")),
        ("x\t7\t[1,2] tail", (None, 7, "[1,2] tail", "[1,2]", None)),
        ('{"key":5}', (None, None, '{"key":5}', '{"key":5}', None)),
        ("", (None, None, None, None, "empty_line")),
        ('{"key":""}\r', (None, None, '{"key":""}', '{"key":""}', None)),
        ('{"a":NaN}', (None, None, '{"a":NaN}', '{"a":NaN}', "bad_json")),
    ]
    df = parse.json_records(lines(spark, [line for line, _ in cases]))
    got = parsed_rows(df, "ol_key", "revision", "last_modified", "data_json", "reject_reason")
    assert got == [e for _, e in cases]


def test_json_records_limits_and_escapes(spark):
    key = "k" * 300
    values = [
        '{"key":"%s"}' % key,
        r'{"title":"a \"b\" \\ \n c"}',
        '{"a":1,"a":2}',
        '{"a":"raw\ttab"}',
    ]
    df = parse.json_records(lines(spark, values))
    rows = df.orderBy("source_offset").select(
        "ol_key", json.compact(F.col("data")), json.text_at(F.col("data"), "title")
    ).collect()
    assert rows[0][0] == key
    assert rows[1][2] == 'a "b" \\ \n c'
    assert rows[2][1] == '{"a":2}'
    assert rows[3][1] is None


def test_value_text(spark):
    cases = {
        '{"b": "}x", "a":1}': '{"b": "}x", "a":1}',
        '{"b": [1] }\tmore': '{"b": [1] }',
        '{"b":"}x"} {"c":1}': '{"b":"}x"}',
        '{"b":1,"a":2} tail }': '{"a":2,"b":1}',
        "[3, 2 ] ]x": "[3,2]",
        "[1,2] tail": "[1,2]",
        "{bad": "{bad",
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    got = rows.select("t", json.value_text(F.col("t"), json.parse(F.col("t")))).collect()
    assert {r[0]: r[1] for r in got if r[0] != '{"b":"}x"} {"c":1}'} == {k: v for k, v in cases.items() if k != '{"b":"}x"} {"c":1}'}
    assert [r[1] for r in got if r[0] == '{"b":"}x"} {"c":1}'] == ['{"b":"}x"}']


def test_long_keys_stay_apart(spark):
    from stackroom.functions.records import cut_to_limits, split_sources
    from stackroom.operators.dedup import keep_first

    keys = ["k" * 255 + "a", "k" * 255 + "b"]
    df = parse.json_records(lines(spark, ['{"key":"%s"}' % k for k in keys]))
    kept = keep_first(parse.accepted(df), ["ol_key"], ["source_offset"])
    assert sorted(r.ol_key for r in kept.collect()) == keys
    assert {r.ol_key for r in cut_to_limits(kept).collect()} == {"k" * 255}
    text = spark.createDataFrame([([f"{'s' * 64}1:{'x' * 300}", f"{'s' * 64}2:y"],)], "t array<string>")
    pairs = text.select(split_sources(F.col("t"))).first()[0]
    assert [(len(p.source), len(p.source_key)) for p in pairs] == [(65, 300), (65, 1)]


def test_covers(spark):
    df = parse.covers(lines(spark, [
        "12\t300\t400\t2011-05-06", "12\t300\t400", "", "13\t\tx\t", "1\t2\t3\t4\t5",
    ]))
    got = parsed_rows(df, "cover_id", "width", "height", F.col("created").cast("string"), "reject_reason")
    assert got[0] == (12, 300, 400, "2011-05-06", None)
    assert got[3] == (13, None, None, None, None)
    assert [r[-1] for r in got] == [None, "field_count", "empty_line", None, "field_count"]


def test_generic_tsv(spark):
    df = parse.generic_tsv(lines(spark, [
        'a\t"b ""q"" x"\tc', "1\t2", "1\t2\t3\t4", "", "a\t\t\\N", "N\tb\tc", '"x\ty"\t"p"z\t"\\N"',
        "a\tb\tc\r", "a\rb\tc\td",
    ]), 3)
    assert parsed_rows(df, "c1", "c2", "c3", "reject_reason") == [
        ("a", 'b "q" x', "c", None),
        ("1", "2", None, "field_count"),
        ("1", "2", "3", "field_count"),
        (None, None, None, "empty_line"),
        ("a", "", None, None),
        ("N", "b", "c", None),
        ("x y", "pz", None, None),
        ("a", "b", "c", None),
        (None, None, None, "field_count"),
    ]


def test_wikidata(spark):
    df = parse.wikidata(lines(spark, [
        'Q1\t"{""id"":""Q9"",""n"":1}"', 'Q1\t{"n":1}', "Q1", "Q1\t", "Q1\ttext", "Q1\t{bad",
        " Q2 \t [1] tail", '\t{"id":5}',
    ]))
    assert parsed_rows(df, "wd_id", "reject_reason") == [
        ("Q9", None), ("Q1", None), ("Q1", "field_count"), ("Q1", "blank_json"),
        ("Q1", "no_json"), ("Q1", "bad_json"), ("Q2", None), (None, None),
    ]


def test_wikidata_lenient(spark):
    df = parse.wikidata(lines(spark, [
        'Q1\t"{""n"":1}"', 'Q1\tjunk {"n":1}', 'junk {"n":1}', "no json", 'Q1\t"{""id"":""Q7""}" ',
    ]), lenient=True)
    assert parsed_rows(df, "wd_id", json.compact(F.col("data")), "reject_reason") == [
        ("Q1", '{"n":1}', None), ("Q1", '{"n":1}', None), (None, '{"n":1}', None),
        (None, None, "blank_json"), ("Q7", '{"id":"Q7"}', None),
    ]


def test_metrics(spark):
    df = parse.json_records(lines(spark, [J1, "a", "", '{"a"']))
    row = parse.ingest_metrics(df).first()
    assert tuple(row) == (4, 1, 3, 1)


def test_accepted_parses_json_once(spark):
    df = parse.accepted(parse.json_records(lines(spark, [J1])))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The other one is for lines on which more than a value seems to stand.
    assert plan.count("parseJson") + plan.count("parse_json") == 2


@pytest.mark.parametrize("counts, kind", [
    ({"/type/work": 3, "/type/edition": 3, "/type/author": 1}, "work"),
    ({"/type/edition": 2, "/type/author": 2, "/type/list": 9}, "edition"),
    ({"/type/author": 1}, "author"),
    ({"/type/list": 5}, None),
])
def test_classify(spark, counts, kind):
    rows = spark.createDataFrame([("d", k, n) for k, n in counts.items()], "dataset string, type_key string, records bigint")
    assert [r.kind for r in classify.classify(rows, "dataset").collect()] == [kind]


def test_type_histogram_ignores_odd_types(spark):
    values = ['{"type":{"key":"/type/work"}}', '{"type":"/type/work"}', '{"type":{"key":5}}', "{}", "[1]"]
    data = lines(spark, values).select(json.parse(F.col("line")).alias("data"))
    assert [tuple(r) for r in classify.type_histogram(data).collect()] == [("/type/work", 1)]


def test_high_water_mark_of_nothing(spark):
    assert classify.high_water_mark(spark.createDataFrame([], "id bigint"), "id").first()[0] == 0


def test_source_links_meet_their_records_by_hash(spark, sf_dir):
    from stackroom.queries import QUERIES

    found = QUERIES["work_source_links"](spark, sf_dir)
    assert found.count() == found.distinct().count() > 0
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "from_json" not in plan
