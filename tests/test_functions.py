"""Golden values of the scalar rules."""

import csv
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from stackroom.fixed_values import CYRILLIC_TO_LATIN
from stackroom.functions import dates, json, records, text, tsv


def evaluate(spark, values, expression, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    result = rows.select("i", expression(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(result, key=lambda r: r.i)]


def check(spark, cases, expression):
    got = evaluate(spark, [c for c, _ in cases], expression)
    assert got == [e for _, e in cases]


def on_json(expression):
    return lambda v: expression(json.parse(v))


def test_numeric_key(spark):
    check(spark, [
        ("/works/OL12W", 12), ("ol7a", 7), ("/works/OL0W", 0), ("/x/12", None),
        ("OL12", None), ("XOL5M", 5), (" /works/OL3W\u00a0", 3), (None, None), ("", None),
        ("/OL5W/x", None), ("OL99999999999999999999W", None),
    ], text.numeric_key)


def test_text_or_value(spark):
    check(spark, [
        ('{"d":" a "}', "a"), ('{"d":{"value":"b"}}', "b"), ('{"d":5}', None),
        ('{"d":"  "}', None), ('{"d":[]}', None), ('{"d":{"value":3}}', None), ("{}", None),
        ('{"d":null}', None), ("[1]", None), ('{"d":"\u00a0x\u2003"}', "x"),
    ], on_json(lambda v: json.text_or_value(v, "d")))


def test_year_or_date(spark):
    check(spark, [
        ("1950", "1950-01-01"), ("May 3, 1821", "1821-01-01"), ("1950-51", "1950-01-01"),
        ("c1950", None), ("1950s", None), ("2020-99-99", "2020-99-99"), ("0950", None),
        ("2250", None), (" 1990-01-02 ", "1990-01-02"), ("é1950", None), ("", None), (None, None),
        ("12 1950 1960", "1950-01-01"), ("19501", None),
    ], dates.year_or_date)


def test_year_of_json_values(spark):
    check(spark, [
        ('{"b":1950}', "1950-01-01"), ('{"b":{"value":"1950"}}', "1950-01-01"),
        ('{"b":true}', None), ('{"b":"about 1700"}', "1700-01-01"),
    ], on_json(lambda v: dates.year_or_date(F.try_variant_get(v, "$.b", "string"))))


def test_record_datetime(spark):
    def case(value):
        return '{"c":{"type":"/type/datetime","value":"%s"}}' % value

    cases = [
        (case("2021-12-26T21:32:02.453026"), "2021-12-26 21:32:02"),
        (case("2021-12-26T21:32:02Z"), "2021-12-26 21:32:02"),
        (case("2021-12-26T21:32:02+05:00"), "2021-12-26 21:32:02"),
        (case("2021-12-26"), "2021-12-26 00:00:00"),
        (case("2021-12-26 21:32"), "2021-12-26 21:32:00"),
        (case("20211226T213202"), "2021-12-26 21:32:02"),
        (case("2021-12-26T25:00:00"), None),
        (case("2021-02-30"), None),
        (case("2021"), None),
        (case("2021-12"), None),
        (case("2021-12-26T21:32:02.junk"), "2021-12-26 21:32:02"),
        (case(" "), None),
        ('{"c":"2021-12-26"}', None),
    ]
    check(spark, cases, on_json(lambda v: records.record_datetime(v, "c").cast("string")))


def test_slugify(spark):
    check(spark, [
        ("Brand#13", "brand-13"), ("Übér  Ñ!", "uber-n"), ("Война и мир", "voina-i-mir"),
        ("!!!", None), ("中文", None), ("", None), (None, None), ("Їжак Щука", "izhak-schuka"),
        ("ﬁn ½ Ⅳ", "fin-1-2-iv"), ("Straße", "stra-e"), ("объём", "obem"), ("Ａ１", "a1"),
        ("𝐀𝑏", "ab"), ("İstanbul", "istanbul"), ("a\u0301b", "ab"), ("x\ue000y", "x-y"),
    ], text.slugify)


def python_slug(value):
    """The folding rule, letter by letter as specified, on a whole string."""
    decomposed = unicodedata.normalize("NFKD", value).lower()
    latin = "".join(CYRILLIC_TO_LATIN.get(c, c) for c in decomposed)
    bare = "".join(
        c for c in unicodedata.normalize("NFKD", latin) if unicodedata.category(c) != "Mn"
    ).lower()
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in bare).split()
    return "-".join(words) or None


def test_slugify_every_character(spark):
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    values = ["a" + c + "b" + c for c in chars]
    got = evaluate(spark, values, text.slugify)
    wrong = [v for v, g in zip(values, got) if g != python_slug(v)]
    assert wrong == []


def test_casefold_every_character(spark):
    chars = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    got = evaluate(spark, ["a" + c for c in chars], text.casefold)
    wrong = [c for c, g in zip(chars, got) if g != ("a" + c).casefold()]
    assert wrong == []


def test_strip_every_character(spark):
    chars = [chr(c) for c in range(0x3100) if c]
    got = evaluate(spark, [c + "a " + c for c in chars], text.strip)
    assert got == [(c + "a " + c).strip() for c in chars]


def test_entity_slug(spark):
    rows = spark.createDataFrame(
        [("A B", 12), (None, 123), ("a" * 300, 1), ("a" * 219 + "-b", 2)], "t string, n bigint"
    )
    got = [r.s for r in rows.select(text.entity_slug(F.col("t"), F.col("n")).alias("s")).collect()]
    assert got == ["a-b-12", "123-123", "a" * 220 + "-1", "a" * 219 + "-2"]


def test_author_name(spark):
    cases = [
        (("Twain, Mark", "twain", None), "Twain, Mark"),
        (("Mark", "Twain", None), "Mark Twain"),
        ((None, "X", "Y"), "X"),
        ((None, None, "Y"), "Y"),
        ((" ", "", " Z "), "Z"),
        (("Mark ", " ", None), "Mark"),
        ((None, None, None), None),
    ]
    rows = spark.createDataFrame([c for c, _ in cases], "p string, l string, n string")
    clean = rows.select(*[text.blank_to_null(F.col(c)).alias(c) for c in rows.columns])
    out = clean.select(text.author_name(F.col("p"), F.col("l"), F.col("n")).alias("a")).collect()
    assert [r.a for r in out] == [e for _, e in cases]


def test_subjects(spark):
    cases = [
        ('{"subjects":["A ",5,null,"b","a",""],"genres":["C"]}', ["A", "b", "C"]),
        ('{"subjects":"x"}', []), ("{}", []), ("[1]", []),
        ('{"genres":["STRASSE"],"subjects":["straße","é","É"]}', ["straße", "é"]),
        ('{"subject_people":["p"],"subject_places":["q"]}', ["q", "p"]),
    ]
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, v string")
    parsed = rows.select("i", json.parse(F.col("v")).alias("d"))
    got = records.with_subjects(parsed, "d", "subjects").orderBy("i").collect()
    assert [r.subjects for r in got] == [e for _, e in cases]


def test_cover_ids(spark):
    check(spark, [
        ('{"covers":[1,"2",-1,1.5,"x",1,true,null,"-3"]}', [1, 2, -1]),
        ('{"covers":7}', []), ("{}", []),
    ], on_json(lambda v: records.cover_ids(v, "covers")))


def test_source_records(spark):
    got = evaluate(
        spark,
        ['{"source_records":["ia:abc:d","abc",":k","ia:"," : ",5," marc : x "]}', "{}"],
        on_json(records.source_records),
    )
    assert [[tuple(p) for p in row] for row in got] == [
        [("ia", "abc:d"), ("unknown", "abc"), ("unknown", "k"), ("marc", "x")], [],
    ]


def test_array_text(spark):
    rows = spark.createDataFrame([(["a", "é"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(records.array_text(F.col("v"))).collect()] == [
        '["a","é"]', None, None,
    ]


def test_intro_counts_characters(spark):
    check(spark, [("é" * 600, "é" * 500), ("😀" * 501, "😀" * 500), (None, None)], text.intro)


def test_escapes(spark):
    check(spark, [("a\\b\tc\nd\re", "a\\\\b\\tc\\nd\\re"), (None, "\\N")], tsv.escape_text)
    check(spark, [('{"a":"\\n"}\t', '{"a":"\\n"} '), (None, "\\N")], tsv.escape_json)


def test_compact_json(spark):
    check(spark, [('{ "b" : 1, "a" : "é" }', '{"a":"é","b":1}')], on_json(json.compact))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_fields_like_csv_module(spark, seed):
    rng = random.Random(seed)
    values = ["".join(rng.choice('ab"\t\r "') for _ in range(rng.randint(0, 10))) for _ in range(4000)]
    expected = []
    for value in values:
        try:
            expected.append(next(csv.reader([value], delimiter="\t", quotechar='"')))
        except csv.Error:
            expected.append(None)
    assert evaluate(spark, values, tsv.quoted_fields) == expected


def test_quoted_fields_of_huge_lines(spark):
    value = 'Q1\t"' + '{""a"":1}' * 300_000 + '"'
    got = evaluate(spark, [value], tsv.quoted_fields)[0]
    assert got == ["Q1", '{"a":1}' * 300_000]
