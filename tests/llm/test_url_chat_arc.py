import hashlib

import pytest

from stackroom.llm import arc_convert, chat_format, url_filter
from stackroom.llm.queries import QUERIES, SQL, URL_RULES
from oracle import difference


def test_url_rules(spark):
    urls = [
        None, "", "no scheme/net/", "http://A.Example.NET/en/x?q#f", "http://example.net/de/",
        "https://notnet/", "http://www.example.com/de/a", "http://example.com/den", "ftp://x.org/fr/#",
        "http://x.org?/fr/", "http://" + "a" * 20000 + ".net/", "http://exÄmple.com/DE/",
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id int, url string, host string")
    out = {r["page_id"]: r for r in url_filter.judge(pages, URL_RULES).collect()}
    rules = [out[i]["rule"] for i in range(len(urls))]
    assert rules == [None, None, None, "example.net/en/", "net/", None, "example.com/de/", None, "org/fr/",
                     None, "net/", None]
    assert (out[3]["host"], out[3]["path"]) == ("a.example.net", "/en/x")
    assert (out[9]["host"], out[9]["path"]) == ("x.org", "") and out[11]["host"] == "exÄmple.com"
    assert {out[0]["host"], out[0]["path"], out[2]["host"]} == {""}
    assert all(out[i]["verdict"] in ("allow", "block") for i in out)
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_chat_round_trip(spark):
    tricky = ["<|im_end|>", "\\<|", "<\\|im_end|>\n<|im_start|>user\nhi", "", None, "a" * 30000, "\\\\<|x"]
    rows = [(i, "any", [("user", t), ("assistant", t)]) for i, t in enumerate(tricky)]
    turns = spark.createDataFrame(
        rows, "conv_id int, layout string, turns array<struct<role:string,text:string>>"
    )
    back = chat_format.read_back(chat_format.formatted(turns, "conv_id"), "conv_id").collect()
    assert len(back) == len(tricky)
    for r in back:
        text = tricky[r["conv_id"]] or ""
        assert [(t["role"], t["text"]) for t in r["turns"]] == [("user", text), ("assistant", text)]
        assert "".join(r["loss_texts"]) == text


def test_arc_to_warc(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://c d/\n", "small"), (4, "", "small"),
            (5, "u", None), (6, "v", ""), (7, "w", big), (8, "x", "WARC/1.0\r\n\r\n" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc = arc_convert.to_warc(arc_convert.write_arcs(pages, "page_id", "url", "html"))
    arc_convert.write_warc(warc, str(tmp_path / "out"))
    read = {r["key"]: r for r in arc_convert.read_warc(spark, str(tmp_path / "out")).collect()}
    assert sorted(read) == list(range(1, 9))
    for key, _, html in rows:
        body = (html or "").encode()
        assert read[key]["bytes"] == len(body) and read[key]["digest"] == hashlib.sha1(body).hexdigest()
    assert {k: r["refers_to_key"] for k, r in read.items() if r["type"] == "revisit"} == {1: 7, 2: 7}


@pytest.mark.parametrize("name", sorted(SQL))
def test_like_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, QUERIES[name], SQL[name]) is None


def test_batches_of_equal_keys(spark, tmp_path):
    body = "same " * 300
    pages = spark.createDataFrame([(None, "http://a.example/", body)] * 4, "page_id long, url string, html string")
    # Two partitions of two rows, with equal lists of keys.
    archives = arc_convert.write_arcs(pages.repartition(2), "page_id", "url", "html")
    assert archives.select("name").distinct().count() == archives.count() == 2
    warc = [r["value"] for r in arc_convert.to_warc(archives).collect()]
    assert len(warc) == 4 and sum("WARC-Type: response" in w for w in warc) == 1


def test_archives_are_packed_well(spark):
    import pyarrow.parquet as pq

    words = [f"word{i * i % 997}" for i in range(3000)]
    rows = spark.createDataFrame([(i, "http://a/", " ".join(words[i:])) for i in range(20)], "id long, url string, html string")
    archives = arc_convert.write_arcs(rows, "id", "url", "html")
    for path in archives.inputFiles():
        groups = pq.ParquetFile(path.removeprefix("file:")).metadata
        for i in range(groups.num_row_groups):
            assert groups.row_group(i).column(1).compression == "ZSTD"
    assert arc_convert.records(archives).count() == 20
