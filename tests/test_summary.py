"""NDJSON in and out, and totals over it."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pagegraph.functions.variants import truthy_json
from pagegraph.operators.summary import REPORT_LINES, summarize, summary_report
from pagegraph.sources import ndjson
from pagegraph.sources.ndjson import (
    read_ndjson,
    rejected_lines,
    write_ndjson,
    write_ndjson_counted,
    write_posts,
)

ZEROS = dict.fromkeys(REPORT_LINES, 0)


def totals(spark, tmp_path, lines, **options):
    path = tmp_path / "rows.ndjson"
    text = "\n".join(line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines)
    path.write_text(text, encoding="utf-8")
    return summarize(read_ndjson(spark, str(path), **options)).first().asDict()


def test_crawl_rows(spark, tmp_path):
    rows = [
        {"url": "u1", "status": 200, "n_internal_links": 2, "links": ["a", "b"], "external_links": ["x"], "emails": ["e", "f"], "images": ["i"]},
        {"url": "u2", "status": 301, "n_internal_links": 1, "external_links": ["x"], "emails": [], "images": ["i"]},
        {"url": "u3", "status": 404, "external_links": None, "emails": ["e"]},
        {"url": "u4", "status": 500},
    ]
    assert totals(spark, tmp_path, rows) == ZEROS | {
        "total_rows": 4, "unique_urls": 4, "status_2xx": 1, "status_3xx": 1, "status_4xx": 1, "status_5xx": 1,
        "total_internal_links": 3, "total_external_links": 2, "total_emails": 3, "total_images": 2,
    }


def test_empty_file(spark, tmp_path):
    assert totals(spark, tmp_path, []) == ZEROS
    assert totals(spark, tmp_path, ["", "  ", " "]) == ZEROS


@pytest.mark.parametrize(
    "row, expected",
    [
        ({"internal_links": ["a", "b"], "n_internal_links": 999}, 2),
        ({"n_internal_links": "not-int", "links": [1, 2, 3]}, 3),
        ({"n_internal_links": 7, "links": [1]}, 7),
        ({"n_internal_links": -2}, -2),
        ({"n_internal_links": True}, 1),
        ({"n_internal_links": 3.0, "links": "abc"}, 0),
        ({"internal_links": {"a": 1}, "n_internal_links": None, "links": []}, 0),
    ],
)
def test_internal_links(spark, tmp_path, row, expected):
    assert totals(spark, tmp_path, [row])["total_internal_links"] == expected


def test_status_by_json_type(spark, tmp_path):
    lines = ["", '{"url":"a","status":200}', "   ", '{"url":"b","status":"200"}', '{"url":"c","status":999}',
             '{"url":"d","status":200.0}', '{"url":"e","status":true}', '{"url":"f","status":null}', '{"status":2e2}']
    got = totals(spark, tmp_path, lines)
    assert got == ZEROS | {"total_rows": 7, "unique_urls": 6, "status_2xx": 1}


def test_scrape_and_post_rows(spark, tmp_path):
    rows = [
        {"kind": "email", "value": "a@b.co", "source_url": "u"},
        {"kind": "email", "value": "", "source_url": "u"},
        {"kind": "email", "value": None, "source_url": ""},
        {"kind": "offsite_link", "source_url": None},
        {"kind": "image", "value": "i", "status": 200, "emails": ["not counted"]},
        {"kind": "instagram_post", "url": "p", "status": 200, "images": ["x"], "image_url": "", "emails": [], "external_links": ["o"]},
        {"kind": "instagram_post", "url": "p", "status": 200, "image_url": "i.jpg"},
        {"kind": "instagram_post", "url": "", "image_url": 0},
        {"kind": "other", "url": "u", "image_url": "i.jpg"},
        {"kind": ["email"], "value": "x"},
    ]
    assert totals(spark, tmp_path, rows) == ZEROS | {
        "total_rows": 10, "unique_urls": 2, "status_2xx": 2, "total_external_links": 1, "total_emails": 1, "total_images": 3,
    }


def test_fields_that_are_no_lists(spark, tmp_path):
    row = {"url": 5, "external_links": "ab", "emails": {"a": 1}, "images": 3, "links": None}
    assert totals(spark, tmp_path, [row, {"url": "5"}]) == ZEROS | {"total_rows": 2, "unique_urls": 2}


def test_bad_lines(spark, tmp_path):
    lines = ['{"url":"a"}', "{broken", "[1]", "5"]
    with pytest.raises(Exception, match="not a JSON object"):
        totals(spark, tmp_path, lines)
    assert totals(spark, tmp_path, lines, on_bad="quarantine")["total_rows"] == 1
    bad = rejected_lines(spark, str(tmp_path / "rows.ndjson")).collect()
    assert sorted(r.line for r in bad) == ["5", "[1]", "{broken"]
    with pytest.raises(ValueError):
        read_ndjson(spark, "x", on_bad="skip")


def test_totals_by_key(spark):
    rows = spark.createDataFrame([("f1", '{"url":"a","status":200}'), ("f2", '{"url":"a"}'), ("f2", '{"url":"a"}')], "file string, line string")
    parsed = rows.select("file", F.parse_json("line").alias("v"))
    got = {r.file: (r.total_rows, r.unique_urls, r.status_2xx) for r in summarize(parsed, ("file",)).collect()}
    assert got == {"f1": (1, 1, 1), "f2": (2, 1, 0)}


def test_report(spark, tmp_path):
    path = tmp_path / "rows.ndjson"
    path.write_text('{"url":"a","status":404}')
    rows = sorted(summary_report(summarize(read_ndjson(spark, str(path)))).collect())
    assert [(r.ordinal, r.label) for r in rows] == list(enumerate(REPORT_LINES.values(), start=1))
    assert [r.value for r in rows] == [1, 1, 0, 0, 1, 0, 0, 0, 0, 0]


def written_lines(path):
    files = [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-")]
    return [line for f in files for line in open(f, encoding="utf-8").read().split("\n") if line]


def test_written_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("é漢", None, ["a"], 1)], "url string, title string, links array<string>, level int")
    write_ndjson(df, path)
    write_ndjson(df, path)
    lines = written_lines(path)
    assert [json.loads(line) for line in lines] == [{"url": "é漢", "title": None, "links": ["a"], "level": 1}]
    assert "é漢" in lines[0] and list(json.loads(lines[0])) == ["url", "title", "links", "level"]
    assert write_ndjson_counted(df.union(df), path) == 2
    assert len(written_lines(path)) == 2


def test_compressed_rows_come_back_from_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ndjson, "ROWS_A_FILE", 2)
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(f"é{i}\n", None) for i in range(5)], "url string, title string").coalesce(1)
    write_ndjson(df, path, compressed=True)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    found = read_ndjson(spark, path).select(F.col("v").cast("string").alias("line")).collect()
    assert sorted(json.loads(r.line)["url"] for r in found) == [f"é{i}\n" for i in range(5)]
    write_ndjson(df, path)
    assert len(written_lines(path)) == 5


def test_posts_without_rows_write_nothing(spark, tmp_path):
    posts = spark.createDataFrame([("p",)], "url string")
    write_posts(posts.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    write_posts(posts, str(tmp_path / "some"))
    assert len(written_lines(str(tmp_path / "some"))) == 1
    write_ndjson(posts.limit(0), str(tmp_path / "empty"))
    assert (tmp_path / "empty").exists()


def test_bad_lines_fail_whatever_is_read(spark, tmp_path):
    path = tmp_path / "bad.ndjson"
    path.write_text('{"url": "a"}\nno json\n[1]\n')
    rows = read_ndjson(spark, str(path))
    for partial in (rows, rows.select(F.lit(1))):
        with pytest.raises(Exception, match="not a JSON object"):
            partial.count()
    assert read_ndjson(spark, str(path), on_bad="quarantine").count() == 1


def test_totals_of_each_file(spark, tmp_path):
    for name, n in (("one", 2), ("two", 3)):
        (tmp_path / f"{name}.ndjson").write_text("".join(f'{{"url": "u{i}", "status": 200}}\n' for i in range(n)))
    rows = summarize(read_ndjson(spark, str(tmp_path), with_file=True), ["file"]).collect()
    assert {r.file.rpartition("/")[2]: r.total_rows for r in rows} == {"one.ndjson": 2, "two.ndjson": 3}


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "rows.ndjson").write_text('{"url": "u"}\n')
    plan = summarize(read_ndjson(spark, str(tmp_path / "rows.ndjson")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert plan.count("regexp_replace") == 1


def test_a_values_text_is_worked_out_once(spark):
    """A value stands once in its own test: a condition on it would read the row again."""
    rows = spark.createDataFrame(
        [('{"a": "x\\ny"}',), ('{"a": ""}',), ('{"a": 0.0}',), ('{"a": "0"}',), ('{"a": [null]}',), ('{"a": {}}',), ("{}",)], "line string"
    ).select(F.try_parse_json("line").alias("v"))
    told = rows.select(truthy_json(F.col("v"), "a").alias("a"))
    assert [r.a for r in told.collect()] == ['"x\\ny"', None, None, '"0"', "[null]", None, None]
    assert told._jdf.queryExecution().analyzed().toString().lower().count("to_json(") == 1
