"""Streams give what the batch gives."""

import json

from pyspark.sql import functions as F

from pagegraph.functions.urls import netloc
from pagegraph.operators.extract import profile_pages
from pagegraph.operators.summary import summarize
from pagegraph.sources.ndjson import parse_lines, read_ndjson
from pagegraph.sources.responses import read_responses
from pagegraph.streaming import streams

SCHEMA = "page_id long, url string, html string"


def pages_dir(spark, tmp_path):
    """Pages in three files, so that they arrive one batch at a time."""
    path = str(tmp_path / "pages")
    for i in range(3):
        html = f"<title>t{i}</title><a href='mailto:same@x.org'><a href='mailto:own{i}@x.org'><a href='/p{i}'>"
        spark.createDataFrame([(i, f"http://h/{i}", html)], SCHEMA).write.mode("append").parquet(path)
    return path


def responses(pages):
    return read_responses(pages).withColumn("host", netloc("requested_url"))


def arriving(spark, path):
    return responses(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path))


def run(stream, name, mode="append"):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def test_profiles(spark, tmp_path):
    path = pages_dir(spark, tmp_path)
    got = run(streams.stream_profiles(arriving(spark, path), "host", ["page_id"]), "profiles").collect()
    want = profile_pages(responses(spark.read.parquet(path)), "host", ["page_id"]).collect()
    assert len(got) == 3 and sorted(got) == sorted(want)


def test_scrape(spark, tmp_path):
    profiles = streams.stream_profiles(arriving(spark, pages_dir(spark, tmp_path)), "host")
    rows = run(streams.stream_scrape(profiles, "emails"), "scraped").collect()
    assert sorted(r.value for r in rows) == ["own0@x.org", "own1@x.org", "own2@x.org", "same@x.org"]


def test_scrape_within_a_watermark(spark, tmp_path):
    profiles = streams.stream_profiles(arriving(spark, pages_dir(spark, tmp_path)), "host", ["page_id"])
    timed = profiles.withColumn("at", F.timestamp_seconds(F.col("page_id") + 1_700_000_000))
    rows = run(streams.stream_scrape(timed, "emails", "at", "1 hour"), "scraped_within").collect()
    assert sorted(r.value for r in rows) == ["own0@x.org", "own1@x.org", "own2@x.org", "same@x.org"]


def first_sources(spark, path, out, progress, pages=None):
    profiles = streams.stream_profiles(arriving(spark, path), "host", ["page_id"])
    first = streams.stream_first_sources(streams.stream_values(profiles, "emails", "page_id"), "page_id")
    writer = first.writeStream.outputMode("update").option("checkpointLocation", progress)
    writer.foreachBatch(streams.write_batches(out)).trigger(availableNow=True).start().awaitTermination()
    return {(r.value, r.source_url) for r in streams.read_batches(spark, out).collect()}


def test_first_source_over_batches(spark, tmp_path):
    """Pages arrive in batches, over several starts of the query; a value keeps its first page."""
    path, out, progress = str(tmp_path / "pages"), str(tmp_path / "sources"), str(tmp_path / "progress")
    # By batch: later pages of a batch first, and in the last batch a page that would come first of all.
    batches = [
        [(5, "http://h/5", ("b", "a")), (4, "http://h/4", ("a",))],
        [(6, "http://h/6", ("a", "c")), (7, "http://h/7", ("c",))],
        [(0, "http://h/0", ("a", "b", "c", "d")), (1, "http://h/1", ())],
    ]
    seen = set()
    for i, batch in enumerate(batches):
        rows = [(k, u, "".join(f"<a href='mailto:{m}@x.org'>" for m in mails)) for k, u, mails in batch]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        got = first_sources(spark, path, out, progress)
        assert seen <= got and len({v for v, _ in got}) == len(got)
        seen = got
        assert len(list((tmp_path / "sources").glob("batch=*"))) == i + 1
    want = {("a", "http://h/4"), ("b", "http://h/5"), ("c", "http://h/6"), ("d", "http://h/0")}
    assert seen == {(f"{v}@x.org", u) for v, u in want}
    assert first_sources(spark, path, out, progress) == seen  # nothing new


def test_first_source_reads_no_history(spark, tmp_path):
    """A batch reads its own pages and the keyed state, none of what earlier batches wrote."""
    path, out = pages_dir(spark, tmp_path), str(tmp_path / "out")
    profiles = streams.stream_profiles(arriving(spark, path), "host", ["page_id"])
    first = streams.stream_first_sources(streams.stream_values(profiles, "emails", "page_id"), "page_id")
    writer = first.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "progress"))
    query = writer.foreachBatch(streams.write_batches(out)).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and out not in plan
    states = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert [s["numRowsTotal"] for s in states] == [2, 3, 4] and [s["numRowsUpdated"] for s in states] == [2, 2, 2]


def test_batches_run_again(spark, tmp_path):
    schema = "kind string, value string, source_url string"
    write = streams.write_batches(str(tmp_path / "t"))
    for batch_id, value in ((0, "a"), (1, "b"), (1, "b"), (0, "a")):
        write(spark.createDataFrame([("email", value, "u")], schema), batch_id)
    assert sorted(r.value for r in streams.read_batches(spark, str(tmp_path / "t")).collect()) == ["a", "b"]


def test_summary(spark, tmp_path):
    folder = tmp_path / "rows"
    folder.mkdir()
    for i in range(3):
        rows = [{"url": f"u{i}", "status": 200 + i, "links": ["a"]}, {"kind": "email", "value": "x", "source_url": "u0"}]
        (folder / f"{i}.ndjson").write_text("\n".join(map(json.dumps, rows)))
    whole = summarize(read_ndjson(spark, str(folder))).first().asDict()
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(folder))
    rows = parse_lines(lines).select("v")
    counters = run(streams.stream_counters(rows), "counters", "complete").first().asDict()
    unique = run(streams.stream_unique_urls(rows), "uniques", "complete").first().unique_urls
    assert counters.pop("approx_unique_urls") == 3
    assert counters | {"unique_urls": unique} == whole


def test_summary_in_one_query(spark, tmp_path):
    """All ten totals over several batches and starts, as the batch gives them; URLs repeat across batches."""
    folder, progress = tmp_path / "rows", str(tmp_path / "progress")
    folder.mkdir()
    for i in range(4):
        rows = [
            {"url": f"u{i % 3}", "status": 200 + 100 * i, "links": ["a"], "emails": ["x", "y"], "images": [1]},
            {"url": "u0", "status": 200, "n_internal_links": 7},
            {"kind": "email", "value": "x", "source_url": f"s{i // 2}"},
            {"status": 404, "external_links": ["e"]},
        ]
        (folder / f"{i}.ndjson").write_text("\n".join(map(json.dumps, rows)))
        lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(folder))
        totals = streams.stream_summary(parse_lines(lines).select("v"))
        told = []
        writer = totals.writeStream.outputMode("complete").option("checkpointLocation", progress)
        writer.foreachBatch(lambda batch, _: told.extend(batch.collect())).trigger(availableNow=True).start().awaitTermination()
        assert told[-1].asDict() == summarize(read_ndjson(spark, str(folder))).first().asDict()
    assert told[-1].unique_urls == 5 and told[-1].total_rows == 16
