"""Request parsing, serving, responses; batch serving equals stream serving."""

from pyspark.sql import functions as F

from trellis.functions.http import format_response
from trellis.operators import requests as R
from trellis.sources import views
from trellis.streaming.serve import completed_available, serve_available

SF = "/root/testdata/sf0.001"

FILES = [("/static/A.txt", "11111"), ("/static/dir1/C.txt", "3333333333")]
LINES = [
    (0, "GET /static/A.txt HTTP/1.1"),
    (1, "GET /static/A.txt/ HTTP/1.1"),
    (2, "GET /static/dir1 HTTP/1.1"),
    (3, "GET /static/missing.txt HTTP/1.1"),
    (4, "POST /static/A.txt HTTP/1.1"),
    (5, "GET"),
    (6, ""),
    (7, None),
    (8, "GET  /static/A.txt"),
    (9, "GET /static/dir1/C.txt"),
    (10, "GET relative.txt HTTP/1.1"),
    (11, "GET "),
]


def req_df(spark):
    return spark.createDataFrame([(i, line, 1, None) for i, line in LINES],
                                 "request_id bigint, line string, driver bigint, ts timestamp_ntz")


def test_parse_and_reject(spark):
    parsed = {r["request_id"]: (r["method_ok"], r["path"])
              for r in R.parse_requests(req_df(spark)).collect()}
    assert parsed[0] == (True, "/static/A.txt")
    assert parsed[5] == (True, None) and parsed[11] == (True, None)
    assert parsed[8] == (True, "")
    assert parsed[4] == (False, "/static/A.txt")
    reasons = {r["request_id"]: r["reason"] for r in R.reject_requests(R.parse_requests(req_df(spark))).collect()}
    assert reasons == {4: "not_get", 5: "bad_path", 6: "empty_line", 7: "empty_line", 8: "bad_path",
                       10: "bad_path", 11: "bad_path"}


def test_serve_and_format(spark):
    files = spark.createDataFrame(FILES, "path string, contents string")
    served = {r["request_id"]: (r["status"], r["body"]) for r in R.serve(req_df(spark), files).collect()}
    assert served == {0: (200, "11111"), 1: (200, "11111"), 2: (404, None), 3: (404, None),
                      9: (200, "3333333333")}
    resp = {r["request_id"]: r["response"] for r in R.responses(R.serve(req_df(spark), files)).collect()}
    assert resp[0] == "HTTP/1.0 200 OK\r\n\r\n11111"
    assert resp[3] == "HTTP/1.0 404 Not Found\r\n\r\n"
    df = spark.createDataFrame([(200, "")], "status int, body string")
    assert df.select(format_response("status", "body")).first()[0] == "HTTP/1.0 200 OK\r\n\r\n"


def test_response_check_flags_differences(spark):
    files = spark.createDataFrame(FILES, "path string, contents string")
    got = R.serve(req_df(spark), files)
    assert R.response_check(got, got).count() == 0
    wrong = got.withColumn("status", F.when(F.col("request_id") == 0, 404).otherwise(F.col("status")))
    bad = R.response_check(got, wrong).collect()
    assert [r["request_id"] for r in bad] == [0] and bad[0]["n_chars"] == len("HTTP/1.0 200 OK\r\n\r\n11111")


def test_stream_equals_batch(spark):
    batch = R.serve(views.requests(spark, SF), views.files(spark, SF)).select(
        "request_id", "path", "status", "body")
    stream = serve_available(spark, SF).select("request_id", "path", "status", "body")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))


def test_completed_counts(spark):
    served = R.serve(views.requests(spark, SF), views.files(spark, SF))
    counts = R.completed_requests(served)
    total = counts.where("level = 3").first()["n"]
    assert total == served.count()
    per = sorted(map(tuple, counts.where("level = 0").drop("level").collect()), key=str)
    for files in (None, 1):
        streamed = completed_available(spark, SF, files)
        assert sorted(map(tuple, streamed.select("window_start", "driver", "n").collect()), key=str) == per


def test_counts_do_not_depend_on_the_batches(spark, tmp_path):
    """A feed of many files, read one at a time, newest first."""
    feed = spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.when(F.col("event_id") % 5 > 0, F.col("user_id")))
    for k in (3, 1, 0, 2):
        feed.where(F.col("event_id") % 4 == k).coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
        (next((tmp_path / f"part{k}").glob("*.parquet"))).rename(tmp_path / f"events{k}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    streamed = completed_available(spark, str(tmp_path), 1)
    served = R.serve(views.request_lines(feed), views.files(spark, SF))
    batch = R.completed_requests(served).where("level = 0").drop("level")
    assert sorted(map(tuple, streamed.select("window_start", "driver", "n").collect()), key=str) == sorted(
        map(tuple, batch.collect()), key=str)


def test_totals_are_told_from_a_missing_driver(spark):
    import datetime
    ts = datetime.datetime(2024, 1, 1)
    resp = spark.createDataFrame([(ts, None), (ts, 1), (ts, 1)], "ts timestamp_ntz, driver bigint")
    got = sorted(((r.driver, r.n, r.level) for r in R.completed_requests(resp).collect()), key=str)
    assert got == sorted([(None, 1, 0), (1, 2, 0), (None, 3, 1), (None, 3, 3)], key=str)


def test_one_answer_per_request(spark):
    files = spark.createDataFrame([("/static/a", "second"), ("/static/a/", "third"), ("/static/a", "first")],
                                  "path string, contents string")
    req = spark.createDataFrame([(1, "GET /static/a HTTP/1.1", 1, None), (2, "GET /static/a/ x", 1, None)],
                                "request_id bigint, line string, driver bigint, ts timestamp_ntz")
    assert sorted((r.request_id, r.body) for r in R.serve(req, files).collect()) == [(1, "first"), (2, "first")]


def test_stream_with_bucketed_catalog(spark, capsys):
    from trellis.session import shared_dir
    from trellis.streaming.serve import prepare_catalog, request_stream, serve_stream
    files = views.files(spark, SF)
    catalog = prepare_catalog(files, broadcast_rows=0)  # force the bucketed table
    out = shared_dir(spark, "test-serve-out")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the catalog were large
    try:
        q = serve_stream(request_stream(spark, SF), files, out, shared_dir(spark, "test-serve-ckpt"),
                         available_now=True, keyed=catalog.table)
        q.awaitTermination()
        q.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        catalog.release()
    plan = capsys.readouterr().out
    # the catalog is read from its buckets; only the micro-batch is exchanged
    final = plan.split("== Initial Plan ==")[0]
    assert "Bucketed: true" in final
    assert final.count("Exchange hashpartitioning(_key") == 1
    batch = R.serve(views.requests(spark, SF), files).select("request_id", "status", "body")
    stream = spark.read.parquet(out).select("request_id", "status", "body")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))
