"""Serving request lines against a file catalog, as batch jobs.

All functions are stateless projections and joins, so the same code runs on
a static table and on a stream (``trellis.streaming.serve``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.functions.http import format_response, method_ok, request_path
from trellis.functions.paths import is_absolute
from trellis.operators.catalog import read_files

REJECT_REASONS = ("empty_line", "not_get", "bad_path")


def parse_requests(req: DataFrame) -> DataFrame:
    """Add ``method_ok`` and ``path``."""
    return req.select("*", method_ok("line").alias("method_ok"), request_path("line").alias("path"))


def _reason():
    return (F.when(F.col("line").isNull() | (F.col("line") == ""), "empty_line")
            .when(~F.col("method_ok"), "not_get")
            .when(F.col("path").isNull() | ~is_absolute("path"), "bad_path"))


def reject_requests(parsed: DataFrame) -> DataFrame:
    """R2: ``(request_id, reason)`` for lines the reference would fail on."""
    return parsed.select("request_id", _reason().alias("reason")).where(F.col("reason").isNotNull())


def accepted_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(_reason().isNull())


def serve(req: DataFrame, files: DataFrame, keyed: DataFrame | list[DataFrame] | None = None) -> DataFrame:
    """For every request R2 does not reject, 200 and the body when the
    path names a file, else 404 and no body.  Extra request columns (``ts``,
    ``driver``) pass through.  ``keyed`` is an optional prepared lookup side
    (see ``read_files``).
    """
    parsed = parse_requests(req)
    ok = accepted_requests(parsed).drop("method_ok", "line")
    served = read_files(files, ok, "path", keyed=keyed)
    status = F.when(F.col("contents").isNull(), F.lit(404)).otherwise(F.lit(200))
    return served.select(*[c for c in ok.columns], status.alias("status"),
                         F.col("contents").alias("body"))


def responses(served: DataFrame) -> DataFrame:
    """R4 applied: the full response text per request."""
    return served.select("request_id", "status",
                         format_response("status", "body").alias("response"))


def completed_requests(resp: DataFrame, window: str = "10 seconds") -> DataFrame:
    """R6 (batch): completed requests per window and driver, with per-window
    and grand totals from a rollup.  ``level`` tells them apart, also where a
    driver is NULL: 0 for a window and driver, 1 for a window, 3 for all."""
    w = F.window("ts", window)
    keyed = resp.select(w.start.alias("window_start"), "driver")
    return (keyed.rollup("window_start", "driver")
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level")))


def response_check(resp: DataFrame, expected: DataFrame) -> DataFrame:
    """Requests whose response text differs from the expected one
    (either side missing counts as a difference); ``n_chars`` is the length
    of the response received."""
    got = resp.select("request_id", format_response("status", "body").alias("got"))
    want = expected.select("request_id", format_response("status", "body").alias("want"))
    j = want.join(got, "request_id", "full_outer")
    return (j.where(~F.col("want").eqNullSafe(F.col("got")))
            .select("request_id", "want", "got", F.length("got").alias("n_chars")))
