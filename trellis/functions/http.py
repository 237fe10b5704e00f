"""Request-line and response expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The response heads the server writes.
OK_HEAD = "HTTP/1.0 200 OK\r\n\r\n"
NOT_FOUND_HEAD = "HTTP/1.0 404 Not Found\r\n\r\n"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def method_ok(line) -> Column:
    """The line starts with ``GET``."""
    return F.coalesce(_c(line).startswith("GET"), F.lit(False))


def request_path(line) -> Column:
    """Second item of the line split on single spaces (trailing empty
    items dropped, so ``"GET "`` has no path; two spaces give ``""``)."""
    trimmed = F.rtrim(_c(line), F.lit(" "))
    return F.get(F.split(trimmed, " "), 1)


def format_response(status, body) -> Column:
    """Status line, blank line, then the body for a 200."""
    s, b = _c(status), _c(body)
    return (F.when(s == 200, F.concat(F.lit(OK_HEAD), F.coalesce(b, F.lit(""))))
            .otherwise(F.lit(NOT_FOUND_HEAD)))
