"""read_sparql: results of a remote SPARQL endpoint."""

from __future__ import annotations

import csv
import io
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import InvalidInput, RdfError

TIMEOUT, REDIRECTS, LIMIT = 30, 5, 256 << 20


class _Redirects(urllib.request.HTTPRedirectHandler):
    max_redirections = REDIRECTS


def fetch(url: str) -> bytes:
    """The body that a GET of CSV returns."""
    request = urllib.request.Request(url, headers={"Accept": "text/csv"})
    try:
        with urllib.request.build_opener(_Redirects).open(request, timeout=TIMEOUT) as answer:
            body = answer.read(LIMIT + 1)
    except (urllib.error.URLError, OSError) as e:
        raise RdfError(f"IO Error: SPARQL request failed: {e}") from None
    if len(body) > LIMIT:
        raise RdfError(f"IO Error: SPARQL response is larger than {LIMIT} bytes")
    return body


def read_sparql(spark: SparkSession, endpoint: str, query: str, transport: Callable[[str], bytes] = fetch) -> DataFrame:
    """One text column for each field of the header; cells that are empty or missing are null."""
    if not endpoint:
        raise InvalidInput("Invalid Input Error: endpoint must not be empty")
    if not query:
        raise InvalidInput("Invalid Input Error: query must not be empty")
    if not endpoint.startswith(("http://", "https://", "HTTP://", "HTTPS://")):
        raise InvalidInput("Invalid Input Error: endpoint must be an http or https URL")
    url = endpoint + ("&" if "?" in endpoint else "?") + "query=" + urllib.parse.quote(query, safe="")
    rows = list(csv.reader(io.StringIO(transport(url).decode("utf-8-sig"), newline="")))
    if not rows or not any(rows[0]):
        raise RdfError("IO Error: SPARQL response has no header")
    head, width = rows[0], len(rows[0])
    # a blank line is a row with one empty cell; csv gives it no cells
    cells = [tuple((row[i] or None) if i < len(row) else None for i in range(width)) for row in rows[1:] if row or width == 1]
    return spark.createDataFrame(cells, T.StructType([T.StructField(name, T.StringType()) for name in head]))
