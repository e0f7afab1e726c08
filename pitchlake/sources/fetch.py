"""Documents fetched by GET, one for each id: ids are dealt to as many tasks as may send requests at a time.

The pause after each request is a task's own, so ``parts / delay`` requests a second are the most that a server sees.  A task that is
lost sends its requests again.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.leagues import source_key

#: Seconds: an answer may take, and a task pauses after each request.
TIMEOUT, DELAY = 30.0, 0.5


def get(url: str | None, timeout: float = TIMEOUT, attempts: int = 1) -> tuple[int | None, str | None]:
    """(status, body) of a GET request; the body is null unless it succeeded.  Only what may pass is tried again: no connection, or a status of 500 or more."""
    status = None
    for _ in range(max(1, attempts)):
        try:
            with urllib.request.urlopen(url or "", timeout=timeout) as answer:  # noqa: S310  the address is the caller's
                return answer.status or 200, answer.read().decode("utf-8")
        except urllib.error.HTTPError as e:
            status = e.code
            if status < 500:
                break
        except (OSError, ValueError):  # refused, timed out, no such host, not UTF-8, not an address
            status = None
    return status, None


def fetched(requests: DataFrame, parts: int = 8, delay: float = DELAY, timeout: float = TIMEOUT, attempts: int = 1) -> DataFrame:
    """``requested_id, status, body`` of each distinct ``requested_id, url``.

    A request that fails (no connection, no answer in time, a status of 400 or more) leaves a null body and, if
    there was one, its status; a null id or address is asked for like any other, and fails.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for requested, url in zip(batch.column(0), batch.column(1), strict=True):
                status, body = get(url.as_py(), timeout, attempts)
                yield pa.RecordBatch.from_arrays([pa.array([requested.as_py()], pa.string()), pa.array([status], pa.int32()), pa.array([body], pa.string())], names=["requested_id", "status", "body"])
                if delay > 0:
                    time.sleep(delay)

    asked = requests.select(F.col("requested_id").cast("string").alias("requested_id"), "url").distinct()
    return asked.repartition(parts, "requested_id").mapInArrow(run, "requested_id string, status int, body string")


def address(pattern: str, requested: Column) -> Column:
    """``pattern`` with the id, escaped, for ``{id}``."""
    return F.replace(F.lit(pattern), F.lit("{id}"), F.replace(F.url_encode(requested.cast("string")), F.lit("+"), F.lit("%20")))


def profiles(ids: DataFrame, pattern: str, league: str | None = None, **options: float) -> DataFrame:
    """Athlete profiles of ``ids`` (``requested_id``) in the shape of :func:`pitchlake.sources.readers.profiles`: null fields where a request failed or its answer isn't JSON.

    ``pattern`` has ``{id}``, and ``{league}`` for the source's own name of a league.
    """
    if league is not None:
        pattern = pattern.replace("{league}", source_key(league))
    asked = ids.select("requested_id", address(pattern, F.col("requested_id")).alias("url"))
    good = F.when(F.try_parse_json("body").isNotNull(), F.col("body"))
    return fetched(asked, **options).select("requested_id", good.alias("_raw")).withColumn("d", F.from_json("_raw", schemas.PROFILE)).select("requested_id", "_raw", "d.*")
