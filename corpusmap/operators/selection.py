"""Selection of articles and of change events by request parameters."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmap.operators.worklists import check_limit


def select_articles(
    articles: DataFrame,
    fields: Sequence[str] = (),
    filters: Mapping[str, object] | None = None,
    since: datetime.datetime | None = None,
    limit: int | None = None,
    since_col: str = "date_modified",
) -> DataFrame:
    """Dotted ``fields`` (named by the whole path), equality ``filters`` on dotted paths, rows from
    ``since`` on, at most ``limit`` of them."""
    check_limit(limit)
    rows = articles
    for path, value in (filters or {}).items():
        rows = rows.filter(F.col(path) == value)
    if since is not None:
        rows = rows.filter(F.col(since_col) >= F.lit(since))
    if fields:
        rows = rows.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields])
    return rows if limit is None else rows.limit(limit)


def replay(
    events: DataFrame,
    since: datetime.datetime | None = None,
    parts: Sequence[int] = (),
    offsets: Mapping[int, int] | None = None,
    since_per_partition: Mapping[int, datetime.datetime] | None = None,
) -> DataFrame:
    """Events to deliver again: chosen partitions, from an offset and a time of each.

    The parameters name feed partitions, a handful, so they become literal conditions, which push
    down to the scan and work the same on a stream.
    """
    part, offset, published = (F.col(f"event.{name}") for name in ("partition", "offset", "datePublished"))
    rows = events.filter(part.isin(list(parts))) if parts else events
    if since is not None:
        rows = rows.filter(published >= F.lit(since))
    for column, bounds in ((offset, offsets), (published, since_per_partition)):
        for number, bound in (bounds or {}).items():
            # an event without a partition is under no bound
            rows = rows.filter(part.isNull() | (part != number) | (column >= F.lit(bound)))
    return rows
