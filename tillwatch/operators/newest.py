"""Newest rows found from the newest end: time slices of growing width, until it is proven that nothing newer is left.

"The latest success of a vendor" needs the newest few hours of a table as a rule and all of its history at worst. A search
reads one slice after the other, newest first; each is a plain bound on the time column, pushed into the scan, and every
row is read once at most. Rows are ordered by a number (``order``) that follows the time up to ``slack``: a row with a
larger number is at most ``slack`` older. So a row found at time t is the newest of its key as soon as all rows from t - slack
on have been read; until then the search goes on. The last slice has no bound, so rows without a time are found as well.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, functions as F

from tillwatch.functions.clock import Span


@dataclass(frozen=True)
class Newest:
    """A search that starts at the clock ``at``: slices of ``first``, then ``growth`` times the width before, ``steps`` in all."""

    at: datetime
    ts: str = "create_date"
    slack: timedelta = timedelta(hours=1)
    first: timedelta = timedelta(hours=2)
    growth: int = 8
    steps: int = 6

    def slices(self) -> Iterator[tuple[Column, datetime | None]]:
        """(condition, oldest time covered so far) of each slice, the newest one first; the last one covers the rest."""
        lower, width = self.at - self.first, self.first
        yield Span(start=lower).covers(self.ts), lower
        for _ in range(self.steps - 1):
            upper, width = lower, width * self.growth
            lower = upper - width
            yield Span(start=lower, before=upper).covers(self.ts), lower
        yield Span(before=lower).covers(self.ts) | F.col(self.ts).isNull(), None


@dataclass(frozen=True)
class Found:
    """The newest row of a key: its order number, its time, and the columns that were asked for."""

    order: object
    ts: datetime | None
    row: Row


def newest_rows(
    fact: DataFrame,
    columns: Sequence[str],
    search: Newest,
    *,
    where: Column | None = None,
    key: str | None = None,
    wanted: Sequence[str] = (None,),
    order: str = "id",
) -> dict[str | None, Found]:
    """The newest row of each ``wanted`` value of ``key`` (without a key: of the table) that meets ``where``.

    One job per slice, each an aggregate that keeps one candidate per key and task. What reaches the driver is one row
    per wanted value. Keys that are settled leave the condition of the next slice. A row whose order is null is no candidate.
    """
    best: dict[str | None, Found] = {}
    missing = list(dict.fromkeys(wanted))
    rows = fact if where is None else fact.filter(where)
    rows = rows.filter(F.col(order).isNotNull())
    for held, lower in search.slices():
        part = rows.filter(held)
        if key is not None:
            part = part.filter(F.col(key).isin(*missing))
        name = F.lit(None).cast("string") if key is None else F.col(key)
        at = F.col(search.ts).cast("timestamp_ntz").alias("ts")
        newest = F.max_by(F.struct(F.col(order).alias("order"), at, F.struct(*columns).alias("row")), order)
        for group in part.groupBy(name.alias("key")).agg(newest.alias("newest")).collect():
            found = Found(group["newest"]["order"], group["newest"]["ts"], group["newest"]["row"])
            known = best.get(group["key"])
            if known is None or found.order > known.order:
                best[group["key"]] = found
        if lower is None:
            break
        missing = [k for k in missing if k not in best or best[k].ts is None or best[k].ts - search.slack < lower]
        if not missing:
            break
    return best


def answers_since(log: DataFrame, found: Sequence[Found], search: Newest | None, log_ts: str = "create_date") -> DataFrame:
    """The log from the oldest of the found requests on, less the slack; answers are not logged before they are asked for."""
    times = [f.ts for f in found]
    if search is None or not times or None in times:
        return log
    return log.filter(Span(start=min(times) - search.slack).covers(log_ts))
