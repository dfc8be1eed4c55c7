"""Tables by name, wherever they live: files, a catalog, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class FileTable:
    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class CatalogTable:
    """``catalog.schema.table``, or a temporary view."""

    name: str


@dataclass(frozen=True)
class JdbcSplit:
    """How one database table is read by many tasks: ranges of a numeric, date or time column."""

    column: str
    lower: int | datetime
    upper: int | datetime
    parts: int


@dataclass(frozen=True)
class JdbcCuts:
    """As ``JdbcSplit``, for a column whose values are not spread evenly: tasks read from one cut to the next."""

    column: str
    cuts: Sequence[int | datetime]

    def conditions(self) -> list[str]:
        """One condition per task: every row meets exactly one of them, a null column the first."""
        cuts = sorted(set(self.cuts))
        if not cuts:
            return ["1 = 1"]
        shown = [f"'{c.isoformat(sep=' ')}'" if isinstance(c, datetime) else str(int(c)) for c in cuts]
        inner = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(shown, shown[1:], strict=False)]
        return [f"{self.column} < {shown[0]} OR {self.column} IS NULL", *inner, f"{self.column} >= {shown[-1]}"]


def quantile_cuts(rows: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> JdbcCuts:
    """Cuts of a whole-number or time column that leave about as many of ``rows`` in each of ``parts``.

    ``rows`` may be the table, a sample of it, or an index of it: an aggregate reads the one column. A value that
    fills several parts by itself is one cut, so a part may hold more rows, but none is split in vain.
    """
    shares = [k / parts for k in range(1, parts)]
    if not shares:
        return JdbcCuts(column, ())
    found = rows.agg(F.percentile_approx(column, shares, accuracy).alias("cuts")).first()["cuts"]
    return JdbcCuts(column, tuple(sorted(set(found or ()))))


@dataclass(frozen=True)
class JdbcTable:
    """A table of a PostgreSQL or MySQL service database.

    Only the table is named here. Filters and column lists come from the report's own plan, and the
    JDBC source pushes them into the statement it sends.
    """

    url: str
    table: str
    split: JdbcSplit | JdbcCuts | None = None
    fetch_rows: int = 10_000
    credentials: Mapping[str, str] = field(default_factory=dict, repr=False)

    def options(self) -> dict[str, str]:
        chosen = {
            "url": self.url,
            "dbtable": self.table,
            "fetchsize": str(self.fetch_rows),
            "preferTimestampNTZ": "true",
            **self.credentials,
        }
        if self.url.startswith("jdbc:mysql:"):
            # Without it the MySQL driver holds a whole result in memory whatever the fetch size.
            chosen["useCursorFetch"] = "true"
        if isinstance(self.split, JdbcSplit):
            chosen |= {
                "partitionColumn": self.split.column,
                "lowerBound": str(self.split.lower),
                "upperBound": str(self.split.upper),
                "numPartitions": str(self.split.parts),
            }
        return chosen


TableSource = FileTable | CatalogTable | JdbcTable


def read_table(spark: SparkSession, source: TableSource) -> DataFrame:
    if isinstance(source, CatalogTable):
        return spark.table(source.name)
    if isinstance(source, JdbcTable):
        options = source.options()
        if isinstance(source.split, JdbcCuts):
            url, name = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, name, predicates=source.split.conditions(), properties=options)
        return spark.read.format("jdbc").options(**options).load()
    return spark.read.format(source.format).options(**source.options).load(source.path)


class Tables(Mapping[str, DataFrame]):
    """The tables a set of reports may use; each one is opened on first use only."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, TableSource | DataFrame]):
        self.spark = spark
        self._sources = dict(sources)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            source = self._sources[name]
            opened = source if isinstance(source, DataFrame) else read_table(self.spark, source)
            self._opened[name] = opened
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._sources)

    def __len__(self) -> int:
        return len(self._sources)
