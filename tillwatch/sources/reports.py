"""Published reports: one folder of versions each, replaced as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.text import grouped_digits


def normalise(report: DataFrame) -> DataFrame:
    """Publishable cells: dates as ``YYYY-MM-DD`` text, decimals as doubles. Times stay whole."""

    def cell(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return report.select(*[cell(field) for field in report.schema.fields])


def with_grouped_digits(report: DataFrame, *columns: str) -> DataFrame:
    """Amount columns as text with thousands separators and no fraction, chosen by name."""
    return report.withColumns({name: grouped_digits(F.col(name)) for name in columns})


def label_union(parts: dict[str, DataFrame], label: str = "service") -> DataFrame:
    """All rows of several reports under one schema, each row carrying its report's name."""
    labelled = [part.select(F.lit(name).alias(label), "*") for name, part in parts.items()]
    return reduce(DataFrame.unionByName, labelled)


def zero_row(report: DataFrame) -> DataFrame:
    """One row of zeros in the schema of ``report``."""
    zeros = [
        F.lit("0").cast(field.dataType).alias(field.name) if _holds_zero(field.dataType)
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in report.schema.fields
    ]
    return report.sparkSession.range(0, 1, 1, 1).select(*zeros)


def _holds_zero(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType | T.StringType)


def publish(
    report: DataFrame,
    name: str,
    root: str,
    *,
    on_empty: str = "keep",
    order: Sequence[Column | str] = (),
    keep_versions: int = 2,
) -> int:
    """Replace report ``name`` under ``root`` and return its number of rows.

    A run writes its rows once, in order, to a version folder of its own. Only when that is complete an
    empty marker file names it as the newest version: one file creation, after which readers find the
    new report and before which they find the old one. A run that fails at any point removes what it
    wrote and leaves the published report as it was; runs at the same time do not meet, and the one
    with the later marker counts. Versions older than the newest ``keep_versions`` are removed
    afterwards, so a reader has until the next publication but one to finish.

    ``on_empty`` says what an empty result does: ``keep`` leaves the old report, ``zero_row`` publishes
    one row of zeros, ``replace`` publishes the empty report. ``order`` sorts the rows, and each is written with its
    position, which ``read_report`` follows. ``root`` has to be shared by the driver and the executors.
    """
    if on_empty not in ("keep", "zero_row", "replace"):
        raise ValueError(f"unknown policy for an empty report: {on_empty}")
    spark = report.sparkSession
    folder = _Folder(spark, f"{root}/{name}")
    rows = normalise(report)
    version = uuid.uuid4().hex
    path = f"{root}/{name}/versions/{version}"
    try:
        if order:
            # sorted ranges of rows are numbered by range and place: the numbers rise through all files
            rows = rows.orderBy(*order).withColumn(_POSITION, F.monotonically_increasing_id())
        rows.write.parquet(path)
        count = spark.read.schema(rows.schema).parquet(path).count()
        if count == 0 and on_empty == "zero_row":
            zero_row(rows).write.mode("overwrite").parquet(path)
            count = 1
        if count == 0 and on_empty == "keep":
            folder.remove(f"versions/{version}")
            return 0
        folder.mark(version)
    except BaseException:
        folder.remove(f"versions/{version}")
        raise
    for marker in folder.markers()[:-keep_versions]:
        folder.remove(f"versions/{_version_of(marker)}")
        folder.remove(f"published/{marker}")
    return count


class _Folder:
    """A report's folder on whatever file system holds it: ``versions`` and the markers in ``published``."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = path
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())
        local = spark.conf.get("spark.master", "local").split("[")[0] == "local"
        if self._files.getScheme() == "file" and not local and not self._below(spark.conf.get("spark.checkpoint.dir", None)):
            raise ValueError(f"{path} is a folder of one machine; reports need one that all executors share")

    def _below(self, shared: str | None) -> bool:
        """Whether the folder lies in ``shared``: a mounted one, say, which has to be there for all executors."""
        if not shared:
            return False
        where = self._at("").toUri().normalize().getPath()
        root = self._jvm.org.apache.hadoop.fs.Path(shared).toUri()
        return root.getScheme() in (None, "file") and f"{where}/".startswith(root.normalize().getPath().rstrip("/") + "/")

    def _at(self, child: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{child}" if child else self._path)

    def markers(self) -> list[str]:
        """Names of the marker files, the newest one last."""
        published = self._at("published")
        if not self._files.exists(published):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(published))

    def mark(self, version: str) -> None:
        markers = self.markers()
        number = int(markers[-1].split("-")[0]) + 1 if markers else 1
        self._files.create(self._at(f"published/{number:012d}-{version}"), False).close()

    def remove(self, child: str) -> None:
        self._files.delete(self._at(child), True)


#: Where a row stands in a published report that has an order.
_POSITION = "row_position__"


def _version_of(marker: str) -> str:
    return marker.split("-", 1)[1]


def read_report(spark: SparkSession, name: str, root: str, format: str = "parquet") -> DataFrame:
    """The newest published version, its rows in the order they were published in, however many files hold them.

    A folder without versions is read as it lies there.
    """
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", "true")
    markers = _Folder(spark, f"{root}/{name}").markers()
    found = reader.load(f"{root}/{name}/versions/{_version_of(markers[-1])}" if markers else f"{root}/{name}")
    return found.orderBy(_POSITION).drop(_POSITION) if markers and _POSITION in found.columns else found


def measure_definitions(spark: SparkSession) -> DataFrame:
    """What each service-level measure means; a constant table."""
    return spark.createDataFrame(list(fixed.MEASURES), "service string, measure string")
