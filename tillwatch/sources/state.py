"""State between polls: what earlier polls have summed up, replaced as a whole.

A state is a folder of versions like a published report, with its cells as they are. A version holds its rows and, in a
small file, what the rows stand for (``about``); an empty marker file makes both the current ones at once. A poll that fails
leaves the old version, and the next one starts from there. Of two polls at the same time the later marker counts.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillwatch.sources.reports import _Folder, _version_of


@dataclass(frozen=True)
class State:
    """The state ``name`` below ``root``, a folder that the driver and the executors share."""

    spark: SparkSession
    root: str
    name: str

    @property
    def _path(self) -> str:
        return f"{self.root}/{self.name}"

    def read(self) -> tuple[DataFrame, dict] | None:
        """The current rows and what they stand for; none before the first poll."""
        markers = _Folder(self.spark, self._path).markers()
        if not markers:
            return None
        version = f"{self._path}/versions/{_version_of(markers[-1])}"
        about = json.loads(self.spark.read.text(f"{version}/about").first()["value"])
        return self.spark.read.parquet(f"{version}/rows"), about

    def replace(self, rows: DataFrame, about: dict, keep_versions: int = 2) -> DataFrame:
        """Writes a new version and returns its rows. Older versions than the newest ``keep_versions`` go afterwards."""
        folder, version = _Folder(self.spark, self._path), uuid.uuid4().hex
        path = f"{self._path}/versions/{version}"
        try:
            rows.write.parquet(f"{path}/rows")
            self.spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/about")
            folder.mark(version)
        except BaseException:
            folder.remove(f"versions/{version}")
            raise
        for marker in folder.markers()[:-keep_versions]:
            folder.remove(f"versions/{_version_of(marker)}")
            folder.remove(f"published/{marker}")
        return self.spark.read.parquet(f"{path}/rows")


def work_folder(spark: SparkSession) -> str:
    """A folder of its own below ``spark.checkpoint.dir``; on one machine, where that is not set, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tillwatch-")
    return f"{folder.rstrip('/')}/work-{uuid.uuid4().hex}"
