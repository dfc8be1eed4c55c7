"""Shared folders, schemas and batches for the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy pass over a batch holds at most (a longer text is a pass of its own).
CHUNK_BYTES = 1 << 20
_shipped: set[str] = set()
_BATCH_LIMIT, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", f"{1 << 26}b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where the setting is missing (tests on one machine) the session gets a temporary folder; on a
    cluster that would lose data, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillwatch-"))
    return context._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of the shared folder and read again: its lineage ends there.

    A lost executor costs nothing that was written. Each call takes a folder of its own, so runs never
    meet; the folder goes with the checkpoint folder, which the caller owns.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: they may not have it installed.

    Also lowers the session's limit of bytes per Arrow batch, for a worker holds a batch and what it makes of it.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_LIMIT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_LIMIT, "8m")
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="tillwatch-")) / f"{root.name}-package.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for path in [root / "__init__.py", *(root / "llm").glob("*.py")]:
                archive.write(path, f"{root.name}/{path.relative_to(root)}")
        context.addPyFile(str(target))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the number as text, modulo ``divisor``; null ids count as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor)), F.lit(0)).cast("int")


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``taken`` (any letter case) has the name."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = "_" + wanted
    return wanted


def struct_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def give_back() -> None:
    """Returns freed memory to the system: a worker lives as long as its executor, and the C library keeps what arrays used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def lean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches; what was used for one goes back to the system before the next."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def pieces(batches: Iterator[pd.DataFrame], column: str, limit: int = CHUNK_BYTES,
           lower: bool = False) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Slices of the batches with the UTF-8 bytes of ``column``, of about ``limit`` bytes (null: empty).

    ``lower`` lowers all letters first, not only those of ASCII.
    """
    for batch in lean(batches):
        texts, start, held = [], 0, 0
        for n, text in enumerate(batch[column]):
            text = text if isinstance(text, str) else ""
            data = (text.lower() if lower else text).encode("utf-8", "surrogatepass")
            texts.append(data)
            held += len(data) + 16
            if held >= limit:
                yield batch.iloc[start:n + 1], texts
                texts, start, held = [], n + 1, 0
        if texts:
            yield batch.iloc[start:], texts


def spans_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    return F.array_join(F.transform(in_order, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
