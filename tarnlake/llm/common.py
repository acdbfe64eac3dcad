"""Small helpers the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tarnlake.session import staged, tune, work_path

__all__ = ["WORD", "arrow_map", "row_key", "staged", "table", "work_path"]

WORD = r"[^\x20\x09-\x0D]+"
_PACKAGE = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package's code to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    code = Path(tempfile.mkdtemp(prefix="code-")) / "tarnlake-code.zip"
    with zipfile.ZipFile(code, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(_PACKAGE.parent))
    sc.addPyFile(str(code))
    _SHIPPED.add(sc.applicationId)


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`mapInArrow` with this package's code at hand.

    Rows may hold long texts, so batches must be small: Spark takes their size from the session when the plan is run, so a session that was
    not set up by `session.tune` is set up here.
    """
    ship(tune(df.sparkSession))
    return df.mapInArrow(f, schema)


def row_key() -> list[Column]:
    """What tells rows of a table apart: the id, and the text where ids repeat. Equal rows share a key."""
    return [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")]
