"""Arrow functions on executors that don't have this package installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def give_back() -> None:
    """Returns memory that is free again to the system: workers are reused, and what they keep adds to the next stage's."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = f"{tempfile.mkdtemp(prefix='orrery-')}/{os.path.basename(package)}-package.zip"  # stays: executors fetch it later
        with zipfile.ZipFile(archive, "w") as z:
            for top, _, names in os.walk(package):
                for n in names:
                    if n.endswith(".py"):
                        z.write(f"{top}/{n}", os.path.relpath(f"{top}/{n}", os.path.dirname(package)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow, with this package sent to the executors; each task gives its memory back."""
    ship(df.sparkSession)

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidied, schema)
