"""Gives Spark's Python workers this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Rows of a Parquet batch, where the session does not say: a column of long texts is held whole.
BATCH_ROWS = 1024
#: Bytes that Spark hands to a Python worker at a time, where the session does not say: the number of
#: rows alone (10,000) bounds nothing when a row is a long text or a page.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one where Spark runs in this
    process alone, as in tests. Elsewhere the setting is required: a machine's own folder is not shared."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return "file://" + tempfile.mkdtemp(prefix="stratavox-")


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application, once, so that workers on any machine import it,
    and bound the Arrow and Parquet batches of sessions that do not bound them themselves."""
    for setting, bound in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", BATCH_ROWS)):
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(bound))
    context = spark.sparkContext
    if getattr(context, "_stratavox_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else it is being imported from the archive that was shipped
        name = os.path.join(tempfile.mkdtemp(prefix="stratavox-"), "stratavox.zip")
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, Path("stratavox") / p.relative_to(root))
        context.addPyFile(name)
    context._stratavox_shipped = True
