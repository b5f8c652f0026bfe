"""Small helpers around the Spark session."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows of a table of users or items up to which a copy goes to every executor, through the driver.
LISTED = 300_000
# Spark removes the shuffle files of a query that is planned under this setting when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="shelfrank-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    from uuid import uuid4

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder, so losing an
    executor never forces the loop that made them to run again.

    The shuffles that made them have no reader left then, so their files go at once and not when the driver
    happens to collect its garbage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        # A plan of its own: ``df`` may run again, with shuffles that stay.
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join with a table of users or items, broadcast only if it is counted short.

    Spark's own estimate for it is that of the compressed columns, which can be a twentieth of the rows.
    """
    return left.join(F.broadcast(right) if right.count() <= LISTED else right.hint("merge"), on)
