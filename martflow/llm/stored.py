"""Work copies whose shuffle files go as soon as they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martflow.sources.tables import materialize

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    Once the copy is complete, the shuffle files behind it are of no use; a
    sequence of copies then needs the disk of its largest step only.
    """
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        return materialize(df)
    finally:
        if before is None:
            conf.unset(FREE_SHUFFLES)
        else:
            conf.set(FREE_SHUFFLES, before)
