"""Row counts and null counts taken while a job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def observed(df: DataFrame, nulls_of: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """Attach counters to a frame; read them with ``.get`` after its action.

    This replaces separate count jobs, each of which would run the plan again.
    """
    watch = Observation()
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in nulls_of]
    return df.observe(watch, *counters), watch
