"""Task counts of jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def task_state_counts(reports: DataFrame) -> DataFrame:
    """(jobid, task_type, state, tasks)."""
    return reports.groupBy("jobid", "task_type", "state").agg(F.count(F.lit(1)).alias("tasks"))
