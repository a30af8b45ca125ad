"""JSON-lines audit log of loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.sources.tables import path_exists

# The ten fields of an audit event and its states.
AUDIT_SCHEMA = (
    "source_library string, source_table string, target_table string, layout string, source_year int, "
    "status string, rows_inserted bigint, started_at string, completed_at string, error_message string"
)
STARTED, COMPLETE, INTERRUPTED, FAILED, CLEARED = "started", "complete", "interrupted", "failed", "cleared"
CLEARABLE = (FAILED, INTERRUPTED, STARTED)
SOURCE_KEY = ("source_library", "source_table", "target_table")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All events; no log yet means no events, a broken line fails the read."""

    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).option("mode", "FAILFAST").json(path)


def event_order():
    """Log order: event time, and ``started`` before the event that ends it."""

    return F.struct(
        F.col("completed_at").cast("timestamp").alias("at"), (F.col("status") != STARTED).alias("ends")
    )


def latest_status(events: DataFrame, order=None) -> DataFrame:
    """Last status per source; combined before the shuffle."""

    return events.groupBy(*SOURCE_KEY).agg(
        F.max_by("status", event_order() if order is None else order).alias("status")
    )
