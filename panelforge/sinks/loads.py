"""Append-once loads with an audit trail, clean-up of failed loads, replace/resume loads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.digests import rows_fingerprint
from panelforge.operators.normalize import normalize_family, strict_rows
from panelforge.plans.contracts import LAYOUTS, target_ddl
from panelforge.plans.load_plan import PlannedTable, clearable_sources, pending_sources, plan_frame
from panelforge.sinks.layouts import layout_for, write_fingerprinted, write_layout
from panelforge.sources.audit_log import (
    AUDIT_SCHEMA, CLEARED, COMPLETE, FAILED, INTERRUPTED, STARTED, read_audit,
)
from panelforge.sources.tables import path_exists

# The fields of a yearly summary.
SUMMARY_SCHEMA = (
    "completed_at string, status string, source_library string, source_table string, target_table string, "
    "source_year int, rows_inserted bigint, target_row_count bigint, elapsed_seconds double, started_at string"
)


def first_line(error: BaseException) -> str:
    """First line of an error's text; its class name where it has none."""

    lines = str(error).splitlines()
    return lines[0] if lines else type(error).__name__


def _now() -> datetime:
    return datetime.now(UTC)


class Loader:
    """Loads planned sources into targets below one folder.

    ``root`` is a folder on the shared file system. Targets live in
    ``root/<target>``, the audit log in ``root/_audit``, yearly summaries in
    ``root/_year_summary``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.audit_path = f"{self.root}/_audit"
        self.summary_path = f"{self.root}/_year_summary"

    def target_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # -- targets ---------------------------------------------------------------

    def create_targets(self, plan: Iterable[PlannedTable]) -> list[str]:
        """Empty targets for a plan; existing ones stay as they are."""

        created = []
        for planned in plan:
            path = self.target_path(planned.target_table)
            if planned.target_table in created:
                continue
            if not path_exists(self.spark, path):
                empty = self.spark.createDataFrame(
                    [], target_ddl(planned.family, with_source_year=planned.year_slice is not None)
                )
                empty.write.option("compression", "zstd").parquet(f"{path}/_schema")
            created.append(planned.target_table)
        return created

    def read_target(self, planned: PlannedTable) -> DataFrame:
        """Rows of a target under its declared schema."""

        ddl = target_ddl(planned.family, with_source_year=planned.year_slice is not None)
        if LAYOUTS[planned.family].partition == "month":
            ddl += ", `month` string"
        return self.spark.read.schema(ddl).parquet(self.target_path(planned.target_table))

    def _slice(self, planned: PlannedTable) -> DataFrame:
        rows = self.read_target(planned)
        return rows if planned.year_slice is None else rows.where(F.col("source_year") == planned.year_slice)

    def require_empty(self, planned: PlannedTable) -> None:
        """Refuse a source whose target is missing or already holds its rows."""

        if not path_exists(self.spark, self.target_path(planned.target_table)):
            raise ValueError(f"{planned.target_table} is missing, so nothing was loaded; run create_targets")
        if not self._slice(planned).isEmpty():
            raise ValueError(
                f"{planned.target_table} holds rows of {planned.source_table}; clear them before loading them anew"
            )

    # -- audit -----------------------------------------------------------------

    def audit(self, planned: PlannedTable, rows: int, started: datetime, status: str, error: str = "") -> None:
        """Append one event to the log."""

        event = (
            planned.source_library, planned.source_table, planned.target_table, planned.layout, planned.source_year,
            status, rows, started.isoformat(), _now().isoformat(), error,
        )
        self.spark.createDataFrame([event], AUDIT_SCHEMA).coalesce(1).write.mode("append").json(self.audit_path)

    def events(self) -> DataFrame:
        return read_audit(self.spark, self.audit_path)

    def _summarize(self, planned: PlannedTable, rows: int, started: datetime) -> None:
        """Completion row of a yearly source; static tables have none."""

        if planned.source_year is None:
            return
        done = _now()
        row = (
            done.isoformat(), COMPLETE, planned.source_library, planned.source_table, planned.target_table,
            planned.source_year, rows, self._slice(planned).count(),
            round((done - started).total_seconds(), 3), started.isoformat(),
        )
        self.spark.createDataFrame([row], SUMMARY_SCHEMA).coalesce(1).write.mode("append").json(self.summary_path)

    def year_summary(self) -> DataFrame:
        if not path_exists(self.spark, self.summary_path):
            return self.spark.createDataFrame([], SUMMARY_SCHEMA)
        return self.spark.read.schema(SUMMARY_SCHEMA).json(self.summary_path)

    # -- loads -----------------------------------------------------------------

    def load_one(self, planned: PlannedTable, source: DataFrame) -> int:
        """Normalize and append one source; any bad value fails it before commit."""

        started = _now()
        self.audit(planned, 0, started, STARTED)
        try:
            rows = strict_rows(normalize_family(source, planned.family, planned.year_slice))
            loaded = write_layout(
                rows,
                self.target_path(planned.target_table),
                layout_for(planned.family, rows.columns),
                mode="append",
            )
        except KeyboardInterrupt:
            self.audit(planned, 0, started, INTERRUPTED, "KeyboardInterrupt")
            raise
        except Exception as error:
            self.audit(planned, 0, started, FAILED, first_line(error))
            raise
        self.audit(planned, loaded, started, COMPLETE)
        self._summarize(planned, loaded, started)
        return loaded

    def load(
        self, plan: Iterable[PlannedTable], read: Callable[[PlannedTable], DataFrame], resume: bool = True
    ) -> list[tuple[str, str, int]]:
        """Load a plan in order; complete sources are skipped, the first failure stops.

        Returns (source table, target table, rows loaded).
        """

        plan = list(plan)
        todo = {p.plan_position for p in plan}
        if resume:
            frame = pending_sources(plan_frame(self.spark, plan), self.events())
            todo = {r["plan_position"] for r in frame.select("plan_position").collect()}
        results = []
        for planned in plan:
            if planned.plan_position not in todo:
                results.append((planned.source_table, planned.target_table, 0))
                continue
            self.require_empty(planned)
            results.append((planned.source_table, planned.target_table, self.load_one(planned, read(planned))))
        return results

    def clear_failed(self, plan: Iterable[PlannedTable]) -> list[str]:
        """Empty the slice or table of every failed, interrupted or started source."""

        plan = list(plan)
        frame = clearable_sources(plan_frame(self.spark, plan), self.events())
        broken = {r["plan_position"] for r in frame.select("plan_position").collect()}
        cleared = []
        for planned in plan:
            if planned.plan_position not in broken:
                continue
            self._drop_rows(planned)
            self.audit(planned, 0, _now(), CLEARED)
            cleared.append(planned.target_table)
        return cleared

    def _drop_rows(self, planned: PlannedTable) -> None:
        """Remove one year's partition folder, or everything but the schema marker."""

        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        target = hadoop.Path(self.target_path(planned.target_table))
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if planned.year_slice is not None:
            fs.delete(hadoop.Path(target, f"source_year={planned.year_slice}"), True)
            return
        for status in fs.listStatus(target):
            if status.getPath().getName() != "_schema":
                fs.delete(status.getPath(), True)


# The fields of a record of what a target holds.
FINGERPRINT_SCHEMA = "table_name string, row_count bigint, fingerprint string, schema string, written_at string"


def _record(spark: SparkSession, root: str, name: str, df: DataFrame, rows: int, fingerprint: str) -> None:
    row = (name, rows, fingerprint, df.schema.simpleString(), _now().isoformat())
    spark.createDataFrame([row], FINGERPRINT_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/_fingerprints")


def recorded_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """The latest record of each target below ``root``: rows, fingerprint and schema as they were written."""

    path = f"{root.rstrip('/')}/_fingerprints"
    if not path_exists(spark, path):
        return spark.createDataFrame([], FINGERPRINT_SCHEMA)
    return (
        spark.read.schema(FINGERPRINT_SCHEMA).json(path).groupBy("table_name")
        .agg(F.max_by(F.struct("row_count", "fingerprint", "schema", "written_at"), "written_at").alias("r"))
        .select("table_name", "r.*")
    )


def load_file_tables(
    spark: SparkSession,
    plan: Iterable[tuple[str, DataFrame]],
    root: str,
    replace: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Load (table name, rows) pairs as whole tables and compare the counts.

    Every write leaves a record of the rows' fingerprint, taken in the pass that writes.
    ``resume`` skips a target that holds as many rows as its source and was written from the
    same ones, by fingerprint and schema; one of equal count but other content is
    ``reloaded``. A target without a record is fingerprinted itself. ``replace`` rebuilds
    targets (and turns ``resume`` off); otherwise a target with rows is refused.
    Result: table_name, source_rows, target_rows, status.
    """

    root = root.rstrip("/")
    known = {r["table_name"]: r for r in recorded_fingerprints(spark, root).collect()} if resume and not replace else {}
    results = []
    for name, df in plan:
        path, done = f"{root}/{name}", "loaded"
        if path_exists(spark, path) and not replace:
            target = spark.read.schema(df.schema).parquet(path)
            current = target.count()
            if resume:
                both = F.count(F.lit(1)).alias("rows"), rows_fingerprint(df.columns).alias("fingerprint")
                source = df.agg(*both).first()
                if current == source["rows"]:
                    record = known.get(name)
                    if record is not None and record["row_count"] == current:
                        same = (record["fingerprint"], record["schema"]) == (source["fingerprint"], df.schema.simpleString())
                    else:
                        same = target.agg(*both).first()["fingerprint"] == source["fingerprint"]
                    if same:
                        results.append((name, current, current, "skipped"))
                        continue
                    done = "reloaded"
            if current != 0 and done == "loaded":
                raise ValueError(f"{name} holds {current} rows and stays as it is; ask for replace to rebuild it")
        # The source runs once: its rows are counted on their way into the files.
        source_rows, fingerprint = write_fingerprinted(df, path, layout_for(name, df.columns), mode="overwrite")
        _record(spark, root, name, df, source_rows, fingerprint)
        target_rows = spark.read.schema(df.schema).parquet(path).count()
        results.append((name, source_rows, target_rows, done if target_rows == source_rows else "row-count-mismatch"))
    return spark.createDataFrame(
        results, "table_name string, source_rows bigint, target_rows bigint, status string"
    )


def create_empty_tables(
    spark: SparkSession, plan: Iterable[tuple[str, DataFrame]], root: str, replace: bool = False
) -> DataFrame:
    """Empty targets with the source schemas: ``created-empty`` or ``already-empty``."""

    results = []
    for name, df in plan:
        path = f"{root.rstrip('/')}/{name}"
        if path_exists(spark, path) and not replace:
            current = spark.read.schema(df.schema).parquet(path).limit(1).count()
            if current != 0:
                raise ValueError(f"{name} holds rows and stays as it is; ask for replace to empty it")
            results.append((name, "already-empty"))
            continue
        spark.createDataFrame([], df.schema).write.mode("overwrite").option("compression", "zstd").parquet(path)
        results.append((name, "created-empty"))
    return spark.createDataFrame(results, "table_name string, status string")
