"""Minute-bar lines rendered from events, with planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import bars as B
from panelforge.plans.contracts import LAYOUTS
from panelforge.session import work_dir
from panelforge.sinks.bar_loads import check_folder, load_bars
from panelforge.sinks.layouts import write_layout
from panelforge.suite.common import Suite, Tables
from panelforge.suite.filing_queries import landed

suite = Suite()
ZONE = "America/New_York"
UTC_SYMBOLS = ("click",)

# Defect k is planted where event_id % modulus = remainder and no earlier one applies.
DEFECTS = (
    ("few", 17, 3), ("empty_ts", 19, 4), ("word", 23, 5), ("inf_volume", 29, 6), ("negative", 31, 7),
    ("blank", 37, 8), ("quoted", 41, 9), ("bad_ts", 43, 10), ("underscore", 47, 11),
)
DEFECT_SQL = (
    "CASE " + " ".join(f"WHEN event_id % {m} = {r} THEN '{name}'" for name, m, r in DEFECTS) + " ELSE 'none' END"
)


def bar_lines(t: Tables) -> DataFrame:
    """Lines of three supported files and one file with an unsupported name."""

    event = t("events")
    defect = F.lit("none")
    for name, modulus, remainder in reversed(DEFECTS):
        defect = F.when(F.col("event_id") % modulus == remainder, name).otherwise(defect)
    # Spread over a year so that both clock changes occur.
    stamp = F.date_trunc("second", F.col("ts")) + F.make_interval(days=(F.col("event_id") % 365).cast("int"))
    rows = event.select(
        "event_id",
        F.when(F.col("event_type") == "view", "view_1min.txt")
        .when(F.col("event_type") == "signup", "signup.txt")
        .otherwise(F.concat("event_type", F.lit("_full_1min_adj.txt"))).alias("file_name"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.col("value"),
        defect.alias("defect"),
    )
    d, v = F.col("defect"), F.col("value").cast("string")
    full = F.concat_ws(
        ",",
        F.when(d == "empty_ts", "").when(d == "bad_ts", "2024-13-45 00:00:00").otherwise(F.col("stamp")),
        F.when(d == "word", "abc").when(d == "underscore", "1_0").otherwise(v),
        F.when(d == "negative", F.concat(F.lit("-"), v)).otherwise(v),
        F.when(d == "quoted", '"1,5"').otherwise(v),
        F.concat(F.lit(" "), v),
        F.when(d == "inf_volume", "inf").otherwise(F.col("event_id").cast("string")),
    )
    line = F.when(d == "blank", "").when(d == "few", F.concat_ws(",", "stamp", v, v, v, v)).otherwise(full)
    return rows.select("file_name", (F.col("event_id") + 1).alias("line_number"), line.alias("line"))


def supported(t: Tables) -> DataFrame:
    lines = bar_lines(t)
    return lines.where(B.symbol_of(F.col("file_name")).isNotNull())


BARS_SQL = f"""
bars AS (
  SELECT event_id, value, {DEFECT_SQL} AS defect, upper(event_type) AS symbol,
         CASE WHEN event_type = 'view' THEN 'view_1min.txt' ELSE event_type || '_full_1min_adj.txt' END AS file_name,
         date_trunc('second', ts) + to_days(CAST(event_id % 365 AS INTEGER)) AS stamp
  FROM events WHERE event_type <> 'signup'
)"""

# 2024 clock changes in New York; the lost hour reads as winter time, the
# repeated hour as summer time.
UTC_SQL = """CASE WHEN symbol = 'CLICK' THEN stamp
  WHEN stamp < TIMESTAMP '2024-03-10 03:00:00' THEN stamp + INTERVAL 5 HOUR
  WHEN stamp < TIMESTAMP '2024-11-03 02:00:00' THEN stamp + INTERVAL 4 HOUR
  ELSE stamp + INTERVAL 5 HOUR END"""

BAD_SQL = "('few', 'empty_ts', 'word', 'inf_volume', 'blank', 'quoted', 'bad_ts')"


@suite.register(f"""WITH {BARS_SQL}
SELECT symbol, strftime({UTC_SQL}, '%Y-%m-%d %H:%M:%S') AS ts,
  CASE WHEN defect = 'underscore' THEN 10.0 ELSE value END AS open,
  CASE WHEN defect = 'negative' THEN -value ELSE value END AS high, value AS low, value AS close,
  CAST(event_id AS DOUBLE) AS volume
FROM bars WHERE defect NOT IN {BAD_SQL}""")
def bars_parse(t: Tables) -> DataFrame:
    good = B.good_bars(B.parse_bars(supported(t)), ZONE, UTC_SYMBOLS)
    return good.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


PLACE_SQL = "file_name || ':' || (event_id + 1)"


@suite.register(f"""WITH {BARS_SQL}
SELECT file_name, event_id + 1 AS line_number, CASE defect
    WHEN 'few' THEN {PLACE_SQL} || ' expected 6 columns, got 5'
    WHEN 'empty_ts' THEN {PLACE_SQL} || ' timestamp does not match YYYY-mm-dd HH:MM:SS: '
    WHEN 'bad_ts' THEN {PLACE_SQL} || ' timestamp does not match YYYY-mm-dd HH:MM:SS: 2024-13-45 00:00:00'
    WHEN 'word' THEN {PLACE_SQL} || ' open must be a numeric value, got abc'
    WHEN 'quoted' THEN {PLACE_SQL} || ' low must be a numeric value, got 1,5'
    WHEN 'inf_volume' THEN {PLACE_SQL} || ' volume must be a finite numeric value, got inf' END AS error
FROM bars WHERE defect IN {BAD_SQL} AND defect <> 'blank'""")
def bars_rejects(t: Tables) -> DataFrame:
    return B.rejects(B.parse_bars(supported(t))).select("file_name", "line_number", "error")


@suite.register(f"""WITH {BARS_SQL}
SELECT file_name, event_id + 1 AS line_number, 'high' AS column_name FROM bars WHERE defect = 'negative' AND value > 0""")
def bars_negative_warnings(t: Tables) -> DataFrame:
    return B.negative_warnings(B.parse_bars(supported(t)))


ISSUES_SQL = """
issues AS (
  SELECT file_name, event_id + 1 AS line_number,
    CASE defect WHEN 'few' THEN '' WHEN 'empty_ts' THEN 'timestamp' WHEN 'bad_ts' THEN 'timestamp' WHEN 'word' THEN 'open'
      WHEN 'quoted' THEN 'low' WHEN 'inf_volume' THEN 'volume' WHEN 'negative' THEN 'high' END AS column_name,
    CASE defect WHEN 'few' THEN 'wrong column count: expected 6, got 5' WHEN 'empty_ts' THEN 'empty'
      WHEN 'bad_ts' THEN 'unparseable timestamp' WHEN 'word' THEN 'non-numeric' WHEN 'quoted' THEN 'non-numeric'
      WHEN 'inf_volume' THEN 'non-finite' WHEN 'negative' THEN 'negative' END AS issue
  FROM bars WHERE defect NOT IN ('none', 'blank', 'underscore') AND NOT (defect = 'negative' AND value = 0)
)"""


@suite.register(f"WITH {BARS_SQL}, {ISSUES_SQL} SELECT * FROM issues")
def bars_issues(t: Tables) -> DataFrame:
    return B.line_issues(supported(t)).select("file_name", "line_number", "column_name", "issue")


@suite.register(f"""WITH {BARS_SQL}, {ISSUES_SQL}, files AS (
  SELECT DISTINCT file_name FROM bars UNION SELECT 'clean_1min.txt')
SELECT file_name, count(line_number) AS issue_count,
       CASE WHEN count(line_number) = 0 THEN 'OK' ELSE 'issues found' END AS status
FROM files LEFT JOIN issues USING (file_name) GROUP BY 1""")
def bars_file_report(t: Tables) -> DataFrame:
    lines = supported(t)
    # A file of good lines only: it must appear with zero issues.
    clean = lines.where(F.col("file_name") == "view_1min.txt").select(
        F.lit("clean_1min.txt").alias("file_name"), "line_number", F.lit("2024-01-02 09:30:00,1,1,1,1,1").alias("line")
    )
    everything = lines.unionByName(clean)
    return B.file_report(everything, B.line_issues(everything))


@suite.register(f"""WITH {BARS_SQL}
SELECT file_name, max(CASE WHEN defect = 'inf_volume' THEN CAST('infinity' AS DOUBLE) WHEN defect = 'blank' THEN NULL
    WHEN defect = 'few' THEN value ELSE CAST(event_id AS DOUBLE) END) AS max_last_field
FROM bars GROUP BY 1""")
def last_field_max(t: Tables) -> DataFrame:
    return B.last_field_max(supported(t))


@suite.register(f"""WITH {BARS_SQL}
SELECT strftime({UTC_SQL}, '%Y%m') AS month, symbol, count(*) AS bars, strftime(min({UTC_SQL}), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM bars WHERE defect NOT IN {BAD_SQL} GROUP BY 1, 2""")
def bars_layout_written(t: Tables) -> DataFrame:
    """Good bars written by month and sorted by symbol and time, then read back."""

    path = work_dir(t.spark, "bars")
    write_layout(B.good_bars(B.parse_bars(supported(t)), ZONE, UTC_SYMBOLS), path, LAYOUTS["bars"])
    stored = t.spark.read.schema("symbol string, ts timestamp_ntz, month string").parquet(path)
    return stored.groupBy("month", "symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts")
    )


# --- a folder of bar files from end to end: text files, load, rejects, report

LINES_PER_FILE = 2000
# Lines of a task that lands bar files: some 50 files.
LINES_PER_TASK = 100_000

FOLDER_SQL = f"""{BARS_SQL.strip()}, placed AS (
  SELECT b.*, event_type || (b.event_id // {LINES_PER_FILE}) || '_full_1min_adj.txt' AS file,
    upper(event_type) || (b.event_id // {LINES_PER_FILE}) AS part,
    row_number() OVER (PARTITION BY event_type, b.event_id // {LINES_PER_FILE} ORDER BY b.event_id) AS nth
  FROM bars b JOIN (SELECT event_id, event_type FROM events) e USING (event_id)
), utc AS (SELECT *, {UTC_SQL.replace("symbol = 'CLICK'", "FALSE")} AS ts FROM placed)"""


def bar_folder(t: Tables) -> str:
    """The bar lines as text files of a new folder, in the order of their events, written by the tasks."""

    event = t("events").select("event_id", "event_type")
    named = (
        supported(t).join(event, F.col("line_number") == F.col("event_id") + 1)
        .withColumn("file", F.concat("event_type", F.floor(F.col("event_id") / LINES_PER_FILE), F.lit("_full_1min_adj.txt")))
        .select("file", "event_id", "line")
    )
    tasks = max(t.spark.sparkContext.defaultParallelism, -(-event.count() // LINES_PER_TASK))
    return landed(t, named, "file", "line", order="event_id", tasks=tasks)


@suite.register(f"""WITH {FOLDER_SQL}
SELECT part AS symbol, strftime(ts, '%Y%m') AS month, count(*) AS bars, CAST(sum(event_id) AS DOUBLE) AS volume,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM utc WHERE defect NOT IN {BAD_SQL} GROUP BY 1, 2""")
def bars_folder_loaded(t: Tables) -> DataFrame:
    """Files of a folder read, parsed, converted to UTC, written by month and read back."""

    target = work_dir(t.spark, "bars-target")
    load_bars(t.spark, bar_folder(t), target, work_dir(t.spark, "bars-rejects"), ZONE)
    stored = t.spark.read.schema("symbol string, ts timestamp_ntz, volume double, month string").parquet(target)
    return stored.groupBy("symbol", "month").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"),
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
    )


@suite.register(f"""WITH {FOLDER_SQL}
SELECT file AS file_name, nth AS line_number, file || ':' || nth || CASE defect
    WHEN 'few' THEN ' expected 6 columns, got 5'
    WHEN 'empty_ts' THEN ' timestamp does not match YYYY-mm-dd HH:MM:SS: '
    WHEN 'bad_ts' THEN ' timestamp does not match YYYY-mm-dd HH:MM:SS: 2024-13-45 00:00:00'
    WHEN 'word' THEN ' open must be a numeric value, got abc'
    WHEN 'quoted' THEN ' low must be a numeric value, got 1,5'
    WHEN 'inf_volume' THEN ' volume must be a finite numeric value, got inf' END AS error
FROM placed WHERE defect IN {BAD_SQL} AND defect <> 'blank'""")
def bars_folder_rejects(t: Tables) -> DataFrame:
    """Rejected lines of a folder load with their line numbers, read back from the reject log."""

    rejects = work_dir(t.spark, "bars-rejects")
    load_bars(t.spark, bar_folder(t), work_dir(t.spark, "bars-target"), rejects, ZONE, clean_start=True)
    return t.spark.read.schema("file_name string, line_number bigint, error string").json(rejects)


@suite.register(f"""WITH {FOLDER_SQL}
SELECT file AS file_name, issue_count, CASE WHEN issue_count = 0 THEN 'OK' ELSE 'issues found' END AS status FROM (
  SELECT file, count(*) FILTER (WHERE defect NOT IN ('none', 'blank', 'underscore')
    AND NOT (defect = 'negative' AND value = 0)) AS issue_count FROM placed GROUP BY file)""")
def bars_folder_report(t: Tables) -> DataFrame:
    """Issues per raw file of a folder; files without any appear too."""

    report, _ = check_folder(t.spark, bar_folder(t))
    return report
