"""Loads, exports and audit state. Writing queries use a new shared folder per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators import normalize as N
from panelforge.plans import load_plan as P
from panelforge.plans.contracts import LAYOUTS, SOURCE_COLUMNS, Layout
from panelforge.session import land, work_dir
from panelforge.sinks import exports as E
from panelforge.sinks import loads as L
from panelforge.sinks.layouts import FILE_ROWS, file_report, layout_for, write_layout
from panelforge.sources.audit_log import latest_status
from panelforge.sources.tables import delete_path, discover_tables, entry_names, read_csv, rename_path, scan
from panelforge.suite.common import Suite, Tables, iso, number, spread
from panelforge.suite.load_check_queries import ANY_BAD, LINKS_SQL, PANEL_SQL, links, option_panel, raw_options

suite = Suite()

# --- audit state from the event log: one source per user, order by event id

STATUS = (("view", "complete"), ("click", "started"), ("error", "failed"), ("signup", "cleared"), ("purchase", "interrupted"))
STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STATUS) + " END"


def status_of(event_type: Column) -> Column:
    mapped = F.when(event_type == STATUS[0][0], STATUS[0][1])
    for name, status in STATUS[1:]:
        mapped = mapped.when(event_type == name, status)
    return mapped


def audit_events(t: Tables) -> DataFrame:
    return t("events").select(
        F.lit("optionm_all").alias("source_library"),
        F.concat(F.lit("src"), "user_id").alias("source_table"),
        F.concat(F.lit("tgt"), F.col("user_id") % 3).alias("target_table"),
        status_of(F.col("event_type")).alias("status"),
        "event_id",
    )


def plan_of_users(t: Tables) -> DataFrame:
    """A planned source per user, and one never-started source for each."""

    users = t("events").select("user_id").distinct()
    known = users.select(
        F.col("user_id").alias("plan_position"),
        F.lit("optionm_all").alias("source_library"),
        F.concat(F.lit("src"), "user_id").alias("source_table"),
        F.concat(F.lit("tgt"), F.col("user_id") % 3).alias("target_table"),
    )
    fresh = known.withColumn("plan_position", F.col("plan_position") + 1000000).withColumn(
        "source_table", F.concat(F.lit("new_"), "source_table")
    )
    return known.unionByName(fresh)


LATEST_SQL = f"""
latest AS (
  SELECT user_id, {STATUS_SQL} AS status FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
)"""


@suite.register(f"""WITH {LATEST_SQL} SELECT 'optionm_all' AS source_library, 'src' || user_id AS source_table,
  'tgt' || (user_id % 3) AS target_table, status FROM latest""")
def latest_source_status(t: Tables) -> DataFrame:
    return latest_status(audit_events(t), F.col("event_id"))


@suite.register(f"""WITH {LATEST_SQL}
SELECT user_id AS plan_position, 'src' || user_id AS source_table FROM latest WHERE status <> 'complete'
UNION ALL SELECT user_id + 1000000, 'new_src' || user_id FROM latest""")
def pending_sources(t: Tables) -> DataFrame:
    return P.pending_sources(plan_of_users(t), audit_events(t), F.col("event_id")).select("plan_position", "source_table")


@suite.register(f"""WITH {LATEST_SQL}
SELECT user_id AS plan_position, 'src' || user_id AS source_table, status FROM latest
WHERE status IN ('failed', 'interrupted', 'started')""")
def clearable_sources(t: Tables) -> DataFrame:
    return P.clearable_sources(plan_of_users(t), audit_events(t), F.col("event_id")).select(
        "plan_position", "source_table", "status"
    )


# --- layouts: option tables by month, reference tables sorted by their keys

@suite.register(f"""WITH {PANEL_SQL}
SELECT coalesce(strftime(date, '%Y%m'), '197001') AS month, count(*) AS "rows", min(secid) AS first_secid,
       max(optionid) AS last_optionid, CAST(sum(volume) AS BIGINT) AS volume FROM panel GROUP BY 1""")
def option_layout_written(t: Tables) -> DataFrame:
    """The option panel partitioned by month and sorted by contract, read back by month."""

    path = work_dir(t.spark, "options")
    panel = option_panel(t).drop("source_year")
    write_layout(panel, path, LAYOUTS["opprcd"])
    stored = t.spark.read.schema(panel.schema.add("month", "string")).parquet(path)
    return stored.groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.min("secid").alias("first_secid"), F.max("optionid").alias("last_optionid"),
        F.sum("volume").alias("volume"),
    )


@suite.register(f"""WITH {LINKS_SQL}
SELECT count(*) AS "rows", count(permno) AS permnos, CAST(sum(secid) AS BIGINT) AS secids, CAST(0 AS BIGINT) AS unsorted FROM links""")
def link_layout_written(t: Tables) -> DataFrame:
    """Links written in key order; counts neighbours in a file that are out of order."""

    path = work_dir(t.spark, "links")
    write_layout(links(t), path, LAYOUTS["opcrsphist"])
    stored = t.spark.read.schema("secid bigint, sdate date, edate date, permno bigint, score double").parquet(path)
    unsorted = file_report(stored, LAYOUTS["opcrsphist"]).agg(F.sum("unsorted").alias("unsorted"))
    return stored.agg(
        F.count(F.lit(1)).alias("rows"), F.count("permno").alias("permnos"), F.sum("secid").alias("secids")
    ).select("*", unsorted.scalar().alias("unsorted"))


@suite.register(f"""
SELECT CASE WHEN l_orderkey % 107 = 0 THEN '197001' ELSE strftime(l_shipdate, '%Y%m') END AS month, count(*) AS "rows",
       CAST(sum(l_quantity) AS BIGINT) AS volume, CAST(sum(l_orderkey) AS BIGINT) AS optionids
FROM lineitem WHERE NOT ({ANY_BAD}) GROUP BY 1""")
def option_panel_loaded(t: Tables) -> DataFrame:
    """Raw option rows normalized, written by month in contract order, read back by month.

    The load path from end to end: checks, casts, fixed point, shuffle by month,
    sort, compressed write. The raw rows are landed first, over several files,
    as a source table would be.
    """

    path = work_dir(t.spark, "option-load")
    # Line items are dealt out, not the raw rows, which are several times as wide.
    raw = land(raw_options(t, spread(t("lineitem"))), "option-source")
    rows = N.valid_rows(N.normalize_family(raw, "opprcd"))
    write_layout(rows, path, LAYOUTS["opprcd"])
    loaded = t.spark.read.schema(rows.schema.add("month", "string")).parquet(path)
    return loaded.groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"),
        F.sum(F.col("optionid").cast("bigint")).alias("optionids"),
    )


# --- append-once load of yearly price tables with audit trail

def shipping_years(t: Tables) -> list[int]:
    """The years that occur in the line items; a few values."""

    found = t("lineitem").select(F.year("l_shipdate").alias("y")).distinct()
    return sorted(r["y"] for r in found.collect() if r["y"] is not None)


def price_source(t: Tables, year: int, broken: bool = False) -> DataFrame:
    """One year of raw underlying prices from the line items shipped that year."""

    volume = F.col("l_quantity")
    if broken:
        volume = volume + F.lit(0.5)
    return t("lineitem").where(F.year("l_shipdate") == year).select(
        F.col("l_partkey").alias("secid"), iso("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("low"), F.col("l_extendedprice").alias("high"),
        F.col("l_extendedprice").alias("close"), volume.alias("volume"), F.col("l_discount").alias("return"),
        F.lit(1.0).alias("cfadj"), F.col("l_extendedprice").alias("open"), F.lit(1.0).alias("cfret"),
        F.lit(100.0).alias("shrout"),
    )


LOADED_SQL = """
SELECT CAST(year(l_shipdate) AS BIGINT) AS source_year, count(*) AS rows_inserted, count(*) AS target_row_count,
       'complete' AS status FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1"""


@suite.register(LOADED_SQL)
def append_once_load(t: Tables) -> DataFrame:
    """All years loaded once; a second run finds every source complete."""

    loader = L.Loader(t.spark, work_dir(t.spark, "load"))
    plan = P.build_plan(price_years=shipping_years(t))
    loader.create_targets(plan)
    loader.load(plan, lambda p: price_source(t, p.source_year))
    loader.load(plan, lambda p: price_source(t, p.source_year))
    return loader.year_summary().select(
        number("source_year").alias("source_year"), "rows_inserted", "target_row_count", "status"
    )


@suite.register("""
SELECT status, count(*) AS events, CAST(sum(n) AS BIGINT) AS rows_inserted FROM (
  SELECT 'complete' AS status, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY year(l_shipdate)
  UNION ALL SELECT 'started', 0 FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY year(l_shipdate)
  UNION ALL SELECT 'started', 0
  UNION ALL SELECT 'failed', 0 UNION ALL SELECT 'cleared', 0) GROUP BY 1""")
def failed_load_cleared(t: Tables) -> DataFrame:
    """A bad source stops the load, is cleared, and the rest follows on the next run."""

    years = shipping_years(t)
    broken_year = years[len(years) // 2]
    loader = L.Loader(t.spark, work_dir(t.spark, "load"))
    plan = P.build_plan(price_years=years)
    loader.create_targets(plan)
    try:
        loader.load(plan, lambda p: price_source(t, p.source_year, broken=p.source_year == broken_year))
    except Exception:  # the planted fractional volume
        loader.clear_failed(plan)
    loader.load(plan, lambda p: price_source(t, p.source_year))
    return loader.events().groupBy("status").agg(
        F.count(F.lit(1)).alias("events"), F.sum("rows_inserted").alias("rows_inserted")
    )


# --- static reference tables, each through its own contract, rules and layout

STATIC = tuple(("optionm_all", name, name) for name in ("securd", "secnmd", "exchgd", "distrd", "opinfd", "opcrsphist"))


def reference_source(t: Tables, table: str) -> DataFrame:
    """Raw rows of one reference table; columns without a stand-in are NULL."""

    day = iso("o_orderdate")
    known = {
        "securd": lambda: t("supplier").select(
            F.col("s_suppkey").cast("double").alias("secid"), F.col("s_name").alias("issue_type"),
            F.col("s_acctbal").alias("industry_group"),
        ),
        "secnmd": lambda: t("part").select(
            F.col("p_partkey").alias("secid"), F.lit("1996-01-04").alias("effect_date"), F.col("p_name").alias("issuer")
        ),
        "exchgd": lambda: t("nation").select(
            F.col("n_nationkey").alias("secid"), F.col("n_regionkey").alias("seq_num"), F.col("n_name").alias("status")
        ),
        "distrd": lambda: t("orders").select(
            F.col("o_custkey").alias("secid"), day.alias("record_date"), F.col("o_orderkey").alias("seq_num"),
            F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("distr_type"),
        ),
        "opinfd": lambda: t("customer").select(
            F.col("c_custkey").alias("secid"), F.col("c_mktsegment").alias("exercise_style")
        ),
        "opcrsphist": lambda: links(t),
    }
    rows = known[table]()
    return rows.select(
        *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS[table]]
    )


@suite.register(f"""WITH {LINKS_SQL}
SELECT 'securd' AS target_table, count(*) AS rows_loaded, CAST(sum(s_suppkey) AS BIGINT) AS secids FROM supplier
UNION ALL SELECT 'secnmd', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
UNION ALL SELECT 'exchgd', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation
UNION ALL SELECT 'distrd', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders
UNION ALL SELECT 'opinfd', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'opcrsphist', count(*), CAST(sum(secid) AS BIGINT) FROM links""")
def reference_tables_loaded(t: Tables) -> DataFrame:
    loader = L.Loader(t.spark, work_dir(t.spark, "reference"))
    plan = P.build_plan(static_tables=STATIC)
    loader.create_targets(plan)
    loaded = loader.load(plan, lambda p: reference_source(t, p.source_table))
    counted = None
    for planned, (_, target, rows) in zip(plan, loaded):
        one = loader.read_target(planned).agg(F.sum("secid").alias("secids")).select(
            F.lit(target).alias("target_table"), F.lit(rows).cast("bigint").alias("rows_loaded"), "secids"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


# --- whole-table exports, discovery, reloads

EXPORTED = ("orders", "customer", "part")


@suite.register(
    " UNION ALL ".join(f"SELECT 'tpch__{n}' AS table_name, count(*) AS row_count FROM {n}" for n in EXPORTED)
    + " UNION ALL SELECT 'tpch__void', 0"
)
def export_and_discover(t: Tables) -> DataFrame:
    """Tables exported, exported again with resume (skipped), then found with their counts."""

    folder = work_dir(t.spark, "export")
    for name in EXPORTED:
        E.export_table(t(name), folder, "tpch", name, preview_rows=5)
        E.export_table(t(name).limit(0), folder, "tpch", name, resume=True)
    E.export_table(t("region").where(F.lit(False)), folder, "tpch", "void")
    return discover_tables(t.spark, folder)


@suite.register("""
SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'skipped' AS status FROM orders
UNION ALL SELECT 'customer', count(*), count(*), 'loaded' FROM customer""")
def replace_and_resume(t: Tables) -> DataFrame:
    """A matching target is skipped under resume; a created empty one is filled."""

    root = work_dir(t.spark, "tables")
    L.load_file_tables(t.spark, [("orders", t("orders"))], root)
    L.create_empty_tables(t.spark, [("customer", t("customer"))], root)
    return L.load_file_tables(t.spark, [("orders", t("orders")), ("customer", t("customer"))], root, resume=True)


@suite.register("""
SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'reloaded' AS status,
  CAST(sum(o_custkey + CASE WHEN o_orderkey % 1000 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS content FROM orders
UNION ALL SELECT 'customer', count(*), count(*), 'skipped', CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'part', count(*), count(*), 'skipped', CAST(sum(p_partkey) AS BIGINT) FROM part""")
def changed_source_reloaded(t: Tables) -> DataFrame:
    """Sources of unchanged size under resume: one changed in a few values, one in other order, one as it was."""

    root = work_dir(t.spark, "tables")
    orders = t("orders")
    bumped = F.col("o_custkey") + (F.col("o_orderkey") % 1000 == 0).cast("bigint")
    changed = orders.withColumn("o_custkey", bumped.cast(orders.schema["o_custkey"].dataType))
    L.load_file_tables(t.spark, [("orders", orders), ("customer", t("customer")), ("part", t("part"))], root)
    shuffled = t("customer").repartition(3, "c_nationkey")
    plan = [("orders", changed), ("customer", shuffled), ("part", t("part"))]
    results = L.load_file_tables(t.spark, plan, root, resume=True)
    sums = None
    for (name, df), column in zip(plan, ("o_custkey", "c_custkey", "p_partkey")):
        one = t.spark.read.schema(df.schema).parquet(f"{root}/{name}").agg(F.sum(column).cast("bigint").alias("content"))
        one = one.select(F.lit(name).alias("table_name"), "content")
        sums = one if sums is None else sums.unionByName(one)
    return results.join(sums, "table_name")


@suite.register("""
SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'loaded' AS status FROM orders
UNION ALL SELECT 'nation', count(*), count(*), 'loaded' FROM nation WHERE n_nationkey % 2 = 0""")
def replaced_tables(t: Tables) -> DataFrame:
    """Targets that hold other rows, rebuilt under replace; the counts are those of the new rows."""

    root = work_dir(t.spark, "tables")
    half = t("nation").where(F.col("n_nationkey") % 2 == 0)
    L.load_file_tables(t.spark, [("orders", t("orders").where(F.col("o_orderkey") % 3 == 0)), ("nation", t("nation"))], root)
    return L.load_file_tables(t.spark, [("orders", t("orders")), ("nation", half)], root, replace=True, resume=True)


LISTED = ("lineitem", "supplier", "nation", "region")


@suite.register(
    " UNION ALL ".join(f"SELECT 'tpch' AS library, '{n}' AS table_name, count(*) AS row_count FROM {n} HAVING count(*) > 0" for n in LISTED)
)
def export_worklist(t: Tables) -> DataFrame:
    """Selected tables that hold rows, less the finished outputs; an output with a broken part file is not finished."""

    folder = work_dir(t.spark, "export")
    for name in (*EXPORTED, "nation"):
        E.export_table(t(name), folder, "tpch", name)
    broken = E.output_path(folder, "tpch", "nation")
    for part in entry_names(t.spark, broken):
        if part.startswith("part-"):
            delete_path(t.spark, f"{broken}/{part}")
    # Text under the name of a part file.
    staged = work_dir(t.spark, "not-parquet")
    t("nation").select("n_name").coalesce(1).write.text(staged)
    text = next(n for n in entry_names(t.spark, staged) if n.startswith("part-"))
    rename_path(t.spark, f"{staged}/{text}", f"{broken}/part-00000.parquet")
    selected = None
    for name in (*LISTED, *EXPORTED):
        one = t(name).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")
        one = one.select(F.lit("tpch").alias("library"), F.lit(name).alias("table_name"), "row_count")
        selected = one if selected is None else selected.unionByName(one)
    return E.export_worklist(selected, E.completed_outputs(t.spark, folder))


@suite.register("SELECT 'part' AS table_name, count(*) AS row_count FROM part UNION ALL SELECT 'lines', count(*) FROM lineitem")
def partitioned_outputs_counted(t: Tables) -> DataFrame:
    """Outputs with partition folders are found by their own names, with all their rows."""

    folder = work_dir(t.spark, "outputs")
    t("part").write.partitionBy("p_size").parquet(f"{folder}/part.parquet")
    flags = ("l_returnflag", "l_linestatus")
    t("lineitem").select("l_orderkey", *flags).write.partitionBy(*flags).parquet(f"{folder}/lines.parquet")
    return discover_tables(t.spark, folder)


@suite.register("""
SELECT 'sample' AS origin, n_nationkey AS k, n_name AS name FROM nation
UNION ALL SELECT 'preview', r_regionkey, r_name FROM region
UNION ALL SELECT 'catalog', p_partkey, p_name FROM part""")
def csv_round_trip(t: Tables) -> DataFrame:
    """Sample files, an export's preview and a catalog file, written as CSV and read back with a declared schema."""

    folder = work_dir(t.spark, "csv")
    tables = [("tpch", "nation", t("nation").select("n_nationkey", "n_name"))]
    sample = E.export_samples(t.spark, tables, folder, rows=100)[0]
    regions = t("region").select("r_regionkey", "r_name")
    E.export_table(regions, folder, "tpch", "region", preview_rows=100)
    E.write_csv(t("part").select("p_partkey", "p_name"), f"{folder}/catalog.csv")
    found = [
        ("sample", read_csv(t.spark, sample, "n_nationkey bigint, n_name string")),
        ("preview", read_csv(t.spark, f"{folder}/tpch__region__sample.csv", "r_regionkey bigint, r_name string")),
        ("catalog", read_csv(t.spark, f"{folder}/catalog.csv", "p_partkey bigint, p_name string")),
    ]
    parts = [df.toDF("k", "name").select(F.lit(origin).alias("origin"), "k", "name") for origin, df in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def layout_tables(t: Tables) -> dict[str, DataFrame]:
    """Rows for every layout; ``roles`` has none of its own, its id and date columns are found by their names."""

    key, day, ship = F.col("o_orderkey"), F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    tables = {
        "roles": t("orders").select(key.alias("note"), day.alias("startdate"), F.col("o_custkey").alias("companyid")),
        "opprcd": t("orders").select(
            F.col("o_custkey").alias("secid"), day.alias("date"), F.date_add(day, 30).alias("exdate"),
            F.left("o_orderpriority", F.lit(1)).alias("cp_flag"), F.col("o_totalprice").alias("strike_price"), key.alias("optionid"),
        ),
        "secprd": t("lineitem").select(
            F.col("l_partkey").alias("secid"), ship.alias("date"), F.col("l_extendedprice").alias("close"), F.year(ship).alias("source_year"),
        ),
        "bars": t("lineitem").select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), ship.cast("timestamp_ntz").alias("ts"),
            F.col("l_quantity").alias("volume"),
        ),
    }
    for name in ("securd", "secnmd", "exchgd", "distrd", "opinfd", "opcrsphist"):
        raw = reference_source(t, name)
        tables[name] = raw.select(
            *[F.col(c).cast("date") if c.endswith("date") else F.col(c).cast("bigint") if c == "secid" else F.col(c) for c in raw.columns]
        )
    return tables


def stored_layout(t: Tables, name: str, df: DataFrame, file_rows: int) -> tuple[DataFrame, Layout]:
    path, layout = work_dir(t.spark, name), layout_for(name, df.columns)
    write_layout(df, path, layout, file_rows=file_rows)
    schema = df.schema.add("month", "string") if layout.partition == "month" else df.schema
    return t.spark.read.schema(schema).parquet(path), layout


@suite.register(f"""WITH {LINKS_SQL}
SELECT 'roles' AS table_name, count(*) AS "rows", CAST(0 AS BIGINT) AS unsorted FROM orders
UNION ALL SELECT 'opprcd', count(*), 0 FROM orders UNION ALL SELECT 'secprd', count(*), 0 FROM lineitem
UNION ALL SELECT 'bars', count(*), 0 FROM lineitem UNION ALL SELECT 'securd', count(*), 0 FROM supplier
UNION ALL SELECT 'secnmd', count(*), 0 FROM part UNION ALL SELECT 'exchgd', count(*), 0 FROM nation
UNION ALL SELECT 'distrd', count(*), 0 FROM orders UNION ALL SELECT 'opinfd', count(*), 0 FROM customer
UNION ALL SELECT 'opcrsphist', count(*), 0 FROM links""")
def sort_keys_kept_in_files(t: Tables) -> DataFrame:
    """Neighbours within a file that are out of order by the full sort key: none in any layout."""

    found = None
    for name, df in layout_tables(t).items():
        report = file_report(*stored_layout(t, name, df, FILE_ROWS))
        counted = report.agg(F.lit(name).alias("table_name"), F.sum("rows").alias("rows"), F.sum("unsorted").alias("unsorted"))
        counted = counted.select("table_name", "rows", "unsorted")
        found = counted if found is None else found.unionByName(counted)
    return found


@suite.register("""
SELECT 'opprcd' AS table_name, coalesce(strftime(CAST(o_orderdate AS DATE), '%Y%m'), '197001') AS value, count(*) AS "rows",
  min(o_custkey) AS first, max(o_custkey) AS last, true AS files_as_planned, CAST(0 AS BIGINT) AS overlapping, CAST(0 AS BIGINT) AS unsorted
FROM orders GROUP BY 2
UNION ALL
SELECT 'secprd', CAST(year(l_shipdate) AS VARCHAR), count(*), min(l_partkey), max(l_partkey), true, 0, 0 FROM lineitem GROUP BY 2
UNION ALL
SELECT 'bars', coalesce(strftime(l_shipdate, '%Y%m'), '197001'), count(*), min(l_suppkey), max(l_suppkey), true, 0, 0
FROM lineitem GROUP BY 2""")
def key_ranges_disjoint(t: Tables) -> DataFrame:
    """Files of a month or year, cut small: how many there are, their key ranges, overlaps, neighbours out of order."""

    found = None
    for name in ("opprcd", "secprd", "bars"):
        df = layout_tables(t)[name]
        rows = max(4, -(-df.count() // 150))  # about 150 files beside the last one of each month
        stored, layout = stored_layout(t, name, df, rows)
        number = F.substring("lead", 2, 20).cast("bigint") if name == "bars" else F.col("lead")
        keys = stored.select(F.col(layout.partition).cast("string").alias("value"), F.col(layout.sort_keys[0]).alias("lead"))
        span = keys.groupBy("value").agg(F.min(number).alias("first"), F.max(number).alias("last"))
        files = file_report(stored, layout).groupBy(F.col("value").cast("string").alias("value")).agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.count_if("overlaps").alias("overlapping"),
            F.sum("unsorted").alias("unsorted"),
        )
        planned = F.ceil(F.col("rows") / rows)  # quantiles are approximate, equal keys stay together
        as_planned = (F.col("files") >= F.floor(planned / 2)) & (F.col("files") <= 2 * planned)
        counted = files.join(span, "value").select(
            F.lit(name).alias("table_name"), "value", "rows", "first", "last",
            as_planned.alias("files_as_planned"), "overlapping", "unsorted",
        )
        found = counted if found is None else found.unionByName(counted)
    return found


@suite.register("SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem")
def named_column_scan(t: Tables) -> DataFrame:
    return scan(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_shipdate"])
