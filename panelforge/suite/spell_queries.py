"""Relationship checks on role spells built from orders and line items.

Person = customer, organisation = part. A spell starts at the order date and
runs 90 days per line number, or is open. Edges connect a person with the first
person of the same organisation (or an organisation with the first organisation
of the same person), so their number grows with the table and not with its
square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import spells as S
from panelforge.session import land
from panelforge.suite.common import Suite, Tables, number

suite = Suite()
AS_OF = "2024-06-30"
YEARS = ("overlapyearstart", "overlapyearend")

EMP_SQL = f"""
emp AS (
  SELECT o_custkey AS person, l_partkey AS organisation, l_suppkey AS school, l_linenumber AS line,
         l_returnflag AS flag, o_orderpriority AS rolename, CAST(l_shipdate AS DATE) AS shipped,
         CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS s,
         CASE WHEN l_returnflag = 'N' THEN NULL
              ELSE CAST(o_orderdate AS DATE) + CAST(90 * l_linenumber AS INTEGER) END AS e
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
), emp_closed AS (
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}') AS e, flag FROM emp
)"""

ORG_HUB_SQL = """
org_hub AS (
  SELECT organisation, person AS hub FROM (
    SELECT organisation, person, row_number() OVER (PARTITION BY organisation ORDER BY s, person) AS rn
    FROM emp WHERE s IS NOT NULL) WHERE rn = 1
)"""

PERSON_HUB_SQL = """
person_hub AS (
  SELECT person, organisation AS hub FROM (
    SELECT person, organisation, row_number() OVER (PARTITION BY person ORDER BY s, organisation) AS rn
    FROM emp WHERE s IS NOT NULL) WHERE rn = 1
)"""

SHIFT_SQL = """coalesce(year(s), 1998) + CASE WHEN line = 7 THEN 30 WHEN line = 5 THEN -40 ELSE 0 END"""


def emp(t: Tables) -> DataFrame:
    """Employment spells, joined once per query and stored for the edges, hubs and profiles made of them."""

    return land(_emp(t), "employment")


def _emp(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    return t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person"),
        F.col("l_partkey").alias("organisation"),
        F.col("l_suppkey").alias("school"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
        F.col("o_orderpriority").alias("rolename"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.when(~((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R")), day).alias("s"),
        F.when(F.col("l_returnflag") != "N", F.date_add(day, F.col("l_linenumber") * 90)).alias("e"),
    )


def other_activities(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    return t("events").select(
        F.col("user_id").alias("person"),
        (F.col("event_id") % 500).alias("organisation"),
        "event_id",
        "event_type",
        day.alias("s"),
        F.when(F.col("event_type") != "view", F.date_add(day, 30)).alias("e"),
    )


OTHER_SQL = """
other AS (
  SELECT user_id AS person, event_id % 500 AS organisation, event_id, event_type, CAST(ts AS DATE) AS s,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) + 30 END AS e
  FROM events
)"""


def spells_of(df: DataFrame, src: str) -> DataFrame:
    return S.role_spells(df, "person", "organisation", "s", "e", src, AS_OF)


def hub(df: DataFrame, group: str, member: str) -> DataFrame:
    """First member of each group, combined before the shuffle."""

    first = F.min(F.struct("s", member)).alias("f")
    return df.where(F.col("s").isNotNull()).groupBy(group).agg(first).select(
        F.col(group).alias("_group"), F.col(f"f.{member}").alias("hub")
    )


def first_year():
    return F.coalesce(F.year("s"), F.lit(1998)) + F.when(F.col("line") == 7, 30).when(F.col("line") == 5, -40).otherwise(0)


def person_edges(t: Tables) -> DataFrame:
    e = emp(t)
    return (
        e.join(hub(e, "organisation", "person"), F.col("organisation") == F.col("_group"), "left")
        .select(
            F.col("hub").alias("dirbrdid"),
            F.col("person").alias("directorid"),
            F.col("organisation").alias("companyid"),
            first_year().alias("overlapyearstart"),
            (first_year() + 1).alias("overlapyearend"),
        )
    )


PERSON_EDGES_SQL = f"""
edges AS (
  SELECT hub AS dirbrdid, person AS directorid, organisation AS companyid,
         {SHIFT_SQL} AS overlapyearstart, {SHIFT_SQL} + 1 AS overlapyearend
  FROM emp LEFT JOIN org_hub USING (organisation)
)"""

PERSON_FLAGS_SQL = f"""
flagged AS (
  SELECT x.*, EXISTS (
    SELECT 1 FROM emp_closed a JOIN emp_closed b
      ON a.organisation = b.organisation AND a.person <> b.person
    WHERE a.person = x.dirbrdid AND b.person = x.directorid AND a.organisation = x.companyid
      AND year(greatest(a.s, b.s)) <= x.overlapyearend
      AND year(least(a.e, b.e)) >= x.overlapyearstart) AS matched
  FROM edges x
)"""

FLAG_COLUMNS = "overlapyearstart::BIGINT AS overlapyearstart, overlapyearend::BIGINT AS overlapyearend, matched::INT::BIGINT AS matched"


def report_sql(name: str = "table_name") -> str:
    return f"""
  SELECT {name} AS table_name, count(*) FILTER (WHERE matched) AS matched_rows, count(*) AS checked_rows,
    CASE WHEN count(*) FILTER (WHERE matched) = count(*)
           THEN 'All ' || count(*) || ' checked rows were recoverable from smaller source tables.'
         WHEN count(*) FILTER (WHERE matched) = 0
           THEN 'None of the ' || count(*) || ' checked rows were recoverable from smaller source tables.'
         ELSE 'Only ' || count(*) FILTER (WHERE matched) || ' of ' || count(*) ||
              ' checked rows were recoverable from smaller source tables.' END AS interpretation
  FROM flagged GROUP BY 1"""


def flags(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[number(c).alias(c) for c in (*YEARS, "matched")])


def checked_person_edges(t: Tables) -> DataFrame:
    return S.check_person_edges(
        person_edges(t), spells_of(emp(t), "emp"), "dirbrdid", "directorid", "companyid", YEARS
    )


@suite.register(
    f"WITH {EMP_SQL}, {ORG_HUB_SQL}, {PERSON_EDGES_SQL}, {PERSON_FLAGS_SQL} "
    f"SELECT dirbrdid, directorid, companyid, {FLAG_COLUMNS} FROM flagged"
)
def person_network_flags(t: Tables) -> DataFrame:
    return flags(checked_person_edges(t), "dirbrdid", "directorid", "companyid")


@suite.register(
    f"WITH {EMP_SQL}, {ORG_HUB_SQL}, {PERSON_EDGES_SQL}, {PERSON_FLAGS_SQL} {report_sql(chr(39) + 'individual_networks' + chr(39))}"
)
def person_network_report(t: Tables) -> DataFrame:
    return S.check_report(checked_person_edges(t), "individual_networks")


# --- organisation edges: listed and unlisted (spells on both sides), non-profit
# --- and other (spells on one side, activities on the other)

ASSOCIATION_SQL = f"""
board_edges AS (
  SELECT CASE WHEN flag = 'A' THEN 'listed_assoc' ELSE 'unlisted_assoc' END AS table_name,
         hub AS boardid, person AS directorid, organisation AS companyid,
         {SHIFT_SQL} AS overlapyearstart, {SHIFT_SQL} + 1 AS overlapyearend
  FROM emp LEFT JOIN person_hub USING (person)
), activity_edges AS (
  SELECT CASE WHEN event_type IN ('click', 'view') THEN 'nfp_assoc' ELSE 'other_assoc' END AS table_name,
         hub AS boardid, person AS directorid,
         organisation + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS companyid,
         2001 + event_id % 30 AS overlapyearstart, 2024 + event_id % 2 AS overlapyearend
  FROM other LEFT JOIN person_hub USING (person)
), other_closed AS (
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}') AS e FROM other
), flagged AS (
  SELECT x.*, EXISTS (
    SELECT 1 FROM emp_closed a, emp_closed b
    WHERE a.organisation = x.boardid AND a.person = x.directorid
      AND b.organisation = x.companyid AND b.person = x.directorid
      AND year(greatest(a.s, b.s)) <= x.overlapyearend AND year(least(a.e, b.e)) >= x.overlapyearstart) AS matched
  FROM board_edges x
  UNION ALL
  SELECT x.*, EXISTS (
    SELECT 1 FROM emp_closed a, other_closed b
    WHERE a.organisation = x.boardid AND a.person = x.directorid
      AND b.organisation = x.companyid AND b.person = x.directorid
      AND year(greatest(a.s, b.s)) <= x.overlapyearend AND year(least(a.e, b.e)) >= x.overlapyearstart) AS matched
  FROM activity_edges x
)"""


def checked_associations(t: Tables) -> DataFrame:
    e, o = emp(t), other_activities(t)
    home = hub(e, "person", "organisation")
    board = e.join(home, F.col("person") == F.col("_group"), "left").select(
        F.when(F.col("flag") == "A", "listed_assoc").otherwise("unlisted_assoc").alias("table_name"),
        F.col("hub").alias("boardid"),
        F.col("person").alias("directorid"),
        F.col("organisation").alias("companyid"),
        first_year().alias("overlapyearstart"),
        (first_year() + 1).alias("overlapyearend"),
    )
    activity = o.join(home, F.col("person") == F.col("_group"), "left").select(
        F.when(F.col("event_type").isin("click", "view"), "nfp_assoc").otherwise("other_assoc").alias("table_name"),
        F.col("hub").alias("boardid"),
        F.col("person").alias("directorid"),
        (F.col("organisation") + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).alias("companyid"),
        (F.col("event_id") % 30 + 2001).alias("overlapyearstart"),
        (F.col("event_id") % 2 + 2024).alias("overlapyearend"),
    )
    # Both checks look up the same jobs, so their profile is made once.
    jobs, activities = S.stored_profile(spells_of(e, "emp")), spells_of(o, "other")
    where = ("boardid", "companyid", "directorid", YEARS)
    return S.check_organisation_edges(board, jobs, jobs, *where).unionByName(
        S.check_organisation_edges(activity, jobs, activities, *where)
    )


@suite.register(
    f"WITH {EMP_SQL}, {PERSON_HUB_SQL}, {OTHER_SQL}, {ASSOCIATION_SQL} "
    f"SELECT table_name, boardid, directorid, companyid, {FLAG_COLUMNS} FROM flagged"
)
def association_flags(t: Tables) -> DataFrame:
    return flags(checked_associations(t), "table_name", "boardid", "directorid", "companyid")


@suite.register(f"WITH {EMP_SQL}, {PERSON_HUB_SQL}, {OTHER_SQL}, {ASSOCIATION_SQL} {report_sql()}")
def association_report(t: Tables) -> DataFrame:
    return S.check_report(checked_associations(t), F.col("table_name"))


# --- education: the second side is a dated award

EDUCATION_SQL = f"""
edges AS (
  SELECT organisation AS boardid, person AS directorid, school AS companyid,
         coalesce(year(s), 1998) AS overlapyearstart, coalesce(year(s), 1998) + line % 3 AS overlapyearend
  FROM emp
), flagged AS (
  SELECT x.*, EXISTS (
    SELECT 1 FROM emp_closed a, emp b
    WHERE a.organisation = x.boardid AND a.person = x.directorid
      AND b.school = x.companyid AND b.person = x.directorid
      AND year(a.s) <= x.overlapyearend AND year(a.e) >= x.overlapyearstart
      AND year(b.shipped) BETWEEN x.overlapyearstart AND x.overlapyearend) AS matched
  FROM edges x
)"""


@suite.register(
    f"WITH {EMP_SQL}, {EDUCATION_SQL} SELECT boardid, directorid, companyid, {FLAG_COLUMNS} FROM flagged"
)
def education_flags(t: Tables) -> DataFrame:
    e = emp(t)
    year = F.coalesce(F.year("s"), F.lit(1998))
    edges = e.select(
        F.col("organisation").alias("boardid"),
        F.col("person").alias("directorid"),
        F.col("school").alias("companyid"),
        year.alias("overlapyearstart"),
        (year + F.col("line") % 3).alias("overlapyearend"),
    )
    awards = S.point_spells(e, "person", "school", "shipped", "edu")
    checked = S.check_point_event_edges(
        edges, spells_of(e, "emp"), awards, "boardid", "companyid", "directorid", YEARS
    )
    return flags(checked, "boardid", "directorid", "companyid")


# --- senior managers: same row in another table, open ends match open ends

MANAGERS_SQL = """
managers AS (
  SELECT organisation AS boardid, person AS directorid, rolename, s AS datestartrole,
         CASE WHEN line = 2 THEN NULL WHEN line = 3 THEN e + 1 ELSE e END AS dateendrole
  FROM emp
), flagged AS (
  SELECT m.*, EXISTS (
    SELECT 1 FROM emp x WHERE x.organisation = m.boardid AND x.person = m.directorid
      AND x.rolename = m.rolename AND x.s = m.datestartrole AND x.e IS NOT DISTINCT FROM m.dateendrole) AS matched
  FROM managers m
)"""


@suite.register(
    f"""WITH {EMP_SQL}, {MANAGERS_SQL}
    SELECT boardid, directorid, rolename, CAST(datestartrole AS VARCHAR) AS datestartrole,
           CAST(dateendrole AS VARCHAR) AS dateendrole, matched::INT::BIGINT AS matched FROM flagged"""
)
def senior_manager_flags(t: Tables) -> DataFrame:
    e = emp(t)
    managers = e.select(
        F.col("organisation").alias("boardid"),
        F.col("person").alias("directorid"),
        "rolename",
        F.col("s").alias("datestartrole"),
        F.when(F.col("line") == 3, F.date_add("e", 1)).when(F.col("line") != 2, F.col("e")).alias("dateendrole"),
    )
    checked = S.check_exact_rows(
        managers,
        e,
        [("boardid", "organisation"), ("directorid", "person"), ("rolename", "rolename"), ("datestartrole", "s")],
        [("dateendrole", "e")],
    )
    return checked.select(
        "boardid", "directorid", "rolename", F.col("datestartrole").cast("string").alias("datestartrole"),
        F.col("dateendrole").cast("string").alias("dateendrole"), number("matched").alias("matched"),
    )


# --- company network: five sources united, shared person, different organisations

UNION_SQL = f"""
roles AS (
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}') AS e, 'emp' AS src FROM emp WHERE flag = 'A'
  UNION ALL
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}'), 'org' FROM emp WHERE flag = 'N'
  UNION ALL
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}'), 'sr' FROM emp WHERE flag = 'R'
  UNION ALL
  SELECT person, organisation, s, coalesce(e, DATE '{AS_OF}'), 'other' FROM other
  UNION ALL
  SELECT person, school, shipped, shipped, 'edu' FROM emp
)"""


def united_roles(t: Tables, e: DataFrame | None = None) -> DataFrame:
    e = emp(t) if e is None else e
    return S.union_spells(
        [
            spells_of(e.where(F.col("flag") == "A"), "emp"),
            spells_of(e.where(F.col("flag") == "N"), "org"),
            spells_of(e.where(F.col("flag") == "R"), "sr"),
            spells_of(other_activities(t), "other"),
            S.point_spells(e, "person", "school", "shipped", "edu"),
        ]
    )


@suite.register(
    f"""WITH {EMP_SQL}, {OTHER_SQL}, {UNION_SQL}
    SELECT src, count(*) AS spells, CAST(min(s) AS VARCHAR) AS first_start, CAST(max(e) AS VARCHAR) AS last_end,
           count(*) FILTER (WHERE s IS NULL) AS undated FROM roles GROUP BY src"""
)
def role_union_profile(t: Tables) -> DataFrame:
    return united_roles(t).groupBy("src").agg(
        F.count(F.lit(1)).alias("spells"),
        F.min("start_date").cast("string").alias("first_start"),
        F.max("end_date").cast("string").alias("last_end"),
        F.count_if(F.col("start_date").isNull()).alias("undated"),
    )


COMPANY_EDGES_SQL = f"""
edges AS (
  SELECT hub AS boardid, organisation AS companyid, person AS directorid,
         {SHIFT_SQL} AS overlapyearstart, {SHIFT_SQL} + 1 AS overlapyearend
  FROM emp LEFT JOIN person_hub USING (person)
), flagged AS (
  SELECT x.*, EXISTS (
    SELECT 1 FROM roles a, roles b
    WHERE a.person = b.person AND a.organisation <> b.organisation
      AND a.organisation = x.boardid AND b.organisation = x.companyid AND a.person = x.directorid
      AND year(greatest(a.s, b.s)) <= x.overlapyearend AND year(least(a.e, b.e)) >= x.overlapyearstart) AS matched
  FROM edges x
)"""


@suite.register(
    f"WITH {EMP_SQL}, {PERSON_HUB_SQL}, {OTHER_SQL}, {UNION_SQL}, {COMPANY_EDGES_SQL} "
    f"SELECT boardid, companyid, directorid, {FLAG_COLUMNS} FROM flagged"
)
def company_network_flags(t: Tables) -> DataFrame:
    e = emp(t)
    edges = e.join(hub(e, "person", "organisation"), F.col("person") == F.col("_group"), "left").select(
        F.col("hub").alias("boardid"),
        F.col("organisation").alias("companyid"),
        F.col("person").alias("directorid"),
        first_year().alias("overlapyearstart"),
        (first_year() + 1).alias("overlapyearend"),
    )
    roles = united_roles(t, e)
    checked = S.check_organisation_edges(
        edges, roles, roles, "boardid", "companyid", "directorid", YEARS, distinct_organisations=True
    )
    return flags(checked, "boardid", "companyid", "directorid")
