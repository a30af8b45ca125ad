"""Column contracts, normalization rules and physical layouts per table family.

Everything in this module is a fixed value that must equal the published
table definitions: column lists, target types, domains, ranges, sort keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

OPTION_FAMILY = "opprcd"
PRICE_FAMILY = "secprd"
LINK_TABLE = "opcrsphist"

# --- fixed values: source columns, in contract order -------------------------
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "opprcd": (
        "secid", "date", "symbol", "symbol_flag", "exdate", "last_date", "cp_flag", "strike_price",
        "best_bid", "best_offer", "volume", "open_interest", "impl_volatility", "delta", "gamma",
        "vega", "theta", "optionid", "cfadj", "am_settlement", "contract_size", "ss_flag",
        "expiry_indicator",
    ),
    "secprd": (
        "secid", "date", "low", "high", "close", "volume", "return", "cfadj", "open", "cfret", "shrout",
    ),
    "securd": (
        "secid", "cusip", "ticker", "sic", "index_flag", "exchange_d", "class", "issue_type",
        "industry_group",
    ),
    "secnmd": ("secid", "effect_date", "cusip", "ticker", "class", "issuer", "issue", "sic"),
    "exchgd": ("secid", "effect_date", "seq_num", "status", "exchange", "add_del", "exch_flag"),
    "distrd": (
        "secid", "record_date", "seq_num", "ex_date", "amount", "adj_factor", "declare_date",
        "payment_date", "link_secid", "distr_type", "frequency", "currency", "approx_flag",
        "cancel_flag", "liquid_flag",
    ),
    "opinfd": ("secid", "div_convention", "exercise_style", "am_set_flag"),
    "opcrsphist": ("secid", "sdate", "edate", "permno", "score"),
}

# --- fixed values: integer targets as (minimum, maximum, stored type) --------
UINT8 = (0, 2**8 - 1, "smallint")
UINT32 = (0, 2**32 - 1, "bigint")
UINT64 = (0, 2**64 - 1, "decimal(20,0)")
INT32 = (-(2**31), 2**31 - 1, "int")

# --- fixed values: six-decimal targets as (minimum, maximum, stored type) ----
DECIMAL32_6 = ("-2147.483648", "2147.483647", "decimal(10,6)")
DECIMAL64_6 = ("-9223372036854.775808", "9223372036854.775807", "decimal(19,6)")


@dataclass(frozen=True)
class FamilyRules:
    """Checks and casts of one table family; absent columns are skipped."""

    integers: dict[str, tuple[int, int, str]] = field(default_factory=dict)
    decimals: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    flags: tuple[str, ...] = ()
    floats: dict[str, str] = field(default_factory=dict)


# contract_size is signed because -99 marks a missing size and is kept.
RULES: dict[str, FamilyRules] = {
    "opprcd": FamilyRules(
        integers={
            "secid": UINT32, "volume": UINT32, "open_interest": UINT32, "optionid": UINT64,
            "am_settlement": UINT8, "contract_size": INT32,
        },
        decimals={
            "impl_volatility": DECIMAL32_6, "delta": DECIMAL32_6, "gamma": DECIMAL32_6,
            "vega": DECIMAL64_6, "theta": DECIMAL64_6,
        },
        dates=("date", "exdate", "last_date"),
        domains={"cp_flag": ("C", "P"), "symbol_flag": ("0", "1"), "ss_flag": ("0", "1", "E")},
        flags=("am_settlement",),
        floats={"strike_price": "float", "best_bid": "float", "best_offer": "float", "cfadj": "float"},
    ),
    "secprd": FamilyRules(
        integers={"secid": UINT32, "volume": UINT64},
        dates=("date",),
        floats={
            "low": "float", "high": "float", "close": "float", "return": "float", "cfadj": "float",
            "open": "float", "cfret": "float", "shrout": "float",
        },
    ),
    "securd": FamilyRules(
        integers={"secid": UINT32}, floats={"exchange_d": "double", "industry_group": "double"}
    ),
    "secnmd": FamilyRules(integers={"secid": UINT32}, dates=("effect_date",)),
    "exchgd": FamilyRules(integers={"secid": UINT32, "seq_num": UINT32}, dates=("effect_date",)),
    "distrd": FamilyRules(
        integers={"secid": UINT32, "link_secid": UINT32, "seq_num": UINT32},
        dates=("record_date", "ex_date", "declare_date", "payment_date"),
        floats={"amount": "double", "adj_factor": "double"},
    ),
    "opinfd": FamilyRules(integers={"secid": UINT32}),
    "opcrsphist": FamilyRules(
        integers={"secid": UINT32, "permno": UINT32}, dates=("sdate", "edate"), floats={"score": "double"}
    ),
}

# --- fixed values: key columns that must not be null -------------------------
REQUIRED_KEYS: dict[str, tuple[str, ...]] = {
    "opprcd": ("secid", "date", "optionid", "exdate", "cp_flag", "strike_price"),
    "secprd": ("secid", "date"),
    "opcrsphist": ("permno", "sdate", "edate"),
    "securd": ("secid",),
    "secnmd": ("secid",),
    "exchgd": ("secid",),
    "distrd": ("secid",),
    "opinfd": ("secid",),
}

# The contract-date key that must be unique in option tables.
CONTRACT_DATE_KEY = ("secid", "date", "optionid", "exdate", "cp_flag", "strike_price")

# --- fixed values: partitioning and in-file sort order -----------------------
# Partition "month" is yyyyMM of the date column (NULL counts as 1970-01-01).
@dataclass(frozen=True)
class Layout:
    sort_keys: tuple[str, ...]
    partition: str | None = None
    month_of: str | None = None


LAYOUTS: dict[str, Layout] = {
    "opprcd": Layout(
        ("secid", "date", "exdate", "cp_flag", "strike_price", "optionid"), "month", month_of="date"
    ),
    "secprd": Layout(("secid", "date"), "source_year"),
    "securd": Layout(("secid",)),
    "secnmd": Layout(("secid", "effect_date")),
    "exchgd": Layout(("secid", "effect_date", "seq_num")),
    "distrd": Layout(("secid", "record_date", "seq_num")),
    "opinfd": Layout(("secid",)),
    "opcrsphist": Layout(("secid", "sdate", "edate", "permno", "score")),
    "bars": Layout(("symbol", "ts"), "month", month_of="ts"),
}

# --- fixed values: sort-key candidates for tables without their own layout ---
ID_CANDIDATES = ("directorid", "companyid", "personid", "professionalid", "proid", "objectid")
DATE_CANDIDATES = ("annualreportdate", "startdate", "enddate", "date", "asofdate")


def family_of(prefix: str, table: str) -> str:
    """Family name for a yearly prefix or a static table; unknown is an error."""

    if prefix in (OPTION_FAMILY, PRICE_FAMILY):
        return prefix
    if table in SOURCE_COLUMNS:
        return table
    raise ValueError(f"no column contract for table {table!r} (prefix {prefix!r}); known: {sorted(SOURCE_COLUMNS)}")


def source_columns(prefix: str, table: str) -> tuple[str, ...]:
    """Ordered source columns of one table."""

    return SOURCE_COLUMNS[family_of(prefix, table)]


def default_sort_columns(columns: list[str]) -> list[str]:
    """First known id column, then first known date column; may be empty."""

    chosen = []
    for candidates in (ID_CANDIDATES, DATE_CANDIDATES):
        present = [name for name in candidates if name in columns]
        chosen.extend(present[:1])
    return chosen


def target_type(family: str, column: str) -> str:
    """Stored Spark type of one contract column."""

    rules = RULES[family]
    if column in rules.integers:
        return rules.integers[column][2]
    if column in rules.decimals:
        return rules.decimals[column][2]
    if column in rules.dates:
        return "date"
    return rules.floats.get(column, "string")


def target_ddl(family: str, with_source_year: bool = False) -> str:
    """DDL of one family's stored table."""

    fields = [f"`{name}` {target_type(family, name)}" for name in SOURCE_COLUMNS[family]]
    if with_source_year:
        fields.insert(0, "`source_year` smallint")
    return ", ".join(fields)
