"""Canonical record types: schemas, keys, what an update may change, guards, defaults and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code sets of the canonical records (the union of the declared and the written set).
ASSET_TYPES = ("CS", "PS", "ETF", "ETN", "CEF", "MF", "ADRC", "FRED", "SYNTH", "INDEX", "Unknown")
EXCHANGE_CODES = ("XNAS", "XNYS", "BATS", "XASE", "NMFQS", "ARCX", "INDEX", "OTC", "UNK")
DIMENSIONS = ("ARQ", "MRQ", "ARY", "MRY", "ART", "MRT")
MONEY, SPLIT = T.DecimalType(12, 4), T.DecimalType(9, 6)


_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """Schema of ``name type, name type``; unlike the session's parser it needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (part.split() for part in text.split(", "))])


# Measures of the fundamental record, in order; those of the second text are doubles.
_FUNDAMENTAL_MEASURES = """
accumulated_other_comprehensive_income total_assets average_assets current_assets assets_non_current asset_turnover
book_value_per_share capital_expenditure cash_and_equivalents cost_of_revenue consolidated_income current_ratio
debt_to_equity_ratio total_debt debt_current debt_non_current deferred_revenue depreciation_amortization_and_accretion deposits
dividend_yield dividends_per_basic_common_share ebit ebitda ebitda_margin ebt eps eps_diluted equity equity_avg enterprise_value
ev_to_ebit ev_to_ebitda free_cash_flow free_cash_flow_per_share fx_usd gross_profit gross_margin intangibles interest_expense
invested_capital invested_capital_average inventory investments investments_current investments_non_current total_liabilities
current_liabilities liabilities_non_current market_capitalization net_cash_flow net_cash_flow_business net_cash_flow_common
net_cash_flow_debt net_cash_flow_dividend net_cash_flow_from_financing net_cash_flow_from_investing net_cash_flow_invest
net_cash_flow_from_operations net_cash_flow_fx net_income net_income_common_stock net_loss_income_discontinued_operations
net_income_to_non_controlling_interests profit_margin operating_expenses operating_income payables payout_ratio pb pe pe1
property_plant_and_equipment_net preferred_dividends_income_statement_impact price ps ps1 receivables
accumulated_retained_earnings_deficit revenues r_and_d_expenses roa roe roic return_on_sales share_based_compensation
selling_general_and_administrative_expense share_factor shares_basic weighted_average_shares weighted_average_shares_diluted
sales_per_share tangible_asset_value tax_assets income_tax_expense tax_liabilities tangible_assets_book_value_per_share
working_capital
""".split()
_DOUBLES = set(
    """
asset_turnover book_value_per_share current_ratio debt_to_equity_ratio dividend_yield dividends_per_basic_common_share
ebitda_margin eps eps_diluted ev_to_ebitda free_cash_flow_per_share fx_usd gross_margin profit_margin payout_ratio pb pe pe1
price ps ps1 roa roe roic return_on_sales share_factor sales_per_share tangible_assets_book_value_per_share
""".split()
)
FUNDAMENTAL_MEASURES = tuple(_FUNDAMENTAL_MEASURES)
FUNDAMENTAL_DDL = (
    "event_date date, ticker string, composite_figi string, dimension string, date_key date, report_period date, last_updated date, "
    + ", ".join(f"{m} {'double' if m in _DOUBLES else 'bigint'}" for m in FUNDAMENTAL_MEASURES)
)


@dataclass(frozen=True)
class DataTypeSpec:
    """One canonical record type.

    ``update`` lists the columns that an update of a known key replaces (None: all that are not keys); others keep
    their first value. ``guard`` columns must be non-empty, or the row is skipped.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    update: tuple[str, ...] | None = None
    guard: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    partitioned: bool = False

    @property
    def updates(self) -> tuple[str, ...]:
        return self.update if self.update is not None else tuple(c for c in self.schema.names if c not in self.keys)

    @property
    def static(self) -> tuple[str, ...]:
        return tuple(c for c in self.schema.names if c not in self.keys and c not in self.updates)

    def valid(self) -> Column:
        """The row has its key parts (texts non-empty)."""
        ok = F.lit(True)
        for c in self.guard:
            ok = ok & F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
        for c in self.keys:
            ok = ok & F.col(c).isNotNull()
        return ok


_PRICE = {c: 0.0 for c in ("open", "high", "low", "close", "volume", "dividend")} | {"split_factor": 1.0}
_RATIOS = {c: 0.0 for c in ("pe", "pb", "ps", "ev_ebit", "ev_ebitda")} | {"market_cap": 0, "ev": 0, "sp500": False}

DATA_TYPES: dict[str, DataTypeSpec] = {
    s.name: s
    for s in (
        DataTypeSpec(
            "asset-description",
            _schema(
                "ticker string, composite_figi string, share_class_figi string, primary_exchange string, asset_type string, "
                "active boolean, name string, description string, corporate_url string, sector string, industry string, sic_code int, "
                "cik string, cusips array<string>, isins array<string>, other_identifiers map<string,string>, similar_tickers "
                "array<string>, tags array<string>, listed timestamp_ntz, delisted timestamp_ntz, last_updated timestamp_ntz"
            ),
            ("ticker", "composite_figi"),
            update=(
                "primary_exchange", "active", "name", "description", "corporate_url", "sector", "industry", "sic_code", "cik", "cusips",
                "isins", "other_identifiers", "similar_tickers", "tags", "listed", "delisted", "last_updated",
            ),
            guard=("composite_figi",),
        ),
        DataTypeSpec(
            "custom", _schema("ticker string, composite_figi string, event_date date, key string, value string"),
            ("key", "composite_figi", "event_date"), update=("value",), guard=("composite_figi",),
        ),
        DataTypeSpec(
            "economic-indicator", _schema("series string, event_date date, value float"), ("series", "event_date"), guard=("series",)
        ),
        DataTypeSpec(
            "eod",
            T.StructType(
                _schema("ticker string, composite_figi string, event_date date").fields
                + [T.StructField(c, MONEY) for c in ("open", "high", "low", "close", "adj_close")]
                + [T.StructField("volume", T.LongType()), T.StructField("dividend", MONEY), T.StructField("split_factor", SPLIT)]
            ),
            ("composite_figi", "event_date"), update=("open", "high", "low", "close", "volume", "dividend", "split_factor"),
            defaults=_PRICE, partitioned=True,
        ),
        DataTypeSpec(
            "fundamental", _schema(FUNDAMENTAL_DDL), ("composite_figi", "dimension", "event_date"), guard=("composite_figi",)
        ),
        DataTypeSpec(
            "market-holidays", _schema("holiday string, event_date date, market string, early_close boolean, close_time string"),
            ("event_date", "market"), defaults={"early_close": False, "close_time": "16:00:00"},
        ),
        DataTypeSpec(
            "metric",
            _schema(
                "ticker string, composite_figi string, event_date date, market_cap bigint, ev bigint, pe float, pb float, ps float, "
                "ev_ebit float, ev_ebitda float, sp500 boolean"
            ),
            ("composite_figi", "event_date"), guard=("ticker", "composite_figi"), defaults=_RATIOS, partitioned=True,
        ),
        DataTypeSpec(
            "rating", _schema("ticker string, composite_figi string, event_date date, analyst string, rating int"),
            ("analyst", "composite_figi", "event_date"), update=("rating",), guard=("composite_figi",),
        ),
    )
}


def filled(defaults: dict[str, object]) -> dict[str, Column]:
    """Columns that put the defaults in place of nulls."""
    return {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}


def figi_ok(c: Column) -> Column:
    """The check of a composite identifier: twelve characters without blanks around."""
    return F.coalesce(F.length(F.trim(c)) == 12, F.lit(False))
