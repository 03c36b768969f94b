"""Ratios of fundamental records, as the record's own measures define them; null where the divisor is zero or missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def over(a: Column, b: Column) -> Column:
    """``a`` divided by ``b`` as a double."""
    return (a.cast("double") / F.nullif(b, F.lit(0))).cast("double")


def gross_value(market_capitalization: Column, total_debt: Column) -> Column:
    """What the owners' and the lenders' claims are worth together."""
    return market_capitalization + total_debt


def profit_margin(net_income: Column, revenues: Column) -> Column:
    return over(net_income, revenues)


def debt_to_equity(total_debt: Column, equity: Column) -> Column:
    return over(total_debt, equity)


def liabilities(total_assets: Column, equity: Column) -> Column:
    return total_assets - equity


def return_on_assets(net_income: Column, total_assets: Column) -> Column:
    return over(net_income, total_assets)


def return_on_equity(net_income: Column, equity: Column) -> Column:
    return over(net_income, equity)


def asset_turnover(revenues: Column, total_assets: Column) -> Column:
    return over(revenues, total_assets)


def book_value_per_share(equity: Column, shares: Column) -> Column:
    return over(equity, shares)


def price_to_book(market_capitalization: Column, equity: Column) -> Column:
    return over(market_capitalization, equity)
