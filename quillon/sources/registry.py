"""Providers and the datasets that they offer."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    """A dataset: what it delivers and the first day of its history (metadata, never a filter)."""

    name: str
    data_types: tuple[str, ...]
    start: str


# Providers, datasets, record types and first days.
PROVIDERS: dict[str, dict[str, Dataset]] = {
    "fred": {"Economic Indicators": Dataset("Economic Indicators", ("economic-indicator",), "1900-01-01")},
    "polygon": {
        "Market Holidays": Dataset("Market Holidays", ("market-holidays",), "2024-01-01"),
        "Stock Tickers": Dataset("Stock Tickers", ("asset-description",), "1949-04-19"),
    },
    "sharadar": {
        "Fundamentals": Dataset("Fundamentals", ("fundamental",), "2007-01-01"),
        "Metrics": Dataset("Metrics", ("metric",), "2007-01-01"),
        "Stock Tickers": Dataset("Stock Tickers", ("asset-description",), "2014-01-01"),
    },
    "tiingo": {
        "EOD": Dataset("EOD", ("eod",), "1960-01-01"),
        "Stock Tickers": Dataset("Stock Tickers", ("asset-description",), "2014-01-01"),
    },
    "zacks": {"Zacks Screener Data": Dataset("Zacks Screener Data", ("rating", "custom"), "1990-01-01")},
}


def dataset(provider: str, name: str) -> Dataset:
    """A dataset by provider and name; an error names what is on offer."""
    try:
        return PROVIDERS[provider][name]
    except KeyError:
        offers = [f"{p}: {', '.join(d)}" for p, d in PROVIDERS.items()]
        raise ValueError(f"no dataset {name!r} of {provider!r}; on offer are {'; '.join(offers)}") from None
