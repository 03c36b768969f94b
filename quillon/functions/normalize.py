"""Vendor notations of tickers, exchanges, kinds, lists and names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.english import english_terms

# Vendor exchange names to codes.
EXCHANGES = {
    "BATS": "BATS", "NASDAQ": "XNAS", "NMFQS": "NMFQS", "NYSE": "XNYS", "NYSEARCA": "ARCX", "NYSE ARCA": "ARCX",
    "NYSEMKT": "XASE", "NYSE MKT": "XASE", "AMEX": "XASE", "INDEX": "INDEX", "OTC": "OTC",
    "XNAS": "XNAS", "XNYS": "XNYS", "XASE": "XASE", "ARCX": "ARCX",
}
# Vendor categories to asset types; categories not listed are Unknown.
CATEGORIES = {
    "ETF": "ETF", "CEF": "CEF", "ETN": "ETN", "IDX": "INDEX",
    "ADR Common Stock": "ADRC", "ADR Common Stock Primary Class": "ADRC", "ADR Common Stock Secondary Class": "ADRC",
    "Domestic Common Stock": "CS", "Domestic Common Stock Primary Class": "CS", "Domestic Common Stock Secondary Class": "CS",
}
# Letter grades, image kinds, and exchanges that the price vendor covers.
GRADES = {"A": 1, "B": 2, "C": 3, "D": 4, "F": 5}
EXTENSIONS = {"image/jpeg": ".jpg", "image/png": ".png", "image/svg": ".svg", "image/svg+xml": ".svg"}
COVERED = ("BATS", "NASDAQ", "NMFQS", "NYSE", "NYSE ARCA", "NYSE MKT")
# Parts of addresses of trackers.
TRACKERS = (
    "google.com", "googletagservices.com", "googlesyndication.com", "facebook.com", "moatpixel.com", "moatads.com", "adsystem.com",
    "connatix.com", "prebid", "sodar", "auction", "rubiconproject.com", "pubmatic.com", "amazon-adsystem.com", "adnxs.com", "lijit.com",
    "3lift.com", "doubleclick.net", "bidswitch.net", "casalemedia.com", "yahoo.com", "sitescout.com", "ipredictive.com",
    "uat5-b.investingchannel.com", "eyeota.net",
)


def lookup(c: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Value of a fixed table, ``default`` (else null) for other keys."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def exchange(c: Column) -> Column:
    return lookup(c, EXCHANGES, "UNK")


def category(c: Column) -> Column:
    return lookup(c, CATEGORIES, "Unknown")


def grade(c: Column) -> Column:
    return lookup(c, GRADES)


def security_kind(kind: Column, detail: Column) -> Column:
    """Asset type of a mapping answer's security type, in two levels; null where it says nothing."""
    fund = F.when(detail == "ETP", "ETF").when(detail == "Closed-End Fund", "CEF").otherwise("MF")
    return F.when(kind.isin("Partnership Shares", "Common Stock"), "CS").when(kind == "Depositary Receipt", "ADRC").when(kind == "Mutual Fund", fund)


def slashed(ticker: Column) -> Column:
    """``.`` and ``-`` of a ticker become ``/``."""
    return F.translate(ticker, ".-", "//")


def dashed(ticker: Column) -> Column:
    return F.translate(ticker, "/", "-")


def undashed(text: Column) -> Column:
    return F.regexp_replace(text, "-", "")


def rejected_ticker(t: Column) -> Column:
    """Test tickers, and those of warrants, preferred shares and units."""
    return (
        t.startswith("ATEST") | t.startswith("NTEST") | t.startswith("PTEST") | t.contains(" ")
        | t.rlike("^[A-Za-z0-9]+-[WPU]") | t.rlike("^[A-Za-z0-9]{4}[WPU]")
    )


def blank_list(c: Column) -> Column:
    """A blank-separated text as an array; null for a blank text."""
    return F.when(F.trim(c) != "", F.split(F.trim(c), " "))


def comma_list(c: Column) -> Column:
    return F.transform(F.split(c, ","), lambda x: F.trim(x))


def captured(c: Column, pattern: str) -> Column:
    """First group of a pattern, '' without a match."""
    return F.regexp_extract(c, pattern, 1)


def cik(c: Column) -> Column:
    return captured(c, r"CIK=(\d+)")


def location(city: Column, state: Column) -> Column:
    """``city, state``; '' without a city."""
    return F.when(F.coalesce(city, F.lit("")) == "", F.lit("")).otherwise(F.concat(city, F.lit(", "), F.coalesce(state, F.lit(""))))


def asset_id(ticker: Column, figi: Column) -> Column:
    return F.concat_ws(":", ticker, figi)


def slug(c: Column) -> Column:
    """Lower case letters and digits with underscores between, as a table name."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def table_name(provider: Column, dataset: Column, kind: Column, id_: Column) -> Column:
    return slug(F.concat_ws(" ", provider, dataset, kind, F.substring(id_, 1, 5)))


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 2_147_483_647))


def number(c: Column, kind: str = "double", missing: object = 0) -> Column:
    """A text as a number, ``missing`` where it is none."""
    return F.coalesce(c.try_cast(kind), F.lit(missing).cast(kind))


def millions(c: Column) -> Column:
    """A value in millions as units, digits beyond cut off."""
    return F.try_multiply(c.cast("double"), F.lit(1e6)).try_cast("bigint")


def extension(mime: Column) -> Column:
    """File extension of an image kind; null for none, an error text for an unknown one."""
    return F.when(F.coalesce(mime, F.lit("")) != "", lookup(mime, EXTENSIONS, "unknown"))


def blocked(url: Column) -> Column:
    """The address holds a tracker's part."""
    hit = F.lit(False)
    for t in TRACKERS:
        hit = hit | url.contains(t)
    return hit


def weighted_terms(parts: Mapping[str, Column], english: bool = False) -> Column:
    """Array of (term, weight): the words of each text with the text's weight letter.

    With ``english``, stop words are left out and the others stemmed, which needs Python; without, words stay as they are.
    """

    def weighted(c: Column, weight: str) -> Column:
        words = english_terms(c) if english else F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+"), lambda x: x != "")
        return F.transform(words, lambda x: F.struct(x.alias("term"), F.lit(weight).alias("weight")))

    return F.concat(*[weighted(c, w) for w, c in parts.items()])
