"""Mixed timestamp notations and zones to one UTC instant."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.common import BLANKS, bounded_broadcast, clean_key

SEP = "\x01"

# English month names by their first three letters, and zone abbreviations in minutes east of UTC.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "HKT": 480, "SGT": 480, "JST": 540, "KST": 540,
    "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
}
#: Abbreviations that mean something else in these zones than above.
ABBREVIATIONS_IN = {
    "Australia/Sydney": {"EST": 600, "EDT": 660},
    "Asia/Shanghai": {"CST": 480},
    "Asia/Taipei": {"CST": 480},
    "Europe/Dublin": {"IST": 60},
    "Asia/Jerusalem": {"IST": 120, "IDT": 180},
}

_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DAY_NAME = r"(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? +)?"

#: One alternation over every notation; each named group is one component of one notation.
PATTERN = (
    r"(?is)^(?:"
    r"(?<us>\d{15,16})|(?<ms>\d{12,13})|(?<sec>\d{9,10})"
    r"|(?<y6>\d{4})(?<m6>\d{2})"
    r"|(?<y8>\d{4})(?<m8>\d{2})(?<d8>\d{2})(?:[t ](?<hc>\d{2})(?<nc>\d{2})(?<sc>\d{2})?(?:[.,](?<fc>\d+))? ?(?<zc>z|[+-]\d{2}(?::?\d{2})?)?)?"
    r"|(?<ym>\d{4})-(?<mm>\d{1,2})"
    r"|(?:(?<yi>\d{4})-(?<mi>\d{1,2})-(?<di>\d{1,2})"
    r"|(?<yw>\d{4})-?w(?<ww>\d{2})(?:-?(?<wd>\d))?"
    r"|(?<yo>\d{4})-(?<do>\d{3})"
    r"|(?<ys>\d{4})/(?<ms1>\d{1,2})/(?<ds>\d{1,2})"
    r"|(?<s1>\d{1,2})/(?<s2>\d{1,2})/(?<y3>\d{4}|\d{2})"
    r"|(?<dd>\d{1,2})\.(?<md>\d{1,2})\.(?<yd>\d{4}|\d{2})"
    rf"|{_DAY_NAME}(?<dn>\d{{1,2}})[- ](?<mn>{_MONTH})\.?(?:-|,? )(?<yn>\d{{4}}|\d{{2}})"
    rf"|{_DAY_NAME}(?<mf>{_MONTH})\.? (?<df>\d{{1,2}}),? (?<yf>\d{{4}})"
    r")(?:(?:t|,? +)(?<h>\d{1,2}):(?<n>\d{2})(?::(?<s>\d{2})(?:[.,](?<f>\d+))?)?(?: ?(?<ap>[ap])\.?m\.?)?"
    r"(?: ?(?<z>[+-]\d{2}(?::?\d{2})?|[a-z]{1,5}|[a-z]+/[a-z_/+-]+))?(?:\[(?<zone>[a-z_]+(?:/[a-z0-9_+-]+)*)\])?)?"
    r")$"
)
_FIELDS = {
    "us": "${us}", "ms": "${ms}", "sec": "${sec}",
    "y": "${y6}${y8}${ym}${yi}${yw}${yo}${ys}${y3}${yd}${yn}${yf}",
    "mo": "${m6}${m8}${mm}${mi}${ms1}${md}", "name": "${mn}${mf}", "d": "${d8}${di}${ds}${dd}${dn}${df}",
    "week": "${ww}", "wday": "${wd}", "yday": "${do}", "s1": "${s1}", "s2": "${s2}",
    "h": "${hc}${h}", "mi": "${nc}${n}", "se": "${sc}${s}", "fr": "${fc}${f}", "ap": "${ap}", "z": "${zc}${z}", "zone": "${zone}",
}


#: Days of a common year before each month.
BEFORE_MONTH = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def january_first(y: Column) -> Column:
    """Days from 1970-01-01 to January 1 of a proleptic Gregorian year, by integers alone."""
    return F.lit(365) * (y - 1970) + _div(y - 1969, 4) - _div(y - 1901, 100) + _div(y - 1601, 400)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("int")


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, each computed once per row.

    A plain projection would be inlined again wherever its columns are used, by filters of the caller too;
    a generator of one row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def to_instants(
    rows: DataFrame, zones: DataFrame, *, raw: Column, place: Column, zone_place: Column, tz_name: Column,
    day_first: Column, default_tz: str = "America/New_York", max_zones: int = 10_000, into: str = "utc_us",
) -> DataFrame:
    """``rows`` with ``into``: microseconds since 1970-01-01T00:00:00Z that the text ``raw`` names, else null.

    A zone, offset or abbreviation in the text decides; otherwise the value is local time of the place's
    ``tz_name``, ``default_tz`` where the place is null or unknown. Slashed dates are day first where the
    place's ``day_first`` is true, else month first; dotted dates are day first; two-digit years are 20xx. A
    day means its midnight, a month its first day, an ISO week without day its Monday, 24:00 the end of the
    day. Texts of 6 or 8 digits are dates, of 9-10, 12-13 and 15-16 digits counts of seconds, milli- and
    microseconds; other digit counts, such as 0, are void. A doubled local time is its first
    occurrence, a skipped one is read with the offset in force before the change. Digits beyond microseconds
    are cut off.

    Method: one alternation with named groups is applied once per text and rewrites it as a list of
    components; these are validated against the calendar and put together by integer day arithmetic, zones by
    the JVM's rules. Everything stays in generated code; nothing is shuffled: the zone table is broadcast only
    if it has at most ``max_zones`` rows (there are fewer market codes than that), else joined by shuffle.

    Defined cases: null, empty, void or impossible values give null; every row of ``rows`` is kept once with
    all its columns; a place listed twice in ``zones`` counts once (greatest row); an unknown zone name or
    abbreviation gives null.
    """
    if into.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"rows already has a column {into}")
    places = (
        zones.select(clean_key(zone_place).alias("__q_place"), F.struct(tz_name.alias("tz"), day_first.alias("df")).alias("x"))
        .where("__q_place is not null")
        .groupBy("__q_place")
        .agg(F.max("x").alias("__q_zone"))
    )
    text = F.btrim(raw, F.lit(BLANKS + "\ufeff"))
    rewritten = F.regexp_replace(text, F.lit(PATTERN), F.lit(SEP + SEP.join(_FIELDS.values())))
    work = rows.select("*", clean_key(place).alias("__q_place")).join(bounded_broadcast(places, max_zones), "__q_place", "left")
    work = _once(work, {"__q_p": F.split(rewritten, SEP)})
    text_of = lambda n: f"nullif(get(__q_p, {1 + list(_FIELDS).index(n)}), '')"
    num = lambda n: F.expr(f"try_cast({text_of(n)} as int)")
    big = lambda n: F.expr(f"try_cast({text_of(n)} as bigint)")
    day_is_first = F.coalesce(F.col("__q_zone.df"), F.lit(False))
    month_name = F.upper(F.substring(F.expr(text_of("name")), 1, 3))
    year_text, year = F.expr(text_of("y")), num("y")
    work = _once(work, {
        "__q_ok": F.size("__q_p") == len(_FIELDS) + 1,
        "__q_epoch": F.coalesce(big("us"), big("ms") * 1000, big("sec") * 1_000_000),
        "__q_y": F.when(F.length(year_text) == 2, year + 2000).when(year >= 1, year),
        "__q_tz": F.coalesce(F.col("__q_zone.tz"), F.lit(default_tz)),
        "__q_month": F.coalesce(
            num("mo"), F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_name).cast("int"),
            F.when(day_is_first, num("s2")).otherwise(num("s1")),
        ),
        "__q_d": F.coalesce(num("d"), F.when(day_is_first, num("s1")).otherwise(num("s2")), F.lit(1)),
        "__q_week": num("week"), "__q_wday": F.coalesce(num("wday"), F.lit(1)), "__q_yday": num("yday"),
        "__q_h": num("h"), "__q_mi": num("mi"), "__q_se": F.coalesce(num("se"), F.lit(0)),
        "__q_us": F.coalesce(F.rpad(F.substring(F.expr(text_of("fr")), 1, 6), 6, "0").cast("int"), F.lit(0)),
        "__q_ap": F.lower(F.expr(text_of("ap"))), "__q_z": F.expr(text_of("z")), "__q_named": F.expr(text_of("zone")),
    })
    y, m, d = F.col("__q_y"), F.col("__q_month"), F.col("__q_d")
    work = _once(work, {
        "__q_jan1": january_first(y), "__q_leap": (((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)).cast("int"),
        "__q_region": F.coalesce(F.col("__q_named"), F.when(F.contains("__q_z", F.lit("/")), F.col("__q_z"))),
        "__q_abbr": F.upper("__q_z"),
    })
    jan1, leap = F.col("__q_jan1"), F.col("__q_leap")
    # Calendar dates, ordinal dates and ISO weeks, each null where it does not exist.
    length = F.when(m == 2, 28 + leap).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    before = F.get(F.array(*[F.lit(n) for n in BEFORE_MONTH]), m - 1) + F.when(m > 2, leap).otherwise(0)
    civil = F.when(m.between(1, 12) & (d >= 1) & (d <= length), jan1 + before + d - 1)
    ordinal = F.when(F.col("__q_yday").between(1, 365 + leap), jan1 + F.col("__q_yday") - 1)
    weekday = F.pmod(jan1 + 3, F.lit(7))  # of January 1, Monday is 0
    weeks = F.when((weekday == 3) | ((weekday == 2) & (leap == 1)), 53).otherwise(52)
    monday = jan1 - weekday + F.when(weekday > 3, 7).otherwise(0)
    iso = F.when(
        F.col("__q_week").between(1, weeks) & F.col("__q_wday").between(1, 7),
        monday + 7 * (F.col("__q_week") - 1) + F.col("__q_wday") - 1,
    )
    days = F.when(F.col("__q_week").isNotNull(), iso).when(F.col("__q_yday").isNotNull(), ordinal).otherwise(civil)
    h, mi, se, us, ap, z = (F.col(f"__q_{n}") for n in ("h", "mi", "se", "us", "ap", "abbr"))
    hour = F.when(ap.isNull(), h).when(h.between(1, 12), h % 12 + F.when(ap == "p", 12).otherwise(0))
    # The offset in minutes: numeric, or an abbreviation as used at the place.
    hours, minutes = F.substring(z, 2, 2).cast("int"), F.coalesce(F.nullif(F.translate(F.substring(z, 4, 3), ":", ""), F.lit("")).cast("int"), F.lit(0))
    numeric = F.when((hours <= 18) & (minutes <= 59), (hours * 60 + minutes) * F.when(F.startswith(z, F.lit("-")), -1).otherwise(1))
    lookup = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    special = F.create_map(*[F.lit(x) for tz, own in ABBREVIATIONS_IN.items() for k, v in own.items() for x in (f"{tz} {k}", v)])
    named = F.coalesce(F.try_element_at(special, F.concat_ws(" ", F.col("__q_tz"), z)), F.try_element_at(lookup, z))
    region = F.coalesce(F.col("__q_region"), F.col("__q_tz"))
    work = _once(work, {
        "__q_days": days, "__q_hour": hour,
        "__q_offset": F.when(F.substring(z, 1, 1).isin("+", "-"), numeric).otherwise(named),
        "__q_fixed": z.isNotNull() & ~F.contains(z, F.lit("/")),
        "__q_region2": F.when(region.isin(sorted(n for n in zoneinfo.available_timezones() if "/" in n or n == "UTC")), region),
    })
    hour = F.col("__q_hour")
    clock = F.when(h.isNull(), F.lit(0).cast("bigint")).when(
        mi.between(0, 59) & se.between(0, 59) & (hour.between(0, 23) | ((hour == 24) & (mi == 0) & (se == 0) & (us == 0))),
        (hour * 3600 + mi * 60 + se).cast("bigint") * 1_000_000 + us,
    )
    work = _once(work, {"__q_local": F.col("__q_days").cast("bigint") * 86_400_000_000 + clock})
    local = F.col("__q_local")
    instant = F.when(F.col("__q_fixed"), local - F.col("__q_offset").cast("bigint") * 60_000_000).otherwise(
        F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), F.col("__q_region2")))
    )
    work = _once(work, {"__q_instant": F.when(F.col("__q_ok"), F.coalesce(F.col("__q_epoch"), instant))})
    return work.select(*[F.col(c) for c in rows.columns], F.col("__q_instant").alias(into))
