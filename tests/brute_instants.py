"""A plain Python reading of one timestamp text, for tests."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

MON = {m: i + 1 for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())}
ABBR = {"GMT": 0, "EST": -300, "EDT": -240, "IST": 330, "JST": 540, "BST": 60, "CET": 60, "CEST": 120, "AEST": 600, "AEDT": 660, "UTC": 0}
EPOCH = datetime(1970, 1, 1)


def micros(d: datetime) -> int:
    return (d - EPOCH) // timedelta(microseconds=1)


def brute(raw: str | None, tz: str | None, day_first: bool) -> int | None:
    if raw is None:
        return None
    s = raw.strip()
    if s.isdigit():
        if len(s) in (10, 13, 16):
            return int(s) * 10 ** (16 - len(s))
        if len(s) not in (6, 8):
            return None
        s = f"{s[:4]}-{s[4:6]}-{s[6:] or '01'}"
    if m := re.fullmatch(r"(\d{4})(\d\d)(\d\d)[T ](\d\d)(\d\d)(\d\d)(Z?)", s):
        s = "{}-{}-{}T{}:{}:{}{}".format(*m.groups())
    zone = None
    if m := re.search(r"\[(.*)\]$", s):
        zone, s = m[1], s[: m.start()]
    offset = None
    if m := re.search(r"(?<=[\d ])(Z|z|GMT|UTC|EST|EDT|IST|JST|BST|CES?T|AE[SD]T)$", s):
        offset, s = ABBR[m[1]] if len(m[1]) > 1 else 0, s[: m.start()].strip()
    elif m := re.search(r"(?<=\d\d) ?([+-])(\d\d):?(\d\d)$", s):
        if ":" in s[: m.start()]:
            offset, s = (1 if m[1] == "+" else -1) * (int(m[2]) * 60 + int(m[3])), s[: m.start()].strip()
    us = 0
    if m := re.search(r"(?<=:\d\d)[.,](\d+)$", s):
        us, s = int((m[1] + "000000")[:6]), s[: m.start()]
    clock = (0, 0, 0)
    if m := re.search(r"[Tt ](\d{1,2}):(\d\d)(?::(\d\d))?( [AP]M)?$", s):
        h = int(m[1])
        if m[4]:
            h = h % 12 + (12 if m[4] == " PM" else 0)
        clock, s = (h, int(m[2]), int(m[3] or 0)), s[: m.start()]
    try:
        if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", s):
            d = date(*map(int, m.groups()))
        elif m := re.fullmatch(r"(\d{4})-W(\d\d)-(\d)", s):
            d = date.fromisocalendar(*map(int, m.groups()))
        elif m := re.fullmatch(r"(\d{4})-(\d{3})", s):
            d = date(int(m[1]), 1, 1) + timedelta(int(m[2]) - 1)
            if d.year != int(m[1]):
                return None
        elif m := re.fullmatch(r"(\d\d?)/(\d\d?)/(\d{4})", s):
            a, b, y = map(int, m.groups())
            d = date(y, b, a) if day_first else date(y, a, b)
        elif m := re.fullmatch(r"(\d\d?)\.(\d\d?)\.(\d{4})", s):
            d = date(int(m[3]), int(m[2]), int(m[1]))
        elif m := re.fullmatch(r"(\d\d)-([A-Z][a-z]{2})-(\d\d)", s):
            d = date(2000 + int(m[3]), MON[m[2]], int(m[1]))
        elif m := re.fullmatch(r"([A-Z][a-z]{2}) (\d\d?), (\d{4})", s):
            d = date(int(m[3]), MON[m[1]], int(m[2]))
        elif m := re.fullmatch(r"[A-Z][a-z]{2}, (\d\d) ([A-Z][a-z]{2}) (\d{4})", s):
            d = date(int(m[3]), MON[m[2]], int(m[1]))
        else:
            return None
    except ValueError:
        return None
    if clock[0] > 24 or clock[1] > 59 or clock[2] > 59 or (clock[0] == 24 and (clock[1:] != (0, 0) or us)):
        return None
    local = datetime(d.year, d.month, d.day) + timedelta(hours=clock[0], minutes=clock[1], seconds=clock[2], microseconds=us)
    if offset is not None:
        return micros(local) - offset * 60_000_000
    off = local.replace(tzinfo=ZoneInfo(zone or tz or "America/New_York"), fold=0).utcoffset()
    return micros(local - off)
