"""Matching records of two sources without a shared key."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from datetime import date
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.common import bounded_broadcast, cut

# Usual short forms, legal forms, security words, trades and fund styles in security names.
SHORT = {
    "pharma": "pharmaceuticals", "inds": "industries", "grp": "group", "finl": "financial", "utils": "utilities",
    "comm": "communications", "intl": "international", "tech": "technologies", "res": "resources", "pptys": "properties",
    "hldgs": "holdings", "med": "medical", "sys": "systems", "mfg": "manufacturing", "div": "dividend", "em": "emerging markets",
    "smcap": "small cap", "logi": "logistics", "corp": "corporation", "co": "company", "ltd": "limited", "incorporated": "inc",
}
LEGAL = {"inc", "corporation", "company", "limited", "llc", "plc", "sa", "nv", "ag", "se"}
FILLER = {"the", "group", "holdings", "trust", "common", "stock", "shares", "ordinary"}
FUND = {"etf", "fund"}
TRADES = {
    "foods", "energy", "motors", "software", "bancorp", "logistics", "financial", "brands", "industries", "international",
    "pharmaceuticals", "resources", "medical", "systems", "technologies", "manufacturing", "communications", "utilities",
    "properties", "ventures", "services", "pacific", "royalty", "partners", "midstream", "acquisition", "capital", "insurance",
    "growth", "core", "bond", "dividend", "low", "volatility", "value", "ultra", "short", "income", "emerging", "markets",
    "small", "cap", "plus", "advisors",
    "aerospace", "airlines", "automotive", "bank", "biosciences", "biotech", "brewing", "cable", "cement", "chemical", "chemicals",
    "coal", "commodity", "computer", "copper", "cruise", "defense", "diagnostics", "digital", "education", "electric", "electronics",
    "engineering", "entertainment", "environmental", "equity", "exploration", "fashion", "fertilizer", "forest", "gaming", "gas",
    "gold", "grocery", "health", "healthcare", "homes", "hotels", "housing", "infrastructure", "instruments", "interactive",
    "laboratories", "leasing", "lithium", "lumber", "machinery", "marine", "materials", "media", "metals", "minerals", "mining",
    "mortgage", "networks", "oil", "packaging", "paper", "petroleum", "pipeline", "plastics", "power", "products", "publishing",
    "railway", "realty", "reit", "renewable", "restaurants", "retail", "rubber", "savings", "securities", "semiconductor",
    "semiconductors", "shipping", "silver", "solar", "solutions", "steel", "stores", "sugar", "telecom", "textiles", "therapeutics",
    "tobacco", "trading", "transport", "transportation", "travel", "treasury", "uranium", "waste", "water", "wireless",
}
EXCHANGES = {
    "nasdaq": "XNAS", "nasdaqgs": "XNAS", "nasdaqgm": "XNAS", "nasdaqcm": "XNAS", "xnas": "XNAS", "nyse": "XNYS", "xnys": "XNYS",
    "newyorkstockexchange": "XNYS", "nysearca": "ARCX", "arcx": "ARCX", "bats": "BATS", "cboebzx": "BATS", "amex": "XASE",
    "nysemkt": "XASE", "xase": "XASE", "nyseamerican": "XASE", "otc": "OTC", "pink": "OTC", "otcqx": "OTC", "otcqb": "OTC",
}
VOID = {"", "n/a", "na", "none", "null", "-", "--", "unknown"}

_FORMER = re.compile(r"\(?\b(?:formerly|fka|f/k/a)\s+([^)]*)\)?")
_CLASS = re.compile(r"\(\s*([a-e])\s+shares\s*\)|\b(?:class|cl|series)[\s-]+([a-e])\b|\b([a-e]) shares\b")
_ETF = re.compile(r"\bexchange[\s-]traded fund\b")
_TRUST = re.compile(r"^.*\btrust\s+-\s+(.*)$")
_TICKER = re.compile(r"^([A-Z]{1,7})[\s./-]+([A-Z])(\d?)$")

#: MinHash shapes (bands, rows of a band) of the brand with the trade words, and of its first word with a side attribute.
NAME_BANDS, SIDE_BANDS = (64, 5), (16, 3)
#: Letters from which a trade or legal word with one wrong letter is still read as that word.
LONG = 6

#: Weights of a record's identifier and symbol as evidence, from 0 to 1.
WEIGHTS = ("figi_weight", "root_weight")
#: Parsed attributes of a record, all texts ('' where missing), dates as day numbers (-1 where missing).
FIELDS = ("figi", "root", "letter", "digit", "exchange", "brand", "trade", "legal", "class_", "former", "former_trade", "fund", "sic", "day", "alive")


def plain(text: str | None) -> str:
    """Lower case ASCII letters without outer blanks; void texts are empty."""
    if not text:
        return ""
    s = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower().strip()
    return "" if s in VOID else s


def _without_one(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


_NEAR = {v: w for w in sorted(TRADES | LEGAL | set(SHORT)) if len(w) >= LONG for v in (*_without_one(w), w)}


@lru_cache(maxsize=100_000)
def spelled(word: str) -> str:
    """The trade, legal or short word that this one is, or is with one letter wrong, missing, added or two swapped; else itself."""
    if word in TRADES or word in LEGAL or word in SHORT or len(word) < LONG:
        return word
    return next((_NEAR[v] for v in (word, *sorted(_without_one(word))) if v in _NEAR), word)


def _words(text: str) -> tuple[str, str, str, str]:
    """(brand, trade words, legal form, fund word) of a name without class and former name."""
    words: list[str] = []
    for w in re.sub(r"[^a-z0-9]+", " ", re.sub(r"[.']", "", text)).split():
        w = spelled(w)
        words.extend(SHORT.get(w, w).split())
    brand = [w for w in words if w not in LEGAL and w not in FILLER and w not in FUND and w not in TRADES]
    legal = [w for w in words if w in LEGAL]
    fund = [w for w in words if w in FUND]
    return " ".join(brand), " ".join(sorted({w for w in words if w in TRADES})), legal[-1] if legal else "", fund[-1] if fund else ""


def parse(figi, ticker, exchange, name, kind, sic, day, alive) -> tuple:
    """The attributes of one record in the order of ``FIELDS``."""
    figi = plain(figi).upper()
    n = plain(name)
    former = former_trade = ""
    if m := _FORMER.search(n):
        former, former_trade, _, _ = _words(m[1])
        n = n[: m.start()] + " " + n[m.end() :]
    letter_of_name = ""
    if m := _CLASS.search(n):
        letter_of_name = next(g for g in m.groups() if g)
        n = n[: m.start()] + " " + n[m.end() :]
    n = _ETF.sub("etf", n)
    if m := _TRUST.match(n):
        n = m[1]
    brand, trade, legal, fund_word = _words(n)
    t = plain(ticker).upper()
    root, letter, digit = re.sub(r"\s+", "", t), "", ""
    if m := _TICKER.match(t):
        root, letter, digit = m.groups()
    elif root[-1:].isdigit() and root[:-1].isalpha():
        root, digit = root[:-1], root[-1]
    k = plain(kind)
    fund = "1" if "etf" in k or "fund" in k or (not k and fund_word) else "0" if k or legal else ""
    if not letter and not letter_of_name and ("primary class" in k or "secondary class" in k) and len(root) > 2:
        # A class letter that is glued to the symbol or nowhere; the class itself stays unknown.
        letter_of_name = "?" if root[-1] not in "ABCDE" else root[-1].lower()
    d = -1
    if day:
        try:
            d = date.fromisoformat(day.strip()[:10]).toordinal()
        except ValueError:
            d = -1
    code = re.sub(r"[^a-z]", "", plain(exchange))
    return (
        figi if len(figi) == 12 else "", root, letter, digit, EXCHANGES.get(code, code.upper()), brand, trade, legal or fund_word,
        letter_of_name or letter.lower(), former, former_trade, fund, "" if sic is None else str(sic).strip(), d, plain(alive),
    )


@lru_cache(maxsize=8)
def _hashes(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = [zlib.crc32(f"{bands}.{rows}.{i}".encode()) for i in range(2 * bands * rows)]
    return np.array(seeds[::2], np.uint64) << np.uint64(4) | np.uint64(1), np.array(seeds[1::2], np.uint64)


def _mixed(v: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers of others, by shifts and multiplications modulo 2 ** 64."""
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


@lru_cache(maxsize=200_000)
def bands(text: str, shape: tuple[int, int]) -> np.ndarray:
    """MinHash band values of a text's letter pairs; ``shape`` is the number of bands and the rows of each."""
    text = f"^{text.replace(' ', '')}$"
    grams = {text[i : i + 2] for i in range(len(text) - 1)}
    x = np.fromiter((zlib.crc32(g.encode()) for g in grams), np.uint64, len(grams))
    a, b = _hashes(*shape)
    h = ((a[:, None] * x[None, :] + b[:, None]) % np.uint64(4294967291)).min(axis=1).reshape(shape)
    return _mixed(h @ a[: shape[1]] + _mixed(b[: shape[0]]))  # the rows of a band and its number as one


def keys(r: tuple, name_bands: tuple[int, int] = NAME_BANDS, side_bands: tuple[int, int] = SIDE_BANDS) -> tuple[np.ndarray, np.ndarray]:
    """Blocking keys of a parsed record across its attributes as 64-bit numbers (a collision only adds a candidate); records
    with the same identifier are paired apart from these.

    First: symbol with and without class letter, and of the present and the former name MinHash bands of the brand together
    with the trade words. Second, which find names whose trade words are written otherwise: bands of the brand's first
    word together with the month of the first day (months overlap by 16 days) or with industry code and exchange.
    """
    _, root, letter, _, exchange, brand, trade, _, class_, former, former_trade, _, sic, day, _ = r
    symbols = []
    if root:
        symbols.append(f"t:{root}")
        if letter:
            symbols.append(f"t:{root}{letter}")
        elif class_ and root[-1].lower() == class_ and len(root) > 2:
            symbols.append(f"t:{root[:-1]}")
    first, second = [np.array([hashed(t) for t in symbols], np.uint64)], []
    sides = [hashed(f"d:{m}") for m in sorted({(day + k) // 30 for k in (-8, 8)})] if day >= 0 else []
    if sic and exchange:
        sides.append(hashed(f"s:{sic}:{exchange}"))
    for b, t in ((brand, trade), (former, former_trade)):
        if b:
            first.append(_mixed(bands(b, name_bands) ^ np.uint64(hashed(f"m:{t}"))))
            if sides:
                head = bands(b.split()[0], side_bands)
                second.append(_mixed(np.array(sides, np.uint64)[:, None] ^ head).ravel())
    signed = lambda parts: np.concatenate([np.array([], np.uint64), *parts]).view(np.int64)
    return signed(first), signed(second)


@lru_cache(maxsize=200_000)
def hashed(key: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(key)


@lru_cache(maxsize=200_000)
def alike(a: str, b: str) -> float:
    """Similarity of two texts from 0 to 1; 0 stands for any below 0.8, which is never told apart."""
    if a == b:
        return 1.0
    whole = len(a) + len(b)
    # Cheap upper bounds first: lengths, then common letters.
    if 2 * min(len(a), len(b)) < 0.8 * whole or 2 * sum(min(a.count(c), b.count(c)) for c in set(a)) < 0.8 * whole:
        return 0.0
    s = SequenceMatcher(None, a, b, autojunk=False).ratio()
    return s if s >= 0.8 else 0.0


def _initials(short: str, brand: str, trade: str) -> bool:
    """Whether ``short`` may be letters taken in order from the brand and then the trade words."""
    if not 2 <= len(short) <= 5 or not brand or short[0] != brand[0]:
        return False
    rest = iter(brand.replace(" ", "") + trade.replace(" ", ""))
    return all(c in rest for c in short)


def _of_brand(root: str, brand: str) -> bool:
    """Whether a symbol uses letters of the brand only, from its first letter on."""
    return bool(brand) and root[:1].lower() == brand[0] and set(root.lower()) <= set(brand)


NAMES = (
    "name_same", "name_near", "name_trade_differs", "name_trade_subset", "name_short", "name_former", "name_missing", "name_other",
    "legal_same", "legal_differs", "symbol_same", "symbol_both_spelled", "symbol_changed", "symbol_missing",
    "class_same", "class_differs", "class_one", "day_same", "day_near", "day_months", "day_year", "day_far", "sic_same", "sic_differs",
    "exchange_same", "exchange_differs", "kind_differs", "alive_differs", "name_and_symbol_same", "other_name_and_far",
    "near_name_spelled", "subset_and_symbol_same", "other_name_symbol_and_sic_same",
)
#: Which features tell of the symbol; their evidence goes with the symbol's weight.
OF_SYMBOL = np.array([n.startswith("symbol_") or "and_symbol" in n or "name_symbol" in n or n == "near_name_spelled" for n in NAMES])
#: Share of the names up to which a value that different names carry keeps its whole weight.
FREE = 0.01
#: Log-odds expected of each feature before any data; the fit starts from them and is drawn to them.
PRIOR = dict(
    bias=-3.0, name_same=3.0, name_near=2.2, name_trade_differs=-2.5, name_trade_subset=-1.0, name_short=2.0, name_former=2.5, name_missing=0.0, name_other=-2.5,
    legal_same=0.6, legal_differs=-1.2, symbol_same=3.5, symbol_both_spelled=-3.0, symbol_changed=-0.8, symbol_missing=0.0,
    class_same=0.5, class_differs=-7.0, class_one=-2.5, day_same=3.0, day_near=2.0, day_months=1.0, day_year=0.0, day_far=-4.0,
    sic_same=0.6, sic_differs=-1.2, exchange_same=0.8, exchange_differs=-1.2, kind_differs=-5.0, alive_differs=-0.3,
    name_and_symbol_same=1.0, other_name_and_far=-2.0, near_name_spelled=-1.0, subset_and_symbol_same=1.0,
    other_name_symbol_and_sic_same=1.5,
)


def features(a: tuple, b: tuple) -> list[float]:
    """Evidence of a pair of parsed records, in the order of ``NAMES``; the identifier is left out."""
    _, root_a, let_a, _, ex_a, br_a, tr_a, le_a, cl_a, fo_a, ft_a, fu_a, si_a, da_a, al_a = a
    _, root_b, let_b, _, ex_b, br_b, tr_b, le_b, cl_b, fo_b, ft_b, fu_b, si_b, da_b, al_b = b
    f = dict.fromkeys(NAMES, 0.0)
    s = alike(br_a, br_b) if br_a and br_b else 0.0
    if not (br_a or tr_a) or not (br_b or tr_b):
        name = "name_missing"
    elif s >= 0.8 and tr_a == tr_b:
        name = "name_same" if s == 1.0 else "name_near"
    else:
        whole_a, whole_b = f"{br_a} {tr_a}", f"{br_b} {tr_b}"
        cut_a, cut_b = br_a.split(), br_b.split()
        head = bool(cut_a and cut_b) and alike(cut_a[0], cut_b[0]) >= 0.8
        # A cut name: its last word begins one of the other's trade words, or it ends inside the brand.
        tail_a = bool(cut_a[1:]) and any(w.startswith(cut_a[-1]) for w in tr_b.split())
        tail_b = bool(cut_b[1:]) and any(w.startswith(cut_b[-1]) for w in tr_a.split())
        short = (head and (tail_a or tail_b or (not tr_a) != (not tr_b) or (len(tr_a) != len(tr_b) and (tr_a in tr_b or tr_b in tr_a) and (not le_a) != (not le_b) and s < 1.0))) or (
            min(len(br_a), len(br_b)) >= 6 and (whole_a.strip().startswith(br_b) and not tr_b or whole_b.strip().startswith(br_a) and not tr_a)
        )
        if (fo_a and alike(fo_a, br_b) >= 0.8 and (ft_a == tr_b or not tr_b)) or (fo_b and alike(fo_b, br_a) >= 0.8 and (ft_b == tr_a or not tr_a)):
            name = "name_former"
        elif short or (_initials(br_a, br_b, tr_b) and not tr_a) or (_initials(br_b, br_a, tr_a) and not tr_b):
            name = "name_short"
        elif s >= 0.8:
            parts_a, parts_b = set(tr_a.split()), set(tr_b.split())
            name = "name_trade_subset" if parts_a <= parts_b or parts_b <= parts_a else "name_trade_differs"
        else:
            name = "name_other"
    f[name] = 1.0
    if le_a and le_b:
        f["legal_same" if le_a == le_b else "legal_differs"] = 1.0
    same_symbol = False
    if not root_a or not root_b:
        f["symbol_missing"] = 1.0
    elif root_a == root_b or root_a + let_a == root_b or root_b + let_b == root_a:
        f["symbol_same"], same_symbol = 1.0, True
    elif _of_brand(root_a, br_a or br_b) and _of_brand(root_b, br_b or br_a):
        f["symbol_both_spelled"] = 1.0
    else:
        f["symbol_changed"] = 1.0
    if cl_a or cl_b:
        f["class_one" if not cl_a or not cl_b else "class_same" if cl_a == cl_b or "?" in (cl_a, cl_b) else "class_differs"] = 1.0
    far = False
    if da_a >= 0 and da_b >= 0:
        gap = abs(da_a - da_b)
        far = gap > 800
        f["day_same" if gap <= 7 else "day_near" if gap <= 45 else "day_months" if gap <= 180 else "day_far" if far else "day_year"] = 1.0
    if si_a and si_b:
        f["sic_same" if si_a == si_b else "sic_differs"] = 1.0
    if ex_a and ex_b:
        f["exchange_same" if ex_a == ex_b else "exchange_differs"] = 1.0
    f["kind_differs"] = float(bool(fu_a and fu_b) and fu_a != fu_b)
    f["alive_differs"] = float(bool(al_a and al_b) and al_a != al_b)
    f["name_and_symbol_same"] = float(same_symbol and name in ("name_same", "name_near", "name_former", "name_short"))
    f["other_name_and_far"] = float(far and name in ("name_other", "name_trade_differs", "name_trade_subset"))
    f["subset_and_symbol_same"] = float(same_symbol and name == "name_trade_subset")
    f["other_name_symbol_and_sic_same"] = float(same_symbol and name == "name_other" and f["sic_same"] > 0)
    f["near_name_spelled"] = float(name == "name_near" and f["symbol_both_spelled"] > 0)
    return [f[n] for n in NAMES]


def identifier_distance(a: str, b: str) -> int:
    """-1 if one is missing, 0 if equal, 1 if one character or two neighbours differ, else 2."""
    if not a or not b:
        return -1
    wrong = [i for i in range(len(a)) if a[i] != b[i]]
    swapped = len(wrong) == 2 and wrong[1] == wrong[0] + 1 and a[wrong[0]] == b[wrong[1]] and a[wrong[1]] == b[wrong[0]]
    return 0 if not wrong else 1 if len(wrong) == 1 or swapped else 2


#: Expected shares of equal, near and other identifiers among pairs that mean the same and among those that don't, and
#: how many pairs the expectation counts for.
SAME_ID, OTHER_ID, EXPECTED = (0.92, 0.04, 0.04), (0.02, 0.002, 0.978), 50.0


@dataclass(frozen=True)
class Model:
    """Weights of the logistic classifier, its calibration, and the log-odds of an equal, near and other identifier.

    ``alone`` are those of a pair that no symbol or name block found: that its identifier agrees may be why it is a pair.
    """

    weights: tuple[float, ...]
    scale: float = 1.0
    shift: float = 0.0
    identifier: tuple[float, float, float] = tuple(math.log(s / o) for s, o in zip(SAME_ID, OTHER_ID, strict=True))
    alone: tuple[float, float, float] = identifier

    def probability(self, x: np.ndarray, distance: np.ndarray, trust: np.ndarray | float = 1.0, blind: np.ndarray | bool = True) -> np.ndarray:
        """``trust`` is the weight of the identifiers' evidence, from 0 to 1."""
        z = self.scale * (self.weights[0] + x @ np.asarray(self.weights[1:])) + self.shift
        odds = np.where(np.asarray(blind)[..., None], self.identifier, self.alone)
        odds = np.where(distance >= 0, np.take_along_axis(np.broadcast_to(odds, (len(z), 3)), np.maximum(distance, 0)[:, None], 1)[:, 0], 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(z + trust * odds, -30, 30)))


def identifier_odds(p: np.ndarray, distance: np.ndarray) -> tuple[float, float, float]:
    """Log-odds of an equal, near and other identifier, from the probabilities ``p`` that all other evidence gives.

    The shares of the three among pairs that mean the same and those that don't are the most likely ones (expectation
    maximisation) given ``p``, drawn to the expected shares as by ``EXPECTED`` pairs of each; so a pair's sum of
    calibrated evidence and these log-odds is calibrated as far as the identifier errs independently.
    """
    same, other = np.array(SAME_ID), np.array(OTHER_ID)
    counted = lambda w: np.bincount(distance, w, 3)
    for _ in range(200):
        ratio = same[distance] / other[distance]
        q = p * ratio / (p * ratio + 1 - p)
        new = [(counted(w) + EXPECTED * np.array(prior)) / (w.sum() + EXPECTED) for w, prior in ((q, SAME_ID), (1 - q, OTHER_ID))]
        done = max(abs(new[0] - same).max(), abs(new[1] - other).max()) < 1e-9
        same, other = new
        if done:
            break
    return tuple(float(v) for v in np.log(same / other))


def _newton(x: np.ndarray, y: np.ndarray, start: np.ndarray, pull: np.ndarray, noise: float) -> np.ndarray:
    """Logistic weights drawn to ``start``; weak labels are taken as flipped with probability ``noise``."""
    w = start.copy()
    for _ in range(200):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        right, wrong = p * (1 - noise), p * noise
        q = np.where(y, right / (right + (1 - p) * noise), wrong / (wrong + (1 - p) * (1 - noise)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - q) + pull * (w - start))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(x: np.ndarray, distance: np.ndarray, fold: np.ndarray, noise: float = 0.05) -> Model:
    """Fit on weakly labelled pairs: those with an identifier on both sides, positive if it is equal or near.

    The identifier itself is no feature, so its agreement is a label that is independent of the evidence; about
    ``noise`` of the identifiers are wrong. Four fifths of the pairs fit the weights, one fifth calibrates them, and the
    log-odds of the identifier come from all of them.
    """
    start = np.array([PRIOR["bias"], *(PRIOR[n] for n in NAMES)])
    if not len(x):
        return Model(tuple(start))
    y = distance <= 1
    one = np.hstack([np.ones((len(x), 1)), x])
    train = fold % 5 != 0
    w = _newton(one[train], y[train], start, np.ones(len(start)), noise)
    held = one[~train] @ w
    a, b = _newton(np.column_stack([held, np.ones(len(held))]), y[~train], np.array([1.0, 0.0]), np.array([50.0, 10.0]), noise) if len(held) else (1.0, 0.0)
    model = Model(tuple(float(v) for v in w), float(max(a, 0.1)), float(b))
    evidence = model.probability(x, np.full(len(x), -1))
    return replace(model, identifier=identifier_odds(evidence, distance))


_PARSED = "rec_id bigint, sig string, " + ", ".join(f"{n} {'int' if n == 'day' else 'string'}" for n in FIELDS)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for b in batches:
        rows = [parse(*r) for r in zip(*(b.column(i).to_pylist() for i in range(1, 9)), strict=True)]
        sigs = [hashlib.md5("\x1f".join(map(str, r)).encode()).hexdigest() for r in rows]
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sigs, pa.string()), *(pa.array(c, pa.int32() if n == "day" else pa.string()) for n, c in zip(FIELDS, cols, strict=True))],
            names=["rec_id", "sig", *FIELDS],
        )


def _key_batches(batches: Iterator[pa.RecordBatch], *shapes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    for b in batches:
        both = [keys(r, *shapes) for r in zip(*(b.column(i).to_pylist() for i in range(1, len(FIELDS) + 1)), strict=True)]
        blocks = [pa.array([ks[i] for ks in both], kind) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([b.column(0), *blocks, b.column(1)], names=["rep", "blocks", "side", "figi"])


def packed(x: list[float]) -> int:
    """The features, all 0 or 1, as the bits of a number."""
    return sum(1 << i for i, v in enumerate(x) if v)


def unpacked(masks: np.ndarray) -> np.ndarray:
    return ((masks[:, None] >> np.arange(len(NAMES))) & 1).astype(float)


def weighed(x: np.ndarray, symbol_weight: np.ndarray) -> np.ndarray:
    """The features with those of the symbol lowered to its weight."""
    return np.where(OF_SYMBOL, x * symbol_weight[:, None], x)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = len(FIELDS)
    for b in batches:
        a_rows = zip(*(b.column(i).to_pylist() for i in range(3, 3 + n)), strict=True)
        b_rows = zip(*(b.column(i).to_pylist() for i in range(3 + n, 3 + 2 * n)), strict=True)
        xs, ds = [], []
        for x, y in zip(a_rows, b_rows, strict=True):
            xs.append(packed(features(x, y)))
            ds.append(identifier_distance(x[0], y[0]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(ds, pa.int32()), pa.array(xs, pa.int64()), b.column(3 + 2 * n), b.column(4 + 2 * n)],
            names=["rep_a", "rep_b", "blind", "distance", "x", *WEIGHTS],
        )


def _score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = weighed(unpacked(b.column(4).to_numpy()), b.column(6).to_numpy())
        blind = b.column(2).to_numpy(zero_copy_only=False)
        p = model.probability(x, b.column(3).to_numpy(), b.column(5).to_numpy(), blind)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p)], names=["rep_a", "rep_b", "confidence"])


def records(df: DataFrame, *, rec_id: Column, figi: Column, ticker: Column, exchange: Column, name: Column, kind: Column, sic: Column, day: Column, alive: Column) -> DataFrame:
    """Parsed records (rec_id, sig, attributes); ``alive`` is a text, equal texts agree. Rows without rec_id are left out."""
    text = [c.cast("string") for c in (figi, ticker, exchange, name, kind, sic, day, alive)]
    return df.select(rec_id.cast("bigint").alias("rec_id"), *[c.alias(f"c{i}") for i, c in enumerate(text)]).where("rec_id is not null").mapInArrow(
        _parse_batches, _PARSED
    )


def _distinct(parsed: DataFrame) -> DataFrame:
    """One row (rep, attributes, sig) per set of equal attributes; rep is its least rec_id."""
    return parsed.groupBy("sig").agg(F.min("rec_id").alias("rep"), *[F.first(n).alias(n) for n in FIELDS])


def _with_weights(a: DataFrame, b: DataFrame, shared: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the ``WEIGHTS`` of their records.

    A value that other names than its usual one carry tells the less, the greater their share of all names. Spellings
    of the usual name, cut or misspelt, aren't other names: a security that is repeated often keeps its value.
    """
    named = a.select("figi", "root", "brand").unionByName(b.select("figi", "root", "brand")).where("brand <> ''")
    names = named.select("brand").distinct().count() + shared
    for name, weight in zip(("figi", "root"), WEIGHTS, strict=True):
        counted = named.where(F.col(name) != "").groupBy(F.col(name).alias("value"), "brand").count()
        usual = counted.groupBy("value").agg(F.max_by("brand", F.struct("count", "brand")).alias("usual"), F.count(F.lit(1)).alias("n")).where(F.col("n") - 1 > FREE * names)
        far = F.levenshtein("brand", "usual") > F.greatest(F.length("brand"), F.length("usual")) / 2
        other = far & ~F.col("brand").startswith(F.col("usual")) & ~F.col("usual").startswith(F.col("brand"))
        share = F.count(F.when(other, F.lit(1))) / F.lit(float(names))
        # Each carries more than a fixed share of the names, so these are few.
        low = cut(counted.join(bounded_broadcast(usual, 100_000), "value").groupBy("value").agg(share.alias("share")).where(F.col("share") > FREE))
        low = bounded_broadcast(low.select("value", (F.ln("share") / math.log(FREE)).alias("low")), 100_000)
        a, b = (d.join(low, F.col(name) == F.col("value"), "left").withColumn(weight, F.coalesce("low", F.lit(1.0))).drop("value", "low") for d in (a, b))
    return a, b


def _whole(ka: DataFrame, kb: DataFrame, most: int) -> DataFrame:
    """Every pair (rep_a, rep_b, blind) of the rows (rep_a, k, blind) and (rep_b, k) with the same k.

    A block of more than ``most`` pairs is spread over a grid of cells that have about as many each.
    """
    both = ka.select("k", F.lit(1).alias("na"), F.lit(0).alias("nb")).unionByName(kb.select("k", F.lit(0).alias("na"), F.lit(1).alias("nb")))
    sizes = both.groupBy("k").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    large = cut(sizes.where(F.col("na") * F.col("nb") > most))
    if large.isEmpty():
        return ka.join(kb, "k").select("rep_a", "rep_b", "blind")
    side = max(1.0, most**0.5)
    parts = lambda n: F.coalesce(F.ceil(F.col(n) / F.lit(side)), F.lit(1).cast("bigint"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), parts(n) - 1))
    own = lambda rep, n: F.pmod(F.xxhash64(rep), parts(n))
    ca = ka.join(large, "k", "left").select("rep_a", "blind", "k", own("rep_a", "na").alias("i"), each("nb").alias("j"))
    cb = kb.join(large, "k", "left").select("rep_b", "k", each("na").alias("i"), own("rep_b", "nb").alias("j"))
    return ca.join(cb, ["k", "i", "j"]).select("rep_a", "rep_b", "blind")


def _judged(joined: DataFrame, blind: Column) -> DataFrame:
    """(rep_a, rep_b, blind, distance, x) of pairs with the attributes of both sides."""
    weights = [F.least(f"{n}_a", f"{n}_b").alias(n) for n in WEIGHTS]
    narrow = joined.select("rep_a", "rep_b", blind.alias("blind"), *[f"{n}_a" for n in FIELDS], *[f"{n}_b" for n in FIELDS], *weights)
    return narrow.mapInArrow(_feature_batches, "rep_a bigint, rep_b bigint, blind boolean, distance int, x bigint, " + ", ".join(f"{n} double" for n in WEIGHTS))


def _scored(judged: DataFrame, model: Model) -> DataFrame:
    return judged.mapInArrow(lambda it: _score_batches(it, model), "rep_a bigint, rep_b bigint, confidence double")


def _without_rivals(scored: DataFrame, named, da: DataFrame, db: DataFrame, model: Model, margin: float) -> DataFrame:
    """Pairs whose record has no clearly better partner that means something else.

    A pair that is ``margin`` log-odds weaker than its record's best pair stays only if the two partners, judged
    by the same classifier inside their source, mean the same thing (a source may repeat a thing).
    """
    odds = F.ln(F.col("confidence") / (1 - F.least(F.col("confidence"), F.lit(1 - 1e-12))))
    pairs = scored.withColumn("odds", odds)
    out = pairs
    for own, other, side in (("rep_b", "rep_a", da), ("rep_a", "rep_b", db)):
        best = pairs.groupBy(own).agg(F.max(F.struct("odds", other)).alias("top")).select(own, F.col("top.odds").alias("most"), F.col(f"top.{other}").alias("best"))
        weak = pairs.join(best, own).where((F.col(other) != F.col("best")) & (F.col("most") - F.col("odds") >= margin)).select(own, other, "best")
        two = weak.select(F.col(other).alias("rep_a"), F.col("best").alias("rep_b")).distinct()
        joined = two.join(named(side, "a"), "rep_a").join(named(side, "b"), "rep_b")
        differ = _scored(_judged(joined, F.lit(False)), model).where("confidence < 0.5").select(F.col("rep_a").alias(other), F.col("rep_b").alias("best"))
        out = out.join(weak.join(differ, [other, "best"]).select(own, other), [own, other], "left_anti")
    return out.select("rep_a", "rep_b", "confidence")


def match_records(left: DataFrame, right: DataFrame, *, threshold: float = 0.5, max_labelled: int = 20_000, block_pairs: int = 40_000, shared: int = 50, margin: float = 2.0, name_bands: tuple[int, int] = NAME_BANDS, side_bands: tuple[int, int] = SIDE_BANDS) -> DataFrame:
    """(rec_a, rec_b, confidence): pairs of a left and a right record that mean the same thing.

    ``left`` and ``right`` come from :func:`records`. Every pair of rows is listed, repeats of a record too.

    Method: candidates share a block: the identifier, the symbol, or a MinHash band of the brand part of the
    present or former name together with trade words, first month, or industry code and exchange (:func:`keys`). Each
    candidate pair gets similarity features of
    name, legal form, symbol, share class, dates, industry code, exchange and kind. A logistic classifier is
    fitted on weak labels (agreement of the identifier where both have one, which is no feature, among pairs that
    the other blocks found) with priors on its weights, noise-aware, and calibrated on a held-out fifth; the identifier
    adds log-odds that are fitted on the same pairs (:func:`identifier_odds`).
    ``confidence`` is the calibrated probability; pairs below ``threshold`` are left out, and so are pairs of a record
    that has a partner better by ``margin`` log-odds which means something else.

    Every identifier and symbol is a block, however many records carry it. As evidence it is lowered by the share of
    the names that carry it besides its usual one: whole up to ``FREE``, none where all do (a placeholder).
    ``shared`` names more than there are count in that share, so that a few records prove little.

    Scale: rows that agree in every parsed attribute are one class, so copies cost one comparison. Blocks are
    counted before they are joined; all are joined whole, one with more than ``block_pairs`` pairs spread over cells of
    about as many pairs, which changes no result. Parsed records and features are checkpointed in the shared folder. The
    fit collects about ``max_labelled`` pairs (those whose hash is below a threshold, whatever the number of tasks),
    everything else covers all rows. ``name_bands`` and ``side_bands`` are the MinHash shapes: more rows a band mean fewer
    candidates between different names, more bands fewer misspelt names lost.

    Defined cases: any attribute may be null, empty or void; a row without identifier, symbol and name matches
    nothing; of equally good partners all stay; an empty side gives an empty result.
    """
    left, right = cut(left), cut(right)
    da, db = (cut(d) for d in _with_weights(_distinct(left), _distinct(right), shared))
    schema = "rep bigint, blocks array<bigint>, side array<bigint>, figi string"
    ka, kb = (cut(d.select("rep", *FIELDS).mapInArrow(lambda it: _key_batches(it, name_bands, side_bands), schema)) for d in (da, db))
    # Pairs found by the identifier or a side attribute alone are judged too, but the fit must not see them: that
    # evidence chose them.
    kinds = ((F.explode("blocks"), True), (F.explode("side"), False), (F.xxhash64(F.lit("figi"), F.nullif("figi", F.lit(""))), False))

    def side(d: DataFrame, s: str) -> DataFrame:
        parts = [(d.where("figi <> ''") if i == 2 else d).select(F.col("rep").alias(f"rep_{s}"), k.alias("k"), F.lit(blind).alias("blind")) for i, (k, blind) in enumerate(kinds)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    pairs = _whole(side(ka, "a"), side(kb, "b").drop("blind"), block_pairs).groupBy("rep_a", "rep_b").agg(F.max("blind").alias("blind"))
    named = lambda d, s: d.select(F.col("rep").alias(f"rep_{s}"), *[F.col(n).alias(f"{n}_{s}") for n in (*FIELDS, *WEIGHTS)])
    joined = pairs.join(named(da, "a"), "rep_a").join(named(db, "b"), "rep_b")
    judged = cut(_judged(joined, F.col("blind")))
    # An identifier of lowered weight is no label. The rows below a threshold of their hash are about ``max_labelled``.
    labelled = judged.where("distance >= 0 and blind and figi_weight = 1").select("distance", "x", "root_weight", F.xxhash64("rep_a", "rep_b").alias("h"))
    share = min(1.0, max_labelled / max(1, labelled.count()))
    sample = sorted(labelled.where(F.pmod(F.col("h"), F.lit(1 << 30)) < int(share * (1 << 30))).collect())
    masks, distance, fold = (np.array([r[c] for r in sample], np.int64) for c in ("x", "distance", "h"))
    model = fit(weighed(unpacked(masks), np.array([r["root_weight"] for r in sample], float)), distance, fold >> 32)
    scored = _scored(judged, model).where(F.col("confidence") >= threshold)
    kept = _without_rivals(cut(scored), named, da, db, model, margin)
    members = lambda p, d, s: p.select("sig", F.col("rec_id").alias(f"rec_{s}")).join(d.select("sig", F.col("rep").alias(f"rep_{s}")), "sig").drop("sig")
    return kept.join(members(left, da, "a"), "rep_a").join(members(right, db, "b"), "rep_b").select("rec_a", "rec_b", "confidence")
