import numpy as np
import pytest

pytest.importorskip("quillon.llm")
from quillon.llm import matching as m  # noqa: E402

DDL = "rec_id int, figi string, ticker string, exchange string, name string, kind string, sic string, day string, alive string, confidence string"


def recs(spark, rows):
    d = spark.createDataFrame(rows, DDL)
    return m.records(d, **{c: d[c] for c in ("rec_id", "figi", "ticker", "exchange", "name", "kind", "sic", "day", "alive")})


def one(i, name=None, ticker=None, exchange="XNYS", day="2001-02-03", figi=None, kind="CS", sic="2834"):
    return (i, figi, ticker, exchange, name, kind, sic, day, "y", "")


def test_parse():
    p = dict(zip(m.FIELDS, m.parse("zzg4bp4hhhxv", "JUDT.A", "New York Stock Exchange", "The Jorurdrént Foods Corp. (A shares) (formerly Oldname Inds)", "CS", "3510", "2001-02-03", "y"), strict=True))
    assert p["brand"] == "jorurdrent" and p["trade"] == "foods" and p["legal"] == "corporation" and p["class_"] == "a" and p["exchange"] == "XNYS"
    assert p["root"] == "JUDT" and p["letter"] == "A" and p["former"] == "oldname" and p["former_trade"] == "industries" and p["figi"] == "ZZG4BP4HHHXV"
    f = dict(zip(m.FIELDS, m.parse(None, " abc1 ", None, "Lum Trust - Lum EM Exchange Traded Fund", "ETF", None, "bad", None), strict=True))
    assert f["brand"] == "lum" and f["trade"] == "emerging markets" and f["legal"] == "etf" and f["root"] == "ABC" and f["digit"] == "1" and f["day"] == -1 and f["fund"] == "1"
    assert m.parse(None, None, None, "N/A", None, None, None, None)[5] == ""


def test_identifier_distance():
    assert [m.identifier_distance("ABCDEF", x) for x in ("", "ABCDEF", "ABCDEX", "ABDCEF", "XBCDEX")] == [-1, 0, 1, 1, 2]


def test_blocks_find_misspelt_brands():
    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    hit = 0
    for _ in range(300):
        b = "".join(rng.choice(letters, 10))
        i = rng.integers(1, 8)
        typo = b[:i] + b[i + 1] + b[i] + b[i + 2 :]
        hit += bool((m.bands(b, m.NAME_BANDS) == m.bands(typo, m.NAME_BANDS)).any())
    assert hit >= 270, "recall of the blocks against all pairs"


def test_side_blocks_find_misspelt_and_unknown_trade_words():
    """Names whose trade words differ in writing, with another symbol and no identifier."""
    rng = np.random.default_rng(2)
    letters, hit = list("abcdefghiklmnoprstuvw"), 0
    for i in range(200):
        w = "".join(rng.choice(letters, 9))
        j = int(rng.integers(1, 7))
        typo = w[:j] + w[j + 1] + w[j] + w[j + 2 :]
        a = m.parse(None, "AAA", "XNYS", f"{w} Quarries Inc", "CS", "1400", f"20{i % 20:02d}-03-1{i % 9}", "y")
        b = m.parse(None, "ZZZ", "NYSE", f"{typo} Qarriess Corp", None, "1400", f"20{i % 20:02d}-03-1{(i + 3) % 9}", None)
        ka, kb = m.keys(a), m.keys(b)
        assert not set(ka[0]) & set(kb[0]) or m.alike(a[5], b[5]) >= 0.8
        hit += bool(set(ka[1]) & set(kb[1]))
    assert hit >= 190


def test_words_with_one_letter_wrong_are_read_right():
    assert [m.spelled(w) for w in ("enregy", "enerrgy", "enxrgy", "energy", "enrgy", "fods")] == ["energy"] * 4 + ["enrgy", "fods"]
    assert m.parse(None, None, None, "Lum Utilitise Inc", None, None, None, None)[6] == "utilities"


def test_identifier_odds_are_calibrated():
    """Pairs with known truth: the sum of evidence and fitted log-odds gives probabilities that come true."""
    rng = np.random.default_rng(3)
    z = rng.normal(-1, 3, 40_000)
    truth = rng.random(len(z)) < 1 / (1 + np.exp(-z))
    shares = {True: (0.80, 0.05, 0.15), False: (0.03, 0.001, 0.969)}
    d = np.where(truth, rng.choice(3, len(z), p=shares[True]), rng.choice(3, len(z), p=shares[False]))
    odds = np.array(m.identifier_odds(1 / (1 + np.exp(-z)), d))
    assert np.abs(odds - np.log(np.array(shares[True]) / np.array(shares[False]))).max() < 0.6
    p = 1 / (1 + np.exp(-(z + odds[d])))
    for lo in np.arange(0, 1, 0.1):
        at = (p >= lo) & (p < lo + 0.1)
        assert abs(p[at].mean() - truth[at].mean()) < 0.05
    few = m.identifier_odds(np.array([0.5]), np.array([0]))
    assert np.abs(np.array(few) - np.array(m.Model(()).identifier)).max() < 0.1, "few labels keep the expectation"


@pytest.fixture(scope="module")
def pair(spark):
    a = [
        one(1, "Galumdrell Resources Inc.", "GRL"), one(1001, "Galumdrell Resources Inc.", "GRL"), one(2, "Toravvito Foods LLC Class A", "TVF.A"), one(3, "Toravvito Foods LLC Class B", "TVF.B"),
        one(4, "Skaerplent Motors", "SPM", day="1990-01-01"), one(5, "Melerrmmero Core Bond ETF", "MCB", kind="ETF", sic="6726"), one(6, None, None, None, None), one(7, "Hovasbra Energy Corporation", "HSB", figi="ZZGABCDEFGHI"),
    ]
    b = [
        one(101, "GALUMDRELL RES INC", "GRL", "NYSE"), one(1101, "GALUMDRELL RES INC", "GRL", "NYSE"), one(102, "TORAVVITO FOODS LLC (A SHARES)", "TVFA", "NYSE", kind="Domestic Common Stock Primary Class"),
        one(104, "Urilstia Software Inc", "SPM", "NASDAQ", day="2015-05-05"), one(105, "MELERMRMERO CORE BOND ETF", None, "NYSE", kind="ETF", sic="6726"), one(106, "MELERRMMERO EM ETF", "MEM", "NYSE", kind="ETF", sic="6726", day="2011-01-01"), one(108, "", "", "", None),
        one(107, "Wholly Other Name Ltd", "XYZ", figi="zzgabcdefgih", day="2001-02-04"),
    ]
    return m.match_records(recs(spark, a), recs(spark, b))


def test_matches_and_traps(pair):
    got = {(r["rec_a"], r["rec_b"]) for r in pair.collect()}
    assert {(1, 101), (1, 1101), (1001, 101), (1001, 1101), (2, 102), (5, 105)} <= got
    assert not {(3, 102), (4, 104), (5, 106), (6, 108)} & got


def test_confidence(pair):
    assert all(0.5 <= r["confidence"] <= 1 for r in pair.collect())


def test_empty_and_null_ids(spark):
    assert m.match_records(recs(spark, []), recs(spark, [one(1, "A Foods")])).count() == 0
    assert recs(spark, [(None,) * 10]).count() == 0


def test_rows_are_the_same_at_every_block_size(spark):
    """Sixty by sixty records share one symbol; the pairs that agree further are all found."""
    brand = lambda i: "".join(chr(97 + (i * k) % 26) for k in (3, 5, 7, 11, 17, 19, 23, 1, 9))
    a = [one(i, f"{brand(i)} Foods Inc", "HOT", day=f"20{i % 20:02d}-0{1 + i % 9}-11") for i in range(60)]
    b = [one(1000 + i, f"{brand(i)} FOODS INC.", "HOT", day=f"20{i % 20:02d}-0{1 + i % 9}-12") for i in range(60)]
    pa, pb = recs(spark, a), recs(spark, b)
    whole = {tuple(r) for r in m.match_records(pa, pb, block_pairs=10**9, shared=10**9).select("rec_a", "rec_b").collect()}
    for most in (1, 50, 10**4):
        assert {tuple(r) for r in m.match_records(pa, pb, block_pairs=most, shared=10**9).select("rec_a", "rec_b").collect()} == whole
    assert {(i, 1000 + i) for i in range(60)} <= whole


def test_large_block_keeps_pairs_that_agree_in_no_second_key(spark):
    """Shortened, misspelt brands under one symbol, months apart and without a code on one side."""
    rng = np.random.default_rng(3)
    a, b = [], []
    while len(a) < 30:
        w = "".join(rng.choice(list("abcdefghiklmnoprstuvw"), 9))
        typo = w[0] + w[2] + w[1] + w[3:6] + w[7] + w[6] + w[8]
        if m.alike(w, typo) >= 0.8 and not (m.bands(w, m.NAME_BANDS) == m.bands(typo, m.NAME_BANDS)).any():
            i = len(a)
            a.append(one(i, f"{w} Foods Inc", "HOT", day=f"20{i % 20:02d}-01-11"))
            b.append(one(1000 + i, f"{typo} Foods Inc", "HOT", day=f"20{i % 20:02d}-06-11", sic=None))
    pa, pb = recs(spark, a), recs(spark, b)
    got = {tuple(r) for r in m.match_records(pa, pb, shared=10**9).select("rec_a", "rec_b").collect()}
    assert {(i, 1000 + i) for i in range(30)} <= got, "recall against all pairs, the block has 900"


def test_placeholders_are_no_evidence(spark):
    """An identifier that every record carries neither matches records nor spoils the fit."""
    rng = np.random.default_rng(5)
    brands = ["".join(rng.choice(list("abcdefghiklmnoprstuvw"), 9)) for _ in range(60)]
    a = [one(i, f"{x} Foods Inc", x[:4].upper(), day=f"20{i % 20:02d}-0{1 + i % 9}-11", figi="ZZG000000000") for i, x in enumerate(brands)]
    b = [one(1000 + i, f"{x.upper()} FOODS INC.", x[:4].upper(), day=f"20{i % 20:02d}-0{1 + i % 9}-12", figi="ZZG000000000") for i, x in enumerate(brands)]
    assert {tuple(r) for r in m.match_records(recs(spark, a), recs(spark, b)).select("rec_a", "rec_b").collect()} == {(i, 1000 + i) for i in range(60)}


def test_often_repeated_security_keeps_identifier_and_symbol(spark):
    """Over fifty spellings of one security on each side: its rows without a name are found by identifier and symbol."""
    rng = np.random.default_rng(9)
    letters = list("abcdefghiklmnoprstuvw")
    brands = ["".join(rng.choice(letters, 9)) for _ in range(200)]

    def side(first, exchange):
        rows = [one(first + i, f"{x} Foods Inc", x[:4].upper(), exchange, day=f"20{i % 20:02d}-0{1 + i % 9}-11") for i, x in enumerate(brands)]
        for i in range(60):
            w = list("galumdrellov")
            w[1 + i % 10], w[2 + i % 9] = letters[i % 21], letters[i * 7 % 21]
            rows.append(one(first + 500 + i, f"{''.join(w)} Resources Inc", "GALU", exchange, figi="ZZGABCDEFGHI"))
        return [*rows, one(first + 900, None, "GALU", exchange, figi="ZZGABCDEFGHI"), one(first + 901, "Other Name Foods Inc", None, exchange, figi="ZZGABCDEFGHI")]

    got = {tuple(r) for r in m.match_records(recs(spark, side(0, "XNYS")), recs(spark, side(1000, "NYSE"))).select("rec_a", "rec_b").collect()}
    assert {(900, 1500 + i) for i in range(60)} | {(500 + i, 1900) for i in range(60)} <= got
    assert {(i, 1000 + i) for i in range(200)} <= got


def test_fit_is_noise_aware_and_starts_from_the_prior():
    prior = m.fit(np.zeros((0, len(m.NAMES))), np.zeros(0), np.zeros(0))
    assert prior.weights[1] == m.PRIOR["name_same"]
    rng = np.random.default_rng(1)
    x = np.zeros((2000, len(m.NAMES)))
    good = rng.random(2000) < 0.5
    x[good, m.NAMES.index("symbol_same")] = 1
    x[~good, m.NAMES.index("day_far")] = 1
    label = np.where(rng.random(2000) < 0.05, ~good, good)
    fitted = m.fit(x, np.where(label, 0, 2), np.arange(2000), noise=0.05)
    p = fitted.probability(x, np.full(2000, -1))
    assert (p[good] > 0.9).all() and (p[~good] < 0.1).all()
    masks = np.array([m.packed(list(r)) for r in x[:50]])
    assert (m.unpacked(masks) == x[:50]).all()
