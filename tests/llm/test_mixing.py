import pytest

pytest.importorskip("quillon.llm")
from quillon.llm import mixing as mx  # noqa: E402
from quillon.llm.tokens import count  # noqa: E402


def frames(spark, docs, targets):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, tokens int, mix_name string")
    t = spark.createDataFrame(targets, "mix string, source string, share double, most int")
    return d, t


def run(spark, docs, targets, **kw):
    d, t = frames(spark, docs, targets)
    return mx.mixed(d, t, doc_id=d["doc_id"], text=d["text"], source=d["source"], mix_name=t["mix"], mix_source=t["source"], share=t["share"], max_repeat=t["most"], **kw), t


DOCS = [(i, "word " * (5 + i % 37), s, 0, "") for i, s in enumerate(["Big"] * 600 + [" big "] * 200 + ["small"] * 60 + ["other"] * 50 + [None] * 5)] + [(5000, None, "big", 0, ""), (5001, "", "small", 0, "")]


def test_shares_and_caps(spark):
    out, t = run(spark, DOCS, [("m", "big", 0.6, 1), ("m", "SMALL", 0.3, 3), ("m", "missing", 0.1, 2), ("half", "big", 0.5, 4), ("half", "other", 0.5, 4)])
    rows = out.collect()
    got = {(r["mix_name"], r["source"]): r for r in mx.shares(out, t, mix_name=t["mix"], mix_source=t["source"], share=t["share"]).collect()}
    total = sum(r["tokens"] for k, r in got.items() if k[0] == "m")
    assert abs(got["m", "big"]["tokens"] - total * 0.6 / 0.9) < 45 and got["m", "missing"]["tokens"] == 0
    assert got["m", "small"]["most_repeats"] == 3 and got["m", "big"]["most_repeats"] == 1
    assert abs(got["half", "big"]["actual_share"] - 0.5) < 0.01 and got["half", "other"]["most_repeats"] == 4
    assert len({(r["mix_name"], r["doc_id"]) for r in rows}) == len(rows)
    by_id = {i: t for i, t, *_ in DOCS}
    assert all(r["n_tokens"] == count(by_id[r["doc_id"]]) > 0 for r in rows)
    assert sorted(map(tuple, run(spark, DOCS, [("m", "big", 1.0, 1)])[0].collect())) == sorted(map(tuple, run(spark, DOCS, [("m", "big", 1.0, 1)])[0].collect())), "a run can be repeated"


def test_longer_texts_are_likelier(spark):
    docs = [(i, "word " * (10 if i % 2 else 40), "a", 0, "") for i in range(2000)] + [(9000 + i, "word " * 30, "b", 0, "") for i in range(200)]
    out, _ = run(spark, docs, [("m", "a", 0.5, 1), ("m", "b", 0.5, 1)])
    picked = [r["doc_id"] for r in out.where("source = 'a'").collect()]
    long = sum(i % 2 == 0 for i in picked)
    assert long > 1.5 * (len(picked) - long) > 0


def test_result_is_the_same_whatever_is_folded_or_sorted_at_once(spark):
    docs = [(i, "word " * (400 if i % 9 == 0 else 1 + i % 3), "a", 0, "") for i in range(1500)] + [(9000 + i, "word " * 50, "b", 0, "") for i in range(40)]
    targets = [("m", "a", 0.5, 1), ("m", "b", 0.5, 1), ("n", "a", 0.7, 1), ("n", "b", 0.3, 1)]
    whole = sorted(map(tuple, run(spark, docs, targets)[0].collect()))
    assert sorted(map(tuple, run(spark, docs, targets, folded_rows=4, sorted_rows=1)[0].collect())) == whole


@pytest.mark.parametrize("seed", [1, 2, 3, 7])
def test_repeated_ids_are_documents_of_their_own(spark, seed):
    """Every id twice with different texts, some rows three times over: the goal is missed by less than a document."""
    docs = [(i % 300, "word " * (3 + i * 7 % 60), "a", 0, "") for i in range(600)] + [(i, "same " * 20, "a", 0, "") for i in range(10)] * 3
    docs += [(9000, "word " * 100, "b", 0, "")] * 40
    out, t = run(spark, docs, [("m", "a", 0.7, 1), ("m", "b", 0.3, 1)], seed=seed)
    rows = out.collect()
    got = {s: sum(r["n_tokens"] * r["repeats"] for r in rows if r["source"] == s) for s in "ab"}
    supply = 40 * count("word " * 100)
    goal = supply * 0.7 / 0.3
    assert got["b"] == supply and goal - 3 < got["a"] <= goal, "the smallest texts have three tokens"
    assert all(r["repeats"] == 1 for r in rows) and sum(r["source"] == "b" for r in rows) == 40
    have = {}
    for i, x, *_ in docs:
        have[i, count(x)] = have.get((i, count(x)), 0) + 1
    for r in rows:
        have[r["doc_id"], r["n_tokens"]] -= 1
    assert min(have.values()) >= 0
    copies = [sum(r["doc_id"] == i and r["n_tokens"] == count("same " * 20) for r in rows) for i in range(10)]
    assert len(set(copies)) > 1, "copies are drawn independently"


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(mx, "LISTED", 7)
    docs = [(1, "word " * 10, "a", 0, "")] * 50 + [(2, "word " * 10, "b", 0, "")] * 15
    out, _ = run(spark, docs, [("m", "a", 0.5, 1), ("m", "b", 0.5, 1)])
    assert sorted((r["source"], r["repeats"]) for r in out.collect()) == [("a", 1)] * 15 + [("b", 1)] * 15


def test_nothing_to_mix(spark):
    assert run(spark, [], [("m", "a", 1.0, 1)])[0].count() == 0
    assert run(spark, DOCS, [("m", "missing", 1.0, 1), (None, "big", 1.0, 1), ("m", "big", None, 1), ("m", "big", 0.5, 0)])[0].count() == 0
    with pytest.raises(ValueError):
        run(spark, DOCS, [("m", "big", 1.0, 1), ("n", "big", 1.0, 1)], max_targets=1)


def test_expected_copies_reach_the_goal():
    tokens = {-2: 100.0, 0: 1000.0, 2: 400.0}
    e = mx.expected_copies(tokens, 900.0, 3)
    assert abs(sum(e[c] * t for c, t in tokens.items()) - 900) < 1e-6 and e[-2] < e[0] < e[2]
    assert set(mx.expected_copies(tokens, 1e9, 3).values()) == {3.0}
