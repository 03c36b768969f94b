import numpy as np
import pytest

pytest.importorskip("quillon.llm")
from quillon.llm import packing as p  # noqa: E402
from quillon.llm.tokens import count, encoder, TOKENIZER  # noqa: E402


def padding(h, bounds):
    return sum(h[n] * (bounds[np.searchsorted(bounds, n)] - n) for n in range(1, len(h)) if h[n])


def brute(h, k):
    lengths = [n for n in range(1, len(h)) if h[n]]
    n = len(lengths)
    cost = lambda i, j: sum(h[lengths[t]] * (lengths[j] - lengths[t]) for t in range(i, j + 1))
    best = [cost(0, j) for j in range(n)]
    for _ in range(k - 1):
        best = [min([best[j], *[best[i - 1] + cost(i, j) for i in range(1, j + 1)]]) for j in range(n)]
    return best[-1]


def test_buckets_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(30):
        h = np.zeros(40, np.int64)
        h[rng.choice(np.arange(1, 40), 16, replace=False)] = rng.integers(1, 30, 16)
        for k in (1, 2, 3, 6, 20):
            b = p.length_buckets(h, k)
            assert len(b) <= k and padding(h, b) == brute(h, k)


@pytest.mark.parametrize("mix", [True, False])
def test_plan_places_every_item_within_capacity(mix):
    rng = np.random.default_rng(1)
    for capacity in (16, 256):
        h = np.zeros(capacity + 1, np.int64)
        np.add.at(h, rng.integers(1, capacity + 1, 5000), 1)
        plan = p.plan(h, capacity, 12, mix)
        items = np.repeat(np.arange(capacity + 1), h)
        bucket = np.searchsorted(plan.bounds, items)
        rank = np.zeros(len(items), np.int64)
        for b in np.unique(bucket):
            rank[bucket == b] = np.arange((bucket == b).sum())
        c, pos = p.place(plan, bucket, rank)
        assert len(set(zip(c.tolist(), pos.tolist(), strict=True))) == len(items)
        assert np.bincount(c, items).max() <= capacity
        assert sorted(set(c.tolist())) == list(range(plan.containers))


def run(spark, docs, packs, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, position string, n_tokens int")
    k = spark.createDataFrame(packs, "name string, cap int")
    return p.pack(d, k, doc_id=d["doc_id"], text=d["text"], pack_name=k["name"], capacity=k["cap"], **kw).toPandas()


def test_documents(spark):
    words = "alpha beta gamma delta"
    docs = [(i, " ".join([words] * (i % 9)), "x", 0) for i in range(200)] + [(900, None, "x", 0), (901, "", "x", 0), (902, " ".join([words] * 200), "x", 0), (7, words, "x", 0)]
    got = run(spark, docs, [("s", 32), ("l", 128), (None, 5), ("zero", 0), ("s", 64)])
    assert set(got.pack_name) == {"s", "l"}
    for name, cap in (("s", 32), ("l", 128)):
        g = got[got.pack_name == name]
        per = g.groupby("container_id").agg(t=("n_tokens", "sum"), n=("position", "count"), u=("position", "nunique"), top=("position", "max"))
        assert per.t.max() <= cap and (per.n == per.u).all() and (per.top == per.n - 1).all()
        whole = {i: 0 for i, *_ in docs}
        for i, t, *_ in docs:
            whole[i] += count(t)
        assert g.groupby("doc_id").n_tokens.sum().to_dict() == whole, "nothing is lost or added"
        pieces = g.groupby("doc_id").piece.nunique()
        assert all(pieces[i] == max(1, -(-count(t) // cap)) for i, t, *_ in docs if i != 7)
        split = g[g.doc_id == 902].sort_values("piece")
        assert split.token_start.tolist() == [k * cap for k in range(len(split))]
    assert 1 - got[got.pack_name == "l"].n_tokens.sum() / ((got[got.pack_name == "l"].container_id.max() + 1) * 128) < 0.05


def test_repeated_rows_and_lengths_are_ranked_without_a_hot_group(spark, monkeypatch):
    docs = [(1, "word " * 6, "x", 0)] * 300 + [(i, "word " * (1 + i % 20), "x", 0) for i in range(100)] + [(5, "", "x", 0)] * 30
    for bound in (10**6, 0):  # offsets broadcast or joined by shuffle
        monkeypatch.setattr(p, "OFFSETS", bound)
        got = run(spark, docs, [("s", 32)])
        assert len(got) == 430 and got.n_tokens.sum() == sum(count(t) for _, t, *_ in docs)
        assert got.groupby("container_id").n_tokens.sum().max() <= 32
        assert not got.duplicated(["container_id", "position"]).any()


def test_bucket_bounds_of_a_dense_histogram_are_fast():
    import time

    h = np.random.default_rng(0).integers(1, 1000, 4097)
    h[0] = 0
    start = time.perf_counter()
    assert len(p.length_buckets(h, 256)) == 256
    assert time.perf_counter() - start < 2.0


def test_empty_inputs(spark):
    assert len(run(spark, [], [("s", 8)])) == 0
    assert len(run(spark, [(1, "a", "", 0)], [])) == 0
    only = run(spark, [(1, "", "", 0), (2, None, "", 0)], [("s", 8)])
    assert only.container_id.tolist() == [0, 0] and sorted(only.position) == [0, 1]


def test_long_text_in_parts_counts_the_same(monkeypatch):
    from quillon.llm import tokens

    text = "The grocery chain's tills, 12 of them, were busy. " * 300
    whole = len(encoder(TOKENIZER).encode_ordinary(text))
    monkeypatch.setattr(tokens, "PART", 1000)
    assert tokens.count(text) == whole
    assert tokens.count("x" * 5000) > 0
