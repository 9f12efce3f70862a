"""Vector searches against brute force: nearest neighbours by vantage-point trees, hard negatives by threshold joins."""

import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.llm import negatives, queries, vantage
from gleanery.llm.negatives import Lists, hard_negatives
from gleanery.llm.vantage import Asked, Search, Shards, Space, nearest

SCHEMA = "vec_id long, label int, embedding array<float>, row int, rank int, score double, block int, shard int"


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    found = [(i, int(i % 4), (centres[i % 6] + rng.normal(size=12) * 0.6).astype(np.float32).tolist()) for i in range(500)]
    common = np.float32([0.5] * 12).tolist()
    found += [(1000 + i, 1, common) for i in range(60)]  # ties
    found += [(700, 1, None), (701, 2, [0.0] * 12), (702, 2, [1.0, None]), (703, 3, [float("nan")] * 12), (704, 3, [float("inf")] + [0.0] * 11)]
    found += [(705, 1, [2.0, -1.0]), (706, None, found[3][2]), (None, 1, found[4][2]), (707, 2, []), (40, 0, found[40][2]), found[41], found[41]]
    return found


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, 0.5, 9, 9) for r in rows], SCHEMA).cache()


def brute_nearest(rows, asked, k):
    usable = [(i, v) for i, _, v in rows if i is not None and good(v) and any(v)]
    out = {}
    for q, v in sorted((i, v) for i, v in usable if asked(i)):
        if q not in out:
            scored = sorted((-math.fsum(x * y for x, y in zip(v, w)), i) for i, w in usable if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def by_query(found):
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


@pytest.mark.parametrize("limits", [{}, {"piece": 40, "leaf": 8}, {"piece": 7, "leaf": 2, "sample": 64}])
def test_factor_one_is_exact(table, rows, limits):
    found = by_query(nearest(table, table.where("vec_id % 20 = 0"), stretch=1.0, **limits).collect())
    wanted = brute_nearest(rows, lambda i: i % 20 == 0, vantage.K)
    assert found.keys() == wanted.keys()
    for q, best in wanted.items():
        assert np.allclose([s for _, s in found[q]], [s for _, s in best], rtol=1e-12, atol=1e-12)
        # The order among products that differ by rounding only is open; ids are those of equal products.
        assert [i for i, _ in found[q]] == [i for i, _ in best] or sorted(i for i, _ in found[q]) == sorted(i for i, _ in best)


def test_larger_factors_lose_little_and_rank_rightly(table, rows):
    wanted = brute_nearest(rows, lambda i: i % 20 == 0, vantage.K)
    found = by_query(nearest(table, table.where("vec_id % 20 = 0"), stretch=1.5, piece=40, leaf=8).collect())
    vectors = {i: v for i, _, v in rows if i is not None and good(v)}
    for q, best in found.items():
        assert len(best) == vantage.K
        assert [s for _, s in best] == sorted((s for _, s in best), reverse=True)
        assert np.allclose([s for _, s in best], [product(vectors[q], vectors[i]) for i, _ in best])
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in best}) for q, best in wanted.items())
    assert hits >= 0.9 * sum(map(len, wanted.values()))


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    vectors = {r.vec_id: np.float64(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()}
    ids = np.array(sorted(vectors))
    points = np.array([vectors[i] for i in ids])
    found = by_query(queries.op11_nearest_neighbours(spark, sf).collect())
    assert found.keys() == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, best in found.items():
        score = points @ vectors[q]
        score[ids == q] = -np.inf
        hits += len({int(ids[n]) for n in np.argsort(-score)[: vantage.K]} & {i for i, _ in best})
        assert np.allclose([s for _, s in best], [score[np.searchsorted(ids, i)] for i, _ in best], rtol=1e-13)
    assert hits >= 0.95 * len(found) * vantage.K


def test_recall_over_many_trees(spark):
    sf = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    asked = vectors.where("vec_id % 20 = 0")
    exact = {(r.query_id, r.vec_id) for r in nearest(vectors, asked, stretch=1.0).collect()}
    found = {(r.query_id, r.vec_id) for r in nearest(vectors, asked, piece=128, leaf=16).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_searches_of_odd_tables(spark, table, rows):
    empty = table.limit(0)
    assert nearest(empty, empty).count() == 0 and nearest(table, empty).count() == 0 and nearest(empty, table).count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0, 3.0]), (9, [0.0, 0.0, 1.0]), (9, [5.0])], "vec_id long, embedding array<double>")
    for piece in (1, 100):
        found = by_query(nearest(few, asked, piece=piece, leaf=1, sample=100).collect())
        assert found == {1: [(2, 0.5), (3, 0.5)], 9: [(1, 0.0), (2, 0.0), (3, 0.0)]}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 90), st.integers(1, 6), st.integers(1, 9))
def test_a_tree_finds_what_comparing_all_does(seed, n, k, leaf):
    rng = np.random.default_rng(seed)
    vectors, asked = (np.round(rng.normal(size=(m, 3)), 1) for m in (n, 7))
    asked[np.abs(asked).sum(1) == 0] = 1
    longest = float(np.sqrt((vectors**2).sum(1)).max()) or 1.0
    order, radius = vantage._tree(vectors, longest, leaf)
    bar = np.where(np.arange(7) % 2, -np.inf, np.sort(vectors @ asked.T, axis=0)[max(0, n - k - 1)])
    who, found, score = Search(order, vectors[order], radius, Asked(asked, longest), np.arange(7), bar, k, 1.0, leaf).run()
    for q in range(7):
        all_ = sorted((-float(np.einsum("j,j->", asked[q], v)), i) for i, v in enumerate(vectors) if i != q)[:k]
        got = sorted((-s, i) for s, i in zip(score[who == q], found[who == q]))
        assert np.allclose([s for s, _ in got], [s for s, _ in all_][: len(got)]) and len(got) == min(k, len(all_))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(20, 200), st.integers(1, 16))
def test_shards_within_a_distance_are_reached(seed, n, shards):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, 3))
    longest = float(np.sqrt((vectors**2).sum(1)).max())
    fitted = Shards(vectors[: n // 2], longest, 1 << int(math.log2(shards)))
    space, asked = Space(vectors, longest), Asked(rng.normal(size=(9, 3)), longest)
    home = fitted.home(vectors, space.last)
    bound = rng.uniform(0.1, 1.5, 9) * longest
    who, shard = fitted.reached(asked, bound)
    reached = set(zip(who.tolist(), shard.tolist()))
    points = asked.vectors * asked.scale[:, None]
    for q in range(9):
        near = np.sqrt(((vectors - points[q]) ** 2).sum(1) + space.last**2) <= bound[q]
        assert {(q, s) for s in home[near].tolist()} <= reached


def brute_negatives(rows, asked, k=5, least=80, most=100):
    usable = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if i is not None and label is not None and good(v)]
    out, seen = [], set()
    for a, label, v in sorted(r for r in usable if asked(r[0])):
        if a in seen:
            continue
        seen.add(a)
        scored = sorted((-product(v, w), i, other) for i, other, w in usable if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            inside = [s for s in scored if s[2] != label and least * -p <= 100 * -s[0] <= most * -p]
            out += [(a, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(inside[:k])]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def listed(found):
    return sorted(tuple(r[c] for c in COLUMNS) for r in found.collect())


@pytest.mark.parametrize("limits", [{}, {"block": 17}, {"block": 100, "falls": (0.01, 0.05, 1.0)}])
def test_negatives_equal_brute_force(table, rows, limits):
    assert listed(hard_negatives(table, table.where("vec_id % 10 = 0 or vec_id in (705, 41)"), **limits)) == brute_negatives(
        rows, lambda i: i % 10 == 0 or i in (705, 41)
    )


def test_negatives_of_odd_tables(spark, table):
    assert hard_negatives(table.limit(0), table).count() == 0 and hard_negatives(table, table.limit(0)).count() == 0
    few = [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.9]), (100, 3, [0.0]), (101, 3, [5.0]), (102, 4, [7.0]), (200, 5, [3e9]), (201, 5, [2e9]), (202, 6, [1.9e9])]
    frame = spark.createDataFrame(few, "vec_id long, label int, embedding array<double>")
    assert listed(hard_negatives(frame, frame.where("vec_id % 100 = 0"), scale=1)) == brute_negatives([(i, l, [x / 256 for x in v]) for i, l, v in few], lambda i: i % 100 == 0)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 30), st.integers(-200, 4000), st.booleans())
def test_lists_lose_no_product_above_the_threshold(seed, n, width, floor, real):
    rng = np.random.default_rng(seed)
    values, asked = (rng.integers(-30, 30, (m, width)) * (rng.random((m, width)) < 0.7) for m in (n, 5))
    if real:
        values, asked = values.astype(np.float64), asked.astype(np.float64)
    floors = floor + rng.integers(0, 500, 5).astype(np.float64)
    lists = Lists(values, floors.min(), float(np.sqrt((asked.astype(np.float64) ** 2).sum(1)).max()))
    found = sorted(zip(*(x.tolist() for x in lists.join(asked, floors))))
    assert found == sorted((q, r, int(values[r] @ asked[q])) for q in range(5) for r in range(n) if values[r] @ asked[q] >= floors[q])


def test_lists_leave_out_what_norms_cover():
    values = np.array([[100.0, 50.0, 1.0], [100.0, 2.0, 1.0], [3.0, 2.0, 1.0]])
    lists = Lists(values, 500.0, 10.0)
    assert lists.cut.tolist() == [2, 1, 0] and np.count_nonzero(lists.listed) == 3


def test_the_query_of_negatives(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert listed(queries.op13_hard_negatives(spark, sf)) == brute_negatives(rows, lambda i: i % 100 == 0)
