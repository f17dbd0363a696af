import numpy as np
import pytest

from tidemark.llm import ann, exact_search, tiles

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def vectors(spark, n=900, size=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)).astype(np.float32)
    x[n // 3 : n // 3 + 40] = x[5] + rng.normal(size=(40, size)).astype(np.float32) * 0.02  # a dense corner
    x[10] = x[11] = x[300]  # ties
    rows = [(i, v.tolist(), 0, 0.0, 0) for i, v in enumerate(x)]
    odd = [
        (10_000, None), (10_100, [None] * size), (10_200, [float("nan")] * size), (10_300, [float("inf")] + [0.0] * (size - 1)),
        (10_400, [1.0] * (size - 1)), (10_500, []), (None, [1.0] * size),
    ]
    rows += [(i, v, 0, 0.0, 0) for i, v in odd]
    return spark.createDataFrame(rows, SCHEMA), x.astype(np.float64)


def test_products_against_brute_force(spark):
    table, x = vectors(spark)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in exact_search.top_products(table).collect()}
    whole = np.floor(1024 * x).astype(np.int64)
    want = {}
    for q in range(0, len(x), 100):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:10]
        want |= {(q, k + 1): (i, score[i]) for k, i in enumerate(order)}
    assert got == want


def test_bounds_never_cut_a_winner():
    rng = np.random.default_rng(3)
    q, x = np.floor(rng.normal(size=(30, 16)) * 500), np.floor(rng.normal(size=(400, 16)) * 500)
    x[:200] *= 0.1
    for levels in exact_search.LEVELS:
        bound = exact_search.statistics(q, levels) @ exact_search.statistics(x, levels).T
        assert (bound >= q @ x.T - 1e-3).all()


def test_bounds_spare_products_where_vectors_differ():
    """Smooth vectors: coarse means tell them apart, so few pairs need their exact product."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(6000, 4)), 16, axis=1) + rng.normal(size=(6000, 64)) * 0.01
    counted = {}
    ids = np.arange(len(x))
    at, who, score = exact_search.best_products(10, counted)(ids[:50], x[:50], ids, x)
    assert counted["exact"] < 0.8 * 50 * 6000
    whole = np.floor(1024 * x).astype(np.int64)
    for q in range(50):
        true = np.sort(np.delete(whole @ whole[q], q))[-10:]
        assert (np.sort(score[at == q])[-10:] == true).all()


def test_few_rows_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (100, [2.0, 0.0]), (100, [2.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in exact_search.top_products(table).orderBy("query_id", "rank").select("query_id", "rank", "vec_id", "score").collect()]
    assert got == [
        (0, 1, 100, 2048 * 1024), (0, 2, 100, 2048 * 1024), (0, 3, 1, 512 * 1024), (0, 4, 1, 512 * 1024), (0, 5, 2, -1024 * 1024),
        (100, 1, 0, 2048 * 1024), (100, 2, 1, 2048 * 512), (100, 3, 1, 2048 * 512), (100, 4, 2, -2048 * 1024),
    ]
    assert {r["vec_id"] for r in ann.nearest(table).where("query_id = 0").collect()} == {1, 2, 100}


@pytest.mark.parametrize("search", [exact_search.top_products, ann.nearest])
def test_nothing_to_search(spark, search):
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert search(spark.createDataFrame([(0, None), (50, [])], "vec_id long, embedding array<float>")).count() == 0
    assert search(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_neighbours_recall_and_scores(spark):
    table, x = vectors(spark, n=3000, size=32)
    zero = spark.createDataFrame([(50_000, [0.0] * 32, 0, 0.0, 0)], SCHEMA)
    rows = ann.nearest(table.union(zero)).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    asked = range(0, len(x), 50)
    for q in asked:
        like = unit @ unit[q]
        like[q] = -2
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - like[r["vec_id"]]) < 1e-12 for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        hit += len({r["vec_id"] for r in mine} & set(np.argsort(-like, kind="stable")[:5].tolist()))
    assert hit / (5 * len(asked)) >= 0.9
    assert not any(50_000 in (r["query_id"], r["vec_id"]) for r in rows)


def test_answers_do_not_depend_on_tiles(spark, monkeypatch):
    """One tile, many tiles, and a plain search of all codes; a small radius leaves many queries short."""
    table, x = vectors(spark, n=1200, size=16)
    got = []
    for lane in (65536, 1200, 90, 7):
        monkeypatch.setattr(tiles, "LANE", lane)
        got.append({(r["query_id"], r["rank"]): r["vec_id"] for r in ann.nearest(table, every=20, reach=0.5).collect()})
    unit = ann.normalized(x)
    with monkeypatch.context() as m:
        fitted = []
        m.setattr(ann, "search", lambda rows, every, k, kind, best, radius: fitted.append((best, radius)))
        ann.nearest(table, every=20, reach=0.5)
    best, radius = fitted[0]
    codes = next(c.cell_contents for c in best.__closure__ if isinstance(c.cell_contents, ann.Codes))
    code, want, short = codes.encode(unit), {}, 0
    for q in range(0, len(x), 20):
        far, like = ann.hamming(code[q][None, :], code), unit @ unit[q]
        others = [i for i in range(len(x)) if i != q]
        inside = [i for i in others if far[i] <= radius]
        short += len(inside) < 5
        if len(inside) < 5:
            inside = sorted(others, key=lambda i: (far[i], i))[:5]
        want |= {(q, n + 1): i for n, i in enumerate(sorted(inside, key=lambda i: (-round(float(like[i]), 12), i))[:5])}
    assert 0 < short < 60
    assert got == [want] * 4


@pytest.mark.parametrize("radius", [0, 1, 5, 9, 17, 40, 64])
def test_probing_finds_every_code_in_the_radius(radius):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (1500, 4)).astype(np.uint16)
    asked = codes[:40] ^ (1 << rng.integers(0, 16, (40, 4))).astype(np.uint16)
    q, x = ann.Index(codes).within(asked, radius)
    far = ann.hamming(asked[:, None, :], codes[None, :, :])
    assert set(zip(q.tolist(), x.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(far <= radius))))
