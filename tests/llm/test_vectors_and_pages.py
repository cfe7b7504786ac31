import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import components, near_vectors, topk


def test_components_of_any_shape(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(30)] + [(100, 103), (101, 103), (102, 103), (7, 7), (None, 3)] + [(200, 210 + k) for k in range(20)] + [(250, 251 + k) for k in range(20)] + [(229, 270)]
    for hot in (components.HOT, 3):  # all by joins, and hubs apart
        monkeypatch.setattr(components, "HOT", hot)
        found = {r["id"]: r["component_id"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert found == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 104)} | {i: 200 for i in (*range(200, 201), *range(210, 230), *range(250, 271))}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(300, 24))
    base[50:120] = base[0] + rnd.normal(size=(70, 24)) * 0.12
    base[120:130] = base[1]
    base[200:230] = base[2:32] * 3 + rnd.normal(size=(30, 24)) * 0.4
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(base)]
    rows += [(400, None, 0), (401, [0.0] * 24, 0), (402, [math.nan] + [1.0] * 23, 0), (403, [None] + [1.0] * 23, 0), (404, [math.inf] * 24, 0), (405, [1.0], 0), (5, rows[5][1], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, copies int")


def test_near_vectors(spark, vectors, monkeypatch):
    rows, df = vectors
    fine = {i: np.array(v + [0.0] * (24 - len(v)), np.float32).astype(float) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(fine)
    unit = np.array([fine[i] / np.linalg.norm(fine[i]) for i in ids])
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    reach = np.linalg.matrix_power((linked | np.eye(len(ids), dtype=bool)).astype(float), 40) > 0
    for cell in (near_vectors.CELL_ROWS, 16):  # whole buckets, and pairs of blocks
        monkeypatch.setattr(near_vectors, "CELL_ROWS", cell)
        got = {r["vec_id"]: r for r in near_vectors.near_vectors(df).collect()}
        assert len(got) == 306
        for k, i in enumerate(ids):
            assert got[i]["n_links"] == linked[k].sum()
            assert got[i]["component_id"] == ids[int(np.argmax(reach[k]))] and got[i]["kept"] == (got[i]["component_id"] == i)
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (400, 401, 402, 403, 404))
    assert near_vectors.near_vectors(df.limit(0)).count() == 0
    nameless = near_vectors.near_vectors(df.limit(60).withColumn("vec_id", F.expr("nullif(vec_id, 0)"))).where("vec_id is null").collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in nameless] == [(0, None, None)]


@pytest.mark.parametrize("rows", [10**4, 10**7])
def test_pairs_at_the_least_cosine_share_a_direction(rows):
    rnd = np.random.default_rng(rows)
    x, y = rnd.normal(size=(2, 2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    code = near_vectors.ProductCodes(64, rows)
    mine, theirs = code.decode(x), code.decode(y)
    assert np.mean([bool(np.intersect1d(a, b).size) for a, b in zip(mine, theirs)]) >= 0.995
    # all that exceed the threshold, and no fewer than the floor
    scores = np.concatenate([((x @ t)[:, : code.cut] @ f.T)[:, :, None] + ((x @ t)[:, code.cut :] @ b.T)[:, None, :] for t, (f, b) in zip(code.turns, code.codes)], 1).reshape(len(x), -1)
    assert [len(m) for m in mine] == np.maximum((scores >= code.threshold).sum(1), near_vectors.FLOOR).tolist()
    assert 20 < np.mean([len(m) for m in mine]) < 30


def test_topk(spark, vectors, monkeypatch):
    rows, df = vectors
    fine = {i: [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)] for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    expected = set()
    for q in (i for i in fine if i % 50 == 0):
        best = sorted(((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q))[:5]
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    for shard, seed, block in ((topk.SHARD_ROWS, topk.SEED_ROWS, topk.QUERY_ROWS), (40, 7, 2)):
        monkeypatch.setattr(topk, "SHARD_ROWS", shard)
        monkeypatch.setattr(topk, "SEED_ROWS", seed)
        monkeypatch.setattr(topk, "QUERY_ROWS", block)
        got = topk.search(df, df.where("vec_id % 50 = 0"), 5).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == expected
    assert topk.search(df.where("vec_id < 3"), df.where("vec_id = 0"), 5).count() == 2
    assert topk.search(df.limit(0), df.limit(0), 5).count() == 0
    # copies of a row count once, wherever they are, and rows of one id by the best of them
    more = df.union(df).union(df.where("vec_id = 7").withColumn("embedding", F.transform("embedding", lambda x: x * 5)))
    for part in (more.repartition(1), more.repartition(9)):
        got = topk.search(part, df.where("vec_id % 50 = 0"), 5).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got if 7 not in {x["vec_id"] for x in got if x["query_id"] == r["query_id"]}} <= expected
        assert all(len({r["vec_id"] for r in got if r["query_id"] == q}) == 5 for q in {r["query_id"] for r in got})
