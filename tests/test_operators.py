import datetime
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import acquire, dedup, order, rate, report
from sluice.operators.dedup import band_masks, hamming_pairs, near_dup_greedy, numbered_firsts, ordered_union_distinct
from sluice.operators.quality import Thresholds, compose, heuristics, large_enough, normalized_size, sharp, similarity, similarity_logits, similarity_of_many
from sluice.operators.scenes import frame_names, scene_keyframes


def sequential_greedy(rows, t):
    kept, out = [], {}
    for i, h in sorted(rows):
        if h is None:
            out[i] = "null_hash"
        elif any(bin((h ^ k) & (1 << 64) - 1).count("1") <= t for k in kept):
            out[i] = "duplicate"
        else:
            kept.append(h)
            out[i] = "kept"
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 1000))
def test_greedy_matches_the_sequential_loop(spark, seed):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(4)]
    rows = []
    for i in range(40):
        h = rnd.choice(base)
        for _ in range(rnd.randint(0, 7)):
            h ^= 1 << rnd.randrange(64)
        rows.append((i, None if rnd.random() < 0.05 else h - (1 << 64) if h >> 63 else h))
    found = near_dup_greedy(spark.createDataFrame(rows, "id long, h long"), 8)
    assert {r["id"]: r["fate"] for r in found.collect()} == sequential_greedy(rows, 8)


def test_greedy_is_not_components(spark):
    rows = [(1, 0), (2, 0xFF), (3, 0xFFFF), (4, 0)]
    found = near_dup_greedy(spark.createDataFrame(rows, "id long, h long"), 0)  # 0 means 8
    assert {r["id"]: r["fate"] for r in found.collect()} == {1: "kept", 2: "duplicate", 3: "kept", 4: "duplicate"}
    pairs = hamming_pairs(spark.createDataFrame(rows[:3], "id long, h long"), 8).collect()
    assert {(r["a"], r["b"], r["distance"]) for r in pairs} == {(1, 2, 8), (2, 3, 8)}


def test_ordered_union_distinct(spark):
    a = spark.createDataFrame([("u", 2), ("v", 1)], "url string, pos int")
    b = spark.createDataFrame([("u", 0), ("w", 5)], "url string, pos int")
    assert {tuple(r) for r in ordered_union_distinct([a, b], "url").collect()} == {("u", 2), ("v", 1), ("w", 5)}


def test_bounds_of_filters(spark):
    rows = spark.createDataFrame([(480, 360, 100.0), (479, 360, 99.9), (480, 359, None), (1921, 1080, 100.0), (None, 1, None)], "width int, height int, lap_var double")
    found = rows.select(large_enough().alias("large"), sharp(threshold=0).alias("sharp"), normalized_size().alias("n")).collect()
    assert [(r["large"], r["sharp"]) for r in found] == [(True, True), (False, False), (False, False), (True, True), (False, False)]
    assert tuple(found[3]["n"]) == (1920, 1080) and tuple(found[0]["n"]) == (480, 360)


def test_cascade_records_what_was_reached(spark):
    rows = [(800, 200, 0.05, 0.01), (801, 200, 0.5, 0.5), (300, 300, 0.96, 0.5), (300, 300, 0.95, 0.009), (None, None, None, None), (199, 300, 0.5, 0.5)]
    found = heuristics(spark.createDataFrame(rows, "width int, height int, blue double, edges double"), Thresholds()).collect()
    assert [r["failed_check"] for r in found] == [None, "aspect", "blue", "edges", "readable", "size"]
    assert found[1]["aspect_ratio"] == pytest.approx(4.005) and found[1]["blue_ratio"] is None
    assert found[3]["edge_density"] == 0.009 and found[2]["edge_density"] is None


def test_similarity(spark):
    rows = spark.createDataFrame([([0.0, 0.0, 0.0, 0.0], 1), ([0.0] * 5, 1), (None, 1), ([1.0], 0)], "logits array<double>, n_keywords int")
    assert [r["similar"] for r in similarity(rows).collect()] == [True, False, False, True]


def test_compose_names_the_first_failure(spark):
    rows = spark.createDataFrame([(True, True), (True, None), (False, False)], "a boolean, b boolean")
    found = compose(rows, [("a", "a"), ("b", "b")]).collect()
    assert [(r["valid"], r["rejected_by"]) for r in found] == [(True, None), (False, "b"), (False, "a")]


def test_scenes(spark):
    frames = [("v", 0, [1.0, 0.0]), ("v", 1, [1.0, 0.0]), ("v", 2, [0.0, 1.0]), ("w", 0, [1.0, 1.0]), ("w", 1, [1.0, 0.0])]
    found = frame_names(scene_keyframes(spark.createDataFrame(frames, "video string, frame_idx int, hist array<double>")))
    rows = {(r["video"], r["frame_idx"]): r for r in found.collect()}
    assert [rows[k]["is_key"] for k in sorted(rows)] == [True, False, True, True, False]
    assert rows["v", 2]["diff"] == 200 and rows["v", 2]["name"] == "v_frame_00001.jpg"


def test_quotas_and_the_running_cap(spark):
    sources = acquire.enabled_sources(acquire.source_registry(spark).withColumn("has_key", F.lit(True)))
    assert {r["name"]: r["quota"] for r in acquire.quotas(sources, 100).collect()} == {"unsplash": 34, "pexels": 22, "nasa": 20, "wikimedia": 20, "flickr": 20}
    hits = spark.createDataFrame([("k", s[0], i, f"{s[0]}{i}") for s in acquire.SOURCES for i in range(50)], "keyword string, source string, pos int, url string")
    taken = acquire.allocate(hits, sources, 100)
    assert {r["source"]: r["count"] for r in taken.groupBy("source").count().collect()} == {"unsplash": 34, "pexels": 22, "nasa": 20, "wikimedia": 20, "flickr": 4}
    keyless = acquire.enabled_sources(acquire.source_registry(spark))
    assert [(r["name"], r["quota"]) for r in acquire.quotas(keyless, 100).orderBy("priority").collect()] == [("nasa", 55), ("wikimedia", 50)]


def test_pages_resume_and_backoff(spark):
    totals = spark.createDataFrame([("a", 95), ("b", 0), ("c", 10)], "keyword string, total int")
    pages = acquire.page_plan(totals, 30, 100).groupBy("keyword").count().collect()
    assert {r["keyword"]: r["count"] for r in pages} == {"a": 4, "b": 4, "c": 1}
    items = spark.createDataFrame([("x",), ("y",), (None,)], "item_id string")
    assert {r["item_id"] for r in acquire.resume(items, spark.createDataFrame([("x",)], "item_id string")).collect()} == {"y", None}
    assert [r["wait"] for r in acquire.backoff(spark, 3, 1.0).collect()] == [1.0, 2.0, 0.0]


def test_proxies_start_over_when_all_failed(spark):
    proxies = spark.createDataFrame([("a",), ("b",)], "proxy string")
    assert {r["proxy"] for r in acquire.available_proxies(proxies, proxies.limit(1)).collect()} == {"b"}
    assert acquire.available_proxies(proxies, proxies).count() == 2


def test_rate_window_is_half_open(spark):
    start = datetime.datetime(2024, 1, 1)
    ages = [0, 3600, 3599.999999, 3600.000001]
    rows = [("s", i, start + datetime.timedelta(seconds=a)) for i, a in enumerate(ages)]
    events = spark.createDataFrame(rows, "source string, event_id int, ts timestamp_ntz")
    assert [r["in_window"] for r in rate.window_counts(events).orderBy("ts").collect()] == [1, 2, 2, 3]
    limits = spark.createDataFrame([("s", 5), ("t", 2), ("u", 0)], "source string, limit int")
    now = start + datetime.timedelta(seconds=3600)
    left = {r["source"]: r["remaining"] for r in rate.remaining(events.where("event_id < 3"), limits, now).collect()}
    assert left == {"s": 3, "t": 2, "u": None}


@pytest.mark.parametrize("part", [order.RANKED_ROWS, 7])
def test_admission_matches_a_loop(spark, part, monkeypatch):
    monkeypatch.setattr(order, "RANKED_ROWS", part)  # one task, and a key over many
    rnd = random.Random(3)
    rows = [(s, i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=rnd.randrange(20000))) for s in "ab" for i in range(40)]
    events = spark.createDataFrame(rows, "source string, event_id int, ts timestamp_ntz")
    for limit in (1, 3):
        found = rate.admissions(events, limit).collect()
        for s in "ab":
            mine = sorted((r["arrived_us"], r["event_id"], r["admitted_us"]) for r in found if r["source"] == s)
            out = []
            for us, _, _ in mine:
                out.append(us if len(out) < limit else max(us, out[-limit] + 3_600_000_000))
            assert [a for _, _, a in mine] == out
    assert rate.admissions(events, 0).where("waited_us <> 0").count() == 0


def test_window_counts_match_a_loop(spark):
    rnd = random.Random(5)
    start = datetime.datetime(1969, 12, 31, 20)
    rows = [(rnd.choice("ab"), i, start + datetime.timedelta(seconds=rnd.randrange(30000), microseconds=rnd.randrange(3))) for i in range(200)] + [("a", 900, None), ("a", 901, None)]
    found = rate.window_counts(spark.createDataFrame(rows, "source string, event_id int, ts timestamp_ntz")).collect()
    assert len(found) == 202 and found[0].asDict().keys() == {"source", "event_id", "ts", "in_window"}
    for r in found:
        same = [t for s, _, t in rows if s == r["source"] and t is not None]
        near = [t for t in same if r["ts"] is not None and datetime.timedelta(0) <= r["ts"] - t < datetime.timedelta(hours=1)]
        assert r["in_window"] == (len(near) if r["ts"] is not None else 2)


@pytest.mark.parametrize("part", [order.RANKED_ROWS, 11])
def test_numbers_within_a_key(spark, part, monkeypatch):
    monkeypatch.setattr(order, "RANKED_ROWS", part)
    rnd = random.Random(6)
    rows = [(rnd.choice(["x", "x", "x", "y", None]), k) for k in rnd.sample(range(1000), 120)]
    found = numbered_firsts(spark.createDataFrame(rows, "key string, at int"), "key", "at").collect()
    assert {(r["key"], r["at"]): r["occurrence"] for r in found} == {(k, a): sum(1 for j, b in rows if j == k and b <= a) for k, a in rows}


@pytest.mark.parametrize("rows, threshold, bits", [(10, 8, 60), (10**4, 8, 60), (10**9, 8, 60), (10**5, 3, 64), (500, 18, 64)])
def test_bands_meet_for_every_near_pair(rows, threshold, bits):
    masks = band_masks(rows, threshold, bits)
    rnd = random.Random(rows)
    for _ in range(300):
        wrong = sum(1 << k for k in rnd.sample(range(bits), threshold))
        assert any(not wrong & m for m in masks)


def test_hamming_pairs_match_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, (h := rnd.getrandbits(64) & rnd.choice([(1 << 64) - 1, 0xFF00FF])) - (1 << 64 if h >> 63 else 0)) for i in range(150)]
    expected = {(a, b, d) for a, x in rows for b, y in rows if a < b and (d := bin((x ^ y) & (1 << 64) - 1).count("1")) <= 6}
    df = spark.createDataFrame(rows, "id long, h long")
    assert {tuple(r) for r in hamming_pairs(df, 6).collect()} == expected
    monkeypatch.setattr(dedup, "band_masks", lambda *a: band_masks(10**7, *a[1:]))
    assert {tuple(r) for r in hamming_pairs(df, 6).collect()} == expected


def test_reports(spark):
    assets = spark.createDataFrame([(f,) for f in (*report.FATES, "kept")], "fate string")
    funnel = report.image_funnel(assets)
    assert funnel.first().asDict() == {"total": 8, "processed": 6, "removed_low_res": 2, "removed_blur": 1, "removed_duplicates": 2, "removed_validation": 1, "final": 2}
    videos = report.video_counts(spark.range(2), spark.range(5))
    assert tuple(report.combined_totals(funnel, videos).first()) == (10, 7, 5)
    empty = report.image_funnel(assets.limit(0)).first()
    assert empty["total"] == 0 and empty["final"] == 0
    assert report.progress(spark.createDataFrame([], "status string"), 0).first()["progress_pct"] == 0
    assert report.pass_rate(spark.createDataFrame([(True,), (None,)], "valid boolean")).first()["shown"] == "50.0"


@pytest.mark.parametrize("bits, threshold, probe", [(24, 6, 1), (24, 6, 2), (24, 6, 3), (64, 7, 4), (64, 3, 7), (16, 0, 1), (20, 9, 2)])
def test_probing_finds_all_pairs(spark, bits, threshold, probe):
    rnd = np.random.default_rng(bits + threshold)
    values = rnd.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2) >> np.uint64(64 - bits)
    flipped = [int(v) ^ sum(1 << int(k) for k in set(rnd.integers(0, bits, rnd.integers(0, threshold + 2)))) for v in values]
    hashes = [h - (1 << 64) if h >> 63 else h for h in dict.fromkeys([*map(int, values), *flipped])]
    found = hamming_pairs(spark.createDataFrame([*enumerate(hashes), (999, None)], "id int, h long"), threshold, bits=bits, probe=probe)
    apart = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    expected = {(a, b, apart(x, y)) for a, x in enumerate(hashes) for b, y in enumerate(hashes) if a < b and apart(x, y) <= threshold}
    assert {tuple(r) for r in found.collect()} == expected


def test_the_cheaper_way_to_pairs():
    # at 18 of 64 bits 3 in 10,000 random keys are pairs; in probes 13 in 100 meet, by choices of bands every pair does, more than once
    cost, plan = dedup.best_probing(10**6, 18, 64)
    assert plan.radii == (4, 4, 4, 3) and plan.flips < dedup.MAX_FLIPS and plan.meetings < 0.13
    assert 7 * cost < dedup._best_masks(10**6, 18, 64, 4)[0] and dedup.best_probing(10**5, 18, 64)[1].meetings < 0.25
    # narrow ones stay with choices of bands
    assert dedup._best_masks(10**6, 3, 64, 4)[0] < dedup.best_probing(10**6, 3, 64)[0]


def test_scenes_of_a_long_video_in_parts(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    rows = [(v, 3 * i, None if rnd.random() < 0.05 else rnd.random(3).tolist()) for v, n in (("v", 500), ("w", 3), (None, 60)) for i in range(n)]
    frames = spark.createDataFrame([rows[k] for k in rnd.permutation(len(rows))], "video string, frame_idx int, hist array<double>")
    said = lambda: sorted(map(str, scene_keyframes(frames, 60.0).collect()))
    whole = said()
    for size in (40, 7):
        monkeypatch.setattr(order, "RANKED_ROWS", size)
        assert said() == whole


def test_similarity_with_any_number_of_prompts(spark):
    rnd = np.random.default_rng(8)
    n, dim, keywords = 25_000, 4, 24_996
    prompts, vectors = rnd.normal(size=(n, dim)), rnd.normal(size=(6, dim))
    assets = spark.createDataFrame([(i, v.tolist(), keywords, 1.0) for i, v in enumerate(vectors)] + [(6, None, keywords, 1.0), (7, vectors[0].tolist(), 0, 1.0)], "id int, embedding array<double>, n_keywords int, best double")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(prompts)], "prompt_pos int, vector array<double>")
    found = {r["id"]: r for r in similarity_of_many(assets, asked, scale=3.0, threshold=0.02, block=4_000).collect()}
    for i, v in enumerate(vectors):
        logits = 3.0 * prompts @ v
        shares = np.exp(logits - logits.max())
        shares = shares[:keywords] / shares.sum()
        assert found[i]["max_prob"] == pytest.approx(shares.max()) and found[i]["avg_prob"] == pytest.approx(shares.mean()) and found[i]["similar"] == (shares.max() >= 0.02)
    assert found[6]["similar"] is False and found[6]["max_prob"] is None and found[7]["similar"] is True and found[7]["max_prob"] is None
    few = asked.where("prompt_pos < 9")
    one = similarity(similarity_logits(assets.where("id < 6").withColumn("n_keywords", F.lit(5)), few), threshold=0.02)
    many = similarity_of_many(assets.where("id < 6").withColumn("n_keywords", F.lit(5)), few, threshold=0.02, block=2)
    assert [r["max_prob"] for r in many.orderBy("id").collect()] == pytest.approx([r["max_prob"] for r in one.orderBy("id").collect()])
    assert [r["similar"] for r in similarity_of_many(assets, few.limit(0)).orderBy("id").collect()] == [False] * 7 + [True]


@pytest.mark.parametrize("bits, threshold, block", [(64, 18, 16), (64, 8, 10**6), (60, 8, 5), (20, 3, 7)])
def test_pairs_by_cells_and_blocks(spark, monkeypatch, bits, threshold, block):
    rnd = np.random.default_rng(block)
    values = [int(v) >> 64 - bits for v in rnd.integers(0, 1 << 64, 40, dtype=np.uint64)]
    flipped = [v ^ sum(1 << int(k) for k in set(rnd.integers(0, bits, rnd.integers(0, threshold + 3)))) for v in values for _ in range(3)]
    hashes = [h - (1 << 64) if h >> 63 else h for h in [*values, *flipped, *values[:9], *[values[0]] * 20]]
    rows = [(f"{i:03}", h) for i, h in enumerate(hashes)]
    monkeypatch.setattr(dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(dedup, "COMPARED_AT_ONCE", 50)
    monkeypatch.setattr(dedup, "HELD_PAIRS", 10)
    monkeypatch.setattr(dedup, "CROWD", 3)
    apart = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    expected = sorted((a, b, apart(x, y)) for a, x in rows for b, y in rows if a < b and apart(x, y) <= threshold)
    for most in (0, 2):
        monkeypatch.setattr(dedup, "compared_masks", lambda n, t, b, most=most: (1e9, [0] if not most else band_masks(10**4, t, b, most)))
        df = spark.createDataFrame([*rows, ("x", None), rows[0]], "id string, h long")
        assert sorted(tuple(r) for r in hamming_pairs(df, threshold, bits=bits).collect()) == expected
        found = near_dup_greedy(spark.createDataFrame(rows, "id string, h long"), threshold, bits=bits)
        assert {r["id"]: r["fate"] for r in found.collect()} == sequential_greedy(rows, threshold)


def test_equal_hashes_meet_once():
    # 6 GB of documents hold about 2.8 million hashes: cells instead of all bands of every pair
    cost, masks = dedup.compared_masks(2_800_000, 8, 60)
    assert len(masks) == 45 and cost < 3e11
    # at wide radii each pair is compared once
    assert dedup.compared_masks(600_000, 18, 64)[1] == [0]
