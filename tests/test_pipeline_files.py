import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators.surfaces import ExpressionValidator, SourceRegistry, embed, generate, validate
from sluice.plans import pipeline
from tests.test_sources import png


def test_cleaning_a_folder(spark, tmp_path):
    rnd = np.random.default_rng(0)
    sharp = rnd.integers(0, 256, (360, 480, 3)).astype(np.uint8)
    near = sharp.copy()
    near[0, 0] = 0
    png(tmp_path / "a.png", sharp)
    png(tmp_path / "b.png", near)
    png(tmp_path / "flat.png", np.full((360, 480, 3), 9, np.uint8))
    png(tmp_path / "low.png", sharp[:359])
    (tmp_path / "bad.png").write_bytes(b"0123456789")
    frames = spark.createDataFrame([("v", 0, [1.0, 0.0], 500.0), ("v", 1, [0.0, 1.0], 1.0), ("v", 2, [1.0, 0.0], 500.0)], "video string, frame_idx int, hist array<double>, lap_var double")
    images, rows = pipeline.run(spark, str(tmp_path), frames)
    fates = {r["path"].rsplit("/", 1)[1]: r["fate"] for r in images.collect()}
    assert fates == {"a.png": "kept", "b.png": "duplicate", "flat.png": "blur", "low.png": "low_res", "bad.png": "unreadable"}
    found = {(r["section"], r["metric"]): r["value"] for r in rows.collect()}
    assert found["images", "removed_low_res"] == 2 and found["images", "final"] == 1 and found["videos", "total_frames_extracted"] == 2
    assert found["total", "total_input"] == 6 and found["total", "total_output"] == 3
    assert [r["name"] for r in pipeline.clean_videos(frames).orderBy("frame_idx").collect()] == ["v_frame_00000.jpg", "v_frame_00002.jpg"]


def test_validators_compose(spark):
    rows = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    checks = [ExpressionValidator("some", lambda: F.col("n") > 0), ExpressionValidator("few", lambda: F.col("n") < 3, lambda: {"n_twice": F.col("n") * 2})]
    assert [(r["failed_check"], r["valid"], r["n_twice"]) for r in validate(rows, checks).collect()] == [(None, True, 2), ("few", False, 10), ("some", False, None)]


def test_one_bad_row_fails_alone(spark):
    def load():
        return lambda values: [[1.0 / v] for v in values]

    found = embed(spark.createDataFrame([(1.0,), (0.0,), (2.0,)], "x double").coalesce(1), "x", load).collect()
    assert [r["embedding"] for r in found] == [[1.0], None, [0.5]]


def test_generator_and_registry(spark):
    def load():
        return lambda asked: (_ for _ in ()).throw(OSError) if asked.startswith("bad") else asked.encode()

    prompts = spark.createDataFrame([(0, "one"), (1, "bad"), (2, "two")], "idx int, prompt string")
    found = generate(prompts, load).orderBy("idx").collect()
    assert [r["name"] for r in found] == ["synthetic_00000.png", "synthetic_00001.png", "synthetic_00002.png"]
    assert found[1]["content"] is None and bytes(found[2]["content"]).startswith(b"two, photorealistic")
    registry = SourceRegistry()
    registry.register("a")(lambda limit: limit * 2)
    assert registry.make("a", limit=4) == 8
    with pytest.raises(ValueError):
        registry.register("a")(lambda: 0)
