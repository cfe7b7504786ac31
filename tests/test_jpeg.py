import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.functions.jpeg import LONGEST_CODE, code_lengths, complete_jpeg, jpeg
from sluice.sources import files, pictures


def scenes():
    rnd = np.random.default_rng(3)
    y, x = np.mgrid[:123, :201]
    smooth = np.stack([x, y, (x + y) // 2], -1).astype(np.uint8)
    edges = np.where(((x // 9 + y // 9) % 2)[..., None], [250, 20, 30], [10, 200, 90]).astype(np.uint8)
    coarse = rnd.integers(0, 256, (16, 26, 3)).repeat(8, 0).repeat(8, 1)[:123, :201].astype(np.uint8)
    flat = np.full((1, 1, 3), 77, np.uint8)
    return {"smooth": smooth, "edges": edges, "coarse": coarse, "flat": flat, "wide": smooth[:3], "high": smooth[:, :9], "many": np.tile(smooth, (3, 4, 1))}


def test_another_decoder_reads_what_was_written(spark, tmp_path):
    for name, shown in scenes().items():
        (tmp_path / f"{name}.jpg").write_bytes(jpeg(shown))
    read = {r["path"].rsplit("/", 1)[1][:-4]: r for r in files.read_images(spark, str(tmp_path)).collect()}
    for name, shown in scenes().items():
        r = read[name]
        assert (r["height"], r["width"]) == shown.shape[:2]
        found = files.picture(r["data"], r["width"], r["height"], r["channels"])
        assert np.abs(found.astype(int) - shown).mean() < 3, name


def test_noise_survives_at_the_highest_quality_and_shrinks_at_a_low_one(spark, tmp_path):
    noise = np.random.default_rng(0).integers(0, 256, (80, 72, 3)).astype(np.uint8)
    (tmp_path / "n.jpg").write_bytes(jpeg(noise, 100))
    r = files.read_images(spark, str(tmp_path)).first()
    assert np.abs(files.picture(r["data"], 72, 80, r["channels"]).astype(int) - noise).mean() < 1.5
    assert len(jpeg(noise, 20)) < len(jpeg(noise, 95)) < len(jpeg(noise, 100))


def test_whole_files():
    whole = jpeg(scenes()["coarse"])
    assert complete_jpeg(whole) and complete_jpeg(whole + b"behind")
    assert not any(complete_jpeg(whole[:n]) for n in range(0, len(whole), 97)) and not complete_jpeg(whole[:-2])
    assert not complete_jpeg(b"") and not complete_jpeg(b"\xff\xd8\xff\xd9") and not complete_jpeg(b"no picture")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 255), st.integers(1, 1 << 30), min_size=1, max_size=256))
def test_code_lengths_fit_and_fill(counts):
    lengths = code_lengths(counts)
    assert all(1 <= n <= LONGEST_CODE for n in lengths.values()) and lengths[-1] == max(lengths.values())
    assert sum(2.0**-n for n in lengths.values()) == 1


def test_code_lengths_where_the_plain_ones_are_too_long():
    counts = {k: 2**k for k in range(30)}
    assert max(code_lengths(counts).values()) == LONGEST_CODE


def test_jpeg_pictures_and_frames_are_written(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    shown = scenes()["smooth"]
    for name in ("own.JPG", "flat.jpeg"):
        (tmp_path / "in" / "a" / name).write_bytes(jpeg(shown))
    (tmp_path / "in" / "a" / "p.png").write_bytes(pictures.png(shown))
    images = files.read_images(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    assert pictures.write_files(pictures.encoded_images(images, kind="own"), out, verify="picture") == (3, 0)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a_flat.jpeg", "a_own.JPG", "a_p.png"]
    assert files.read_images(spark, out).where("height = 123 and width = 201").count() == 3
    assert [r["name"] for r in pictures.encoded_images(images, kind="jpeg").orderBy("name").collect()] == ["a_flat.jpg", "a_own.jpg", "a_p.jpg"]
    frame = pictures.encoded_frames(images.limit(1).selectExpr("'v_frame_00003.jpg' as name", "width", "height", "channels", "data"), kind="jpeg")
    assert pictures.write_files(frame, out, verify="jpeg") == (1, 0) and complete_jpeg((tmp_path / "out" / "v_frame_00003.jpg").read_bytes())
    assert pictures.write_files(frame.selectExpr("name", "unhex('ffd8') as content"), out, verify="jpeg") == (0, 1)
    with pytest.raises(ValueError):
        pictures.encoded_frames(images, kind="gif")
    with pytest.raises(ValueError):
        pictures.write_files(frame, out, verify="gif")
