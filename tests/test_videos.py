import struct

import numpy as np

from sluice.plans.pipeline import clean_videos
from sluice.sources.files import frame_features, picture
from sluice.sources.videos import read_frames, video_index

RND = np.random.default_rng(2)
SHOWN = RND.integers(0, 256, (5, 6, 7, 3)).astype(np.uint8)


def chunk(kind, data):
    return kind + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)


def listed(kind, *parts):
    return chunk(b"LIST", kind + b"".join(parts))


def avi(frames, bits=24, packing=0, down=False, sound=False):
    height, width, _ = frames[0].shape

    def rows(f):
        f = np.dstack([f, np.zeros((height, width, 1), np.uint8)]) if bits == 32 else f
        raw = (f if down else f[::-1]).reshape(height, -1)
        return np.pad(raw, ((0, 0), (0, -raw.shape[1] % 4))).tobytes()

    head = struct.pack("<IiiHHIIiiII", 40, width, -height if down else height, 1, bits, packing, 0, 0, 0, 0, 0)
    video = listed(b"strl", chunk(b"strh", b"vids" + bytes(52)), chunk(b"strf", head))
    audio = listed(b"strl", chunk(b"strh", b"auds" + bytes(52)), chunk(b"strf", bytes(18)))
    number = b"01" if sound else b"00"
    shown = [chunk(number + b"db", b"" if f is None else rows(f)) for f in frames]
    held = [listed(b"rec ", chunk(b"00wb", b"abc"), s) if sound else s for s in shown]
    body = b"AVI " + listed(b"hdrl", chunk(b"avih", bytes(56)), *([audio] if sound else []), video) + chunk(b"JUNK", b"odd") + listed(b"movi", *held) + chunk(b"idx1", bytes(16))
    return chunk(b"RIFF", body)


def test_plain_avi_files_are_read_frame_by_frame(spark, tmp_path):
    for name, how in {"a": {}, "b": {"bits": 32}, "c": {"down": True}, "d": {"sound": True}}.items():
        (tmp_path / f"{name}.AVI").write_bytes(avi([*SHOWN[:3], None, *SHOWN[3:]], **how))
    frames = read_frames(video_index(spark, str(tmp_path)), 2).collect()
    assert len(frames) == 4 * 6
    for r in frames:
        n = r["frame_idx"] - (r["frame_idx"] > 2)
        assert (picture(r["data"], r["width"], r["height"], r["channels"]) == SHOWN[n]).all(), (r["video"], r["frame_idx"])


def test_planes_are_turned_into_colours(spark, tmp_path):
    def planes(shown, across, down):
        b, g, r = (shown[..., k].astype(float) for k in range(3))
        y, u, v = 16 + 0.256788 * r + 0.504129 * g + 0.097906 * b, 128 - 0.148223 * r - 0.290993 * g + 0.439216 * b, 128 + 0.439216 * r - 0.367788 * g - 0.071427 * b
        return np.concatenate([np.rint(p).astype(np.uint8).ravel() for p in (y, u[::down, ::across], v[::down, ::across])]).tobytes()

    flat = [np.full((5, 7, 3), c, np.uint8) for c in ((200, 30, 40), (10, 220, 90), (60, 60, 250))]
    for said, (across, down) in {"C420jpeg": (2, 2), "C422": (2, 1), "C444": (1, 1), "": (2, 2)}.items():
        body = b"".join(b"FRAME Ip\n" * (n == 1) + b"FRAME\n" * (n != 1) + planes(f, across, down) for n, f in enumerate(flat))
        (tmp_path / f"p{said}.y4m").write_bytes(f"YUV4MPEG2 W7 H5 F25:1 {said}".strip().encode() + b"\n" + body + b"FRAME\nxx")
    frames = read_frames(video_index(spark, str(tmp_path))).collect()
    assert len(frames) == 12
    for r in frames:
        assert np.abs(picture(r["data"], 7, 5, 3).astype(int) - flat[r["frame_idx"]]).max() <= 3, (r["video"], r["frame_idx"])


def test_what_has_no_frames_for_us_says_why(spark, tmp_path):
    (tmp_path / "mjpg.avi").write_bytes(avi(SHOWN[:1], packing=0x47504A4D))
    (tmp_path / "words.avi").write_bytes(b"no video")
    (tmp_path / "none.avi").write_bytes(b"")
    (tmp_path / "deep.y4m").write_bytes(b"YUV4MPEG2 W7 H5 C420p10\n")
    (tmp_path / "empty.y4m").write_bytes(b"YUV4MPEG2 W7 H5\n")
    (tmp_path / "cut.avi").write_bytes(avi(SHOWN)[:-200])
    (tmp_path / "x.mp4").write_bytes(b"not looked at")
    found = video_index(spark, str(tmp_path))
    why = {r["path"].rsplit("/", 1)[1]: r["failure"] for r in found.where("failure is not null").collect()}
    assert set(why) == {"mjpg.avi", "words.avi", "deep.y4m"} and "MJPG" in why["mjpg.avi"]
    assert {r["path"].rsplit("/", 1)[1] for r in found.where("failure is null").collect()} == {"cut.avi"}
    assert 0 < read_frames(found).count() < 5


def test_frames_of_a_file_become_keyframes(spark, tmp_path):
    checks = np.repeat((np.indices((64, 64)).sum(0) % 2)[..., None], 3, axis=2)
    strong, weak = (checks * 255).astype(np.uint8), (checks * 80 + 90).astype(np.uint8)
    (tmp_path / "v.avi").write_bytes(avi([strong, strong, weak, weak, strong]))
    frames = read_frames(video_index(spark, str(tmp_path)), 2)
    keys = clean_videos(frame_features(frames)).orderBy("frame_idx").collect()
    assert [(r["frame_idx"], r["name"]) for r in keys] == [(0, "v_frame_00000.jpg"), (2, "v_frame_00001.jpg"), (4, "v_frame_00002.jpg")]
