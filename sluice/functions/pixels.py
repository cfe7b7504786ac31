"""Pixel kernels on numpy arrays: pictures are height x width x 3 in the order blue, green, red.

They follow the usual definitions of the image libraries; resampling and edge
linking are not bit for bit the same as any one library's.
"""

from __future__ import annotations

import numpy as np


def gray(picture: np.ndarray) -> np.ndarray:
    """Luma, rounded: in whole thousandths, so halves go up whatever the order of sums."""
    return ((picture.astype(np.int64) @ np.array([114, 587, 299]) + 500) // 1000).astype(np.uint8)


def _mirrored(plane: np.ndarray, by: int = 1) -> np.ndarray:
    return np.pad(plane.astype(float), by, mode="reflect" if min(plane.shape) > by else "edge")


def laplacian_variance(plane: np.ndarray) -> float:
    p = _mirrored(plane)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def histogram(picture: np.ndarray) -> np.ndarray:
    """256 bins for each channel, each channel's of unit length."""
    parts = [np.bincount(picture[..., c].ravel(), minlength=256).astype(float) for c in range(3)]
    return np.concatenate([p / n if (n := np.linalg.norm(p)) else p for p in parts])


def resized(plane: np.ndarray, height: int, width: int, lobes: int = 3) -> np.ndarray:
    """Lanczos resampling of a plane, widened for reduction."""

    def weights(old: int, new: int) -> np.ndarray:
        scale = max(old / new, 1.0)
        centre = (np.arange(new) + 0.5) * old / new - 0.5
        x = (np.arange(old) - centre[:, None]) / scale
        w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0)
        return w / w.sum(1, keepdims=True)

    return weights(plane.shape[0], height) @ plane @ weights(plane.shape[1], width).T


def resized_picture(picture: np.ndarray, height: int, width: int) -> np.ndarray:
    """A picture of three channels resampled to a size, whatever its shape was."""
    planes = [resized(picture[..., c].astype(float), height, width) for c in range(3)]
    return np.clip(np.rint(np.stack(planes, 2)), 0, 255).astype(np.uint8)


def perceptual_hash(picture: np.ndarray, side: int = 8, factor: int = 4) -> int:
    """64 bits, as a signed long: which of the lowest cosine coefficients of the reduced picture exceed their median."""
    n = side * factor
    small = resized(gray(picture).astype(float), n, n)
    k = np.arange(n)
    cosine = np.cos(np.pi * (2 * k + 1) * k[:, None] / (2 * n))
    low = (cosine @ small @ cosine.T)[:side, :side].ravel()
    value = 0
    for bit in low > np.median(low):
        value = value << 1 | int(bit)
    return value - (1 << 64) if value >> 63 else value


def blue_share(picture: np.ndarray) -> float:
    """Share of pixels with a hue of 100 to 130 half degrees and a saturation and value of at least 50."""
    b, g, r = (picture[..., c].astype(float) for c in range(3))
    top, low = picture.max(2).astype(float), picture.min(2).astype(float)
    spread = top - low
    with np.errstate(divide="ignore", invalid="ignore"):
        saturation = np.where(top > 0, spread / top * 255, 0)
        hue = np.where(top == r, 60 * (g - b) / spread, np.where(top == g, 120 + 60 * (b - r) / spread, 240 + 60 * (r - g) / spread))
    hue = np.where(spread > 0, hue % 360 / 2, 0)
    hit = (np.rint(hue) >= 100) & (np.rint(hue) <= 130) & (np.rint(saturation) >= 50) & (top >= 50)
    return float(hit.mean())


def edge_share(plane: np.ndarray, low: float = 100, high: float = 200) -> float:
    """Share of edge pixels: Sobel gradients, thinned across their direction, linked from strong to weak ones."""
    p = _mirrored(plane)
    dx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    dy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    size = np.abs(dx) + np.abs(dy)
    around = np.pad(size, 1)
    h, w = size.shape

    def moved(r: int, c: int) -> np.ndarray:
        return around[1 + r : 1 + r + h, 1 + c : 1 + c + w]

    angle = np.rad2deg(np.arctan2(dy, dx)) % 180
    sector = ((angle + 22.5) // 45).astype(int) % 4
    thin = np.zeros(size.shape, bool)
    for k, (r, c) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        thin |= (sector == k) & (size > moved(-r, -c)) & (size >= moved(r, c))
    weak, edges = thin & (size > low), thin & (size > high)
    while True:
        grown = np.pad(edges, 1)
        near = np.zeros_like(edges)
        for r in (0, 1, 2):
            for c in (0, 1, 2):
                near |= grown[r : r + h, c : c + w]
        more = weak & near
        if (more == edges).all():
            return float(edges.mean())
        edges = more
