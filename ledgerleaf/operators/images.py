"""Page degradation on raw grey or RGB pixels (height, width, channels uint8), by Arrow batches of numpy arrays.

Each step takes (pixels, generator, amount) and gives pixels of the same shape; a tier is a list of steps.  The
generator depends on the row's seed alone, so results do not depend on partitioning.  JPEG needs a codec and is
left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import TIERS


def _u8(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def _sample(px: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Nearest pixels at float coordinates, white outside."""
    iy, ix = np.rint(y).astype(int), np.rint(x).astype(int)
    inside = (iy >= 0) & (iy < px.shape[0]) & (ix >= 0) & (ix < px.shape[1])
    out = np.full_like(px, 255)
    out[inside] = px[iy[inside], ix[inside]]
    return out


@functools.lru_cache(maxsize=8)
def _places(height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a size's pixels as a column and a row, which broadcast; pages of a size share them."""
    y, x = np.arange(height, dtype=float)[:, None], np.arange(width, dtype=float)[None, :]
    y.flags.writeable = x.flags.writeable = False
    return y, x


def _grid(px: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _places(*px.shape[:2])


def rotate(px, rng, degrees):
    a = np.deg2rad(rng.uniform(-degrees, degrees))
    y, x = _grid(px)
    cy, cx = (px.shape[0] - 1) / 2, (px.shape[1] - 1) / 2
    return _sample(px, cy + (y - cy) * np.cos(a) - (x - cx) * np.sin(a), cx + (y - cy) * np.sin(a) + (x - cx) * np.cos(a))


def gaussian_noise(px, rng, sigma):
    return _u8(px + rng.normal(0, sigma, px.shape))


def salt_pepper(px, rng, share):
    out, r = px.copy(), rng.random(px.shape[:2])
    out[r < share / 2] = 0
    out[r > 1 - share / 2] = 255
    return out


def fade(px, rng, black):
    """Black becomes the grey ``black``, white stays."""
    return _u8(black + px.astype(float) * (255 - black) / 255)


def binarize(px, rng, level):
    grey = px.mean(axis=2, keepdims=True)
    return np.broadcast_to(np.where(grey > level, 255, 0), px.shape).astype(np.uint8)


def vertical_streaks(px, rng, count):
    out = px.copy()
    for x in rng.integers(0, px.shape[1], int(count)):
        out[:, x] = np.minimum(out[:, x], rng.integers(120, 200))
    return out


def resample(px, rng, factor):
    h, w = (max(1, int(n / factor)) for n in px.shape[:2])
    small = px[np.arange(h) * px.shape[0] // h][:, np.arange(w) * px.shape[1] // w]
    return small[np.arange(px.shape[0]) * h // px.shape[0]][:, np.arange(px.shape[1]) * w // px.shape[1]]


def perspective(px, rng, amount):
    y, x = _grid(px)
    ky, kx = rng.uniform(-amount, amount, 2) / np.array(px.shape[:2])
    z = 1 + ky * (y - px.shape[0] / 2) + kx * (x - px.shape[1] / 2)
    return _sample(px, px.shape[0] / 2 + (y - px.shape[0] / 2) / z, px.shape[1] / 2 + (x - px.shape[1] / 2) / z)


def lighting(px, rng, amount):
    """A slope of light across the page at a drawn angle, from 1 - amount to 1 + amount."""
    y, x = _grid(px)
    a = rng.uniform(0, 2 * np.pi)
    ramp = np.sin(a) * y / px.shape[0] + np.cos(a) * x / px.shape[1]
    ramp = (ramp - ramp.min()) / max(1e-6, np.ptp(ramp))
    return _u8(px * (1 + amount * (2 * ramp - 1))[..., None])


def shadow(px, rng, amount, sides: int = 4):
    """Darkest at a drawn side (left, right, top, bottom) by amount, falling off to the other."""
    side = int(rng.integers(0, sides))
    n = px.shape[1] if side < 2 else px.shape[0]
    fall = 1 - amount * np.linspace(1, 0, n)[:: -1 if side % 2 else 1]
    return _u8(px * (fall[None, :, None] if side < 2 else fall[:, None, None]))


def side_shadow(px, rng, amount):
    return shadow(px, rng, amount, 2)


def blur(px, rng, radius):
    k = max(1, int(3 * radius + 0.5))
    weight = np.exp(-0.5 * (np.arange(-k, k + 1) / radius) ** 2)
    weight /= weight.sum()
    out = px.astype(float)
    for axis in (0, 1):
        pad = np.pad(out, [(k, k) if i == axis else (0, 0) for i in range(3)], mode="edge")
        out = sum(w * np.take(pad, np.arange(px.shape[axis]) + i, axis=axis) for i, w in enumerate(weight))
    return _u8(out)


def _disc(px, cy, cx, r):
    y, x = _grid(px)
    return (y - cy) ** 2 + (x - cx) ** 2, r**2


def staple_holes(px, rng, count):
    out = px.copy()
    for _ in range(int(count)):
        d, r2 = _disc(px, rng.uniform(0, px.shape[0] * 0.08), rng.uniform(0, px.shape[1] * 0.15), max(1, min(px.shape[:2]) * 0.004))
        out[d <= r2] = 30
    return out


def coffee_stain(px, rng, amount):
    r = min(px.shape[:2]) * rng.uniform(0.08, 0.15)
    d, r2 = _disc(px, rng.uniform(0, px.shape[0]), rng.uniform(0, px.shape[1]), r)
    ring = np.abs(np.sqrt(d) - r) < r * 0.12
    tint = np.array([1, 0.85, 0.65])[: px.shape[2]]
    return np.where(ring[..., None], _u8(px * (1 - amount + amount * tint * 0.8)), px)


def redaction_bars(px, rng, count):
    out, (h, w) = px.copy(), px.shape[:2]
    for _ in range(int(count)):
        y, x = rng.integers(0, h), rng.integers(0, w)
        out[y : y + max(1, h // 60), x : x + max(1, w // 6)] = 0
    return out


def crinkle(px, rng, amount):
    y, x = _grid(px)
    py, pxs = rng.uniform(0, 2 * np.pi, 2)
    return _sample(px, y + amount * np.sin(x / 17 + py), x + amount * np.sin(y / 23 + pxs))


# fixed values: the steps of a tier with their amounts; a pair is drawn from, both ends included
STEPS: dict[str, list[tuple]] = {
    "pristine": [],
    "clean_scan": [(rotate, 1.0), (gaussian_noise, 2), (fade, 10)],
    "worn_scan": [(rotate, 3.0), (gaussian_noise, 5), (fade, 40), (salt_pepper, 0.0008)],
    "fax": [(rotate, 2.0), (binarize, 160), (vertical_streaks, (6, 15)), (resample, 2)],
    "phone_photo": [(perspective, 0.03), (rotate, 1.5), (lighting, 0.20), (shadow, 0.25), (blur, 0.8)],
    "worst": [
        (crinkle, 4.0),
        (rotate, 5.0),
        (gaussian_noise, 6),
        (fade, 50),
        (side_shadow, 0.30),
        (coffee_stain, 0.35),
        (staple_holes, 2),
        (redaction_bars, (1, 3)),
    ],
}
assert tuple(STEPS) == TIERS


def degrade(px: np.ndarray, tier: str, seed: int) -> np.ndarray:
    if tier not in STEPS:
        raise ValueError(f"unknown tier: {tier}")
    rng = np.random.default_rng(seed)
    for step, amount in STEPS[tier]:
        px = step(px, rng, int(rng.integers(amount[0], amount[1] + 1)) if isinstance(amount, tuple) else amount)
    return px


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for raw, h, w, tier, seed in zip(b["pixels"], b["height"], b["width"], b["tier"], b["seed"]):
            px = np.frombuffer(raw, np.uint8).reshape(h, w, -1)
            out.append(degrade(px, tier, int(seed)).tobytes())
        yield b.assign(pixels=out)[["sample_id", "tier", "seed", "height", "width", "pixels"]]


def apply_tiers(images: DataFrame) -> DataFrame:
    """images (sample_id, tier, seed, height, width, pixels) degraded by tier."""
    return images.select("sample_id", "tier", "seed", "height", "width", "pixels").mapInPandas(
        _run,
        "sample_id string, tier string, seed long, height int, width int, pixels binary",
    )


def crop(px: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    x0, y0, x1, y1 = box
    return px[y0:y1, x0:x1]


def _cropped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            px = crop(np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, -1), (r.x0, r.y0, r.x1, r.y1))
            out.append((r.sample_id, r.region, *px.shape[:2], px.tobytes()))
        yield pd.DataFrame(out, columns=["sample_id", "region", "height", "width", "pixels"])


def crop_regions(images: DataFrame, bands: list[tuple[str, int, int, int, int]]) -> DataFrame:
    """(sample_id, region, height, width, pixels): every page cut at each of the bands (region, x0, y0, x1, y1)."""
    each = F.array(*(F.struct(F.lit(n).alias("region"), *(F.lit(v).alias(c) for c, v in zip(("x0", "y0", "x1", "y1"), box))) for n, *box in bands))
    rows = images.select("sample_id", "height", "width", "pixels", F.inline(each))
    return rows.mapInPandas(_cropped, "sample_id string, region string, height int, width int, pixels binary")
