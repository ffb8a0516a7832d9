"""Pixel arrays: channel order, bilinear resize, normalisation."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Side of the model input, and the mean / deviation per channel.
SIDE = 224
MEAN = (0.5, 0.5, 0.5)
STD = (0.5, 0.5, 0.5)
# Fraction bits of the resize weights; 8-bit pictures are resampled in integers.
FRACTION = 22


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Bytes of Spark's image source (grey, BGR or BGRA) to height x width x RGB."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, 2::-1]


@lru_cache(maxsize=256)
def resize_weights(size: int, side: int = SIDE) -> np.ndarray:
    """Triangle filter as a side x size matrix of whole numbers; widens when shrinking."""
    scale = size / side
    support = max(scale, 1.0)
    centre = (np.arange(side) + 0.5) * scale
    low = np.maximum((centre - support + 0.5).astype(np.int64), 0)
    high = np.minimum((centre + support + 0.5).astype(np.int64), size)
    source = np.arange(size)
    weight = np.maximum(0.0, 1.0 - np.abs(source + 0.5 - centre[:, None]) / support)
    weight[(source < low[:, None]) | (source >= high[:, None])] = 0.0
    weight /= weight.sum(axis=1, keepdims=True)
    return np.floor(weight * (1 << FRACTION) + 0.5)


def _resample(pixels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    # Sums stay far below 2**53, so the float products are exact.
    total = weights @ pixels.reshape(len(pixels), -1).astype(np.float64)
    rounded = np.floor((total + (1 << (FRACTION - 1))) / (1 << FRACTION))
    return np.clip(rounded, 0, 255).reshape(len(weights), *pixels.shape[1:])


def resized(rgb: np.ndarray, side: int = SIDE) -> np.ndarray:
    """Resize width then height: side x side x RGB of 8 bits."""
    height, width, _ = rgb.shape
    if height == width == side:
        return rgb
    wide = _resample(rgb.swapaxes(0, 1), resize_weights(width, side)).swapaxes(0, 1)
    return _resample(wide, resize_weights(height, side)).astype(np.uint8)


def normalised(pixels: np.ndarray, mean=MEAN, std=STD) -> np.ndarray:
    """Scale 8 bits to 0..1, normalise, channels first, flat."""
    values = (pixels.astype(np.float32) / 255.0 - np.float32(mean)) / np.float32(std)
    return values.transpose(2, 0, 1).astype(np.float32).ravel()


def model_pixels(rgb: np.ndarray, side: int = SIDE, mean=MEAN, std=STD) -> np.ndarray:
    """Resize width then height, scale to 0..1, normalise, channels first, flat."""
    return normalised(resized(rgb, side), mean, std)


def channel_means(values: np.ndarray) -> np.ndarray:
    """Mean of each channel of a model input, in doubles."""
    return values.reshape(3, -1).mean(axis=1, dtype="float64")
