"""Reading pictures in tasks: PNG by numpy, other formats by an installed codec."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

# The signature of the format and its channels by colour type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GREY, RGB, PALETTE, GREY_ALPHA, RGB_ALPHA = 0, 2, 3, 4, 6
CHANNELS = {GREY: 1, RGB: 3, PALETTE: 1, GREY_ALPHA: 2, RGB_ALPHA: 4}


def _chunks(data: bytes) -> dict[bytes, bytes]:
    """Contents by kind, those of one kind joined."""
    found: dict[bytes, list[bytes]] = {}
    at = len(SIGNATURE)
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        found.setdefault(kind, []).append(data[at + 8 : at + 8 + size])
        at += size + 12
    return {kind: b"".join(parts) for kind, parts in found.items()}


def _paeth(left: int, above: int, corner: int) -> int:
    guess = left + above - corner
    by_left, by_above, by_corner = abs(guess - left), abs(guess - above), abs(guess - corner)
    if by_left <= by_above and by_left <= by_corner:
        return left
    return above if by_above <= by_corner else corner


def _unfiltered(raw: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """Lines as they were before each was written as differences to its neighbours."""
    out = np.zeros_like(raw)
    above = np.zeros(raw.shape[1], np.uint8)
    for y, kind in enumerate(kinds.tolist()):
        line = raw[y]
        if kind == 1:
            line = np.add.accumulate(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            made, over = line.tolist(), above.tolist()
            for x in range(len(made)):
                left = made[x - step] if x >= step else 0
                corner = over[x - step] if x >= step else 0
                made[x] = (made[x] + ((left + over[x]) // 2 if kind == 3 else _paeth(left, over[x], corner))) & 255
            line = np.array(made, np.uint8)
        elif kind:
            raise ValueError("unknown line filter")
        out[y] = above = line
    return out


def read_png(data: bytes) -> np.ndarray:
    """Height x width x 1, 3 or 4 values: grey, RGB or RGBA of 8 bits a channel."""
    chunks = _chunks(data)
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[b"IHDR"][:13])
    if depth != 8 or interlaced or colour not in CHANNELS:
        raise ValueError("only whole pictures of 8 bits a channel")
    step = CHANNELS[colour]
    lines = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), np.uint8).reshape(height, 1 + width * step)
    pixels = _unfiltered(lines[:, 1:], lines[:, 0], step).reshape(height, width, step)
    if colour == PALETTE:
        return np.frombuffer(chunks[b"PLTE"], np.uint8).reshape(-1, 3)[pixels[:, :, 0]]
    return pixels[:, :, :1] if colour == GREY_ALPHA else pixels


def read_picture(data: bytes) -> np.ndarray | None:
    """The pixels of a picture in any format that can be read here; none if it cannot."""
    try:
        if data.startswith(SIGNATURE):
            return read_png(data)
        from PIL import Image

        with Image.open(io.BytesIO(data)) as picture:
            return np.asarray(picture.convert("RGB"))
    except (ImportError, OSError, ValueError, KeyError, struct.error, zlib.error):
        return None
