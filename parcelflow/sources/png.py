"""PNG images of 8 bits a channel as rows of bytes: encoding and decoding inside tasks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Fixed values of the format: its first bytes, and the channels of each colour type.
MAGIC = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
#: Bytes of pixels that a task holds before it passes them on.
HELD = 1 << 24


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(image: np.ndarray) -> bytes:
    """An array (height, width, channels) of bytes as PNG."""
    h, w, c = image.shape
    kind = next(k for k, n in CHANNELS.items() if n == c)
    lines = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, w * c)], 1)
    return MAGIC + _chunk(b"IHDR", struct.pack(">2I5B", w, h, 8, kind, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def _paeth(a: int, b: int, c: int) -> int:
    p = a + b - c
    pa, pb, pc = abs(p - a), abs(p - b), abs(p - c)
    return a if pa <= pb and pa <= pc else b if pb <= pc else c


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, c: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:
        return (np.cumsum(line.reshape(-1, c), 0, dtype=np.uint64) % 256).astype(np.uint8).ravel()
    if kind == 2:
        return line + above
    out, up = [0] * c + line.tolist(), [0] * c + above.tolist()
    for i in range(c, len(out)):
        guess = (out[i - c] + up[i]) // 2 if kind == 3 else _paeth(out[i - c], up[i], up[i - c])
        out[i] = (out[i] + guess) % 256
    return np.array(out[c:], np.uint8)


def from_png(content: bytes) -> np.ndarray:
    """An array (height, width, channels); palettes, other depths and interlacing are errors."""
    if content[:8] != MAGIC:
        raise ValueError("not a PNG file")
    at, data, head = 8, [], None
    while at + 8 <= len(content):
        n, kind = struct.unpack_from(">I4s", content, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">2I5B", content, at + 8)
        if kind == b"IDAT":
            data.append(content[at + 8 : at + 8 + n])
        at += n + 12
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("only plain PNG of 8 bits a channel is read")
    w, h, c = head[0], head[1], CHANNELS[head[3]]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, 1 + w * c)
    above, out = np.zeros(w * c, np.uint8), []
    for line in lines:
        above = _unfiltered(int(line[0]), line[1:], above, c)
        out.append(above)
    return np.array(out, np.uint8).reshape(h, w, c)


def encoded(images: DataFrame) -> DataFrame:
    """(name, content) of (name, height, width, channels, pixels), pixels in rows, channels innermost."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = zip(b["pixels"], b["height"], b["width"], b["channels"], strict=True)
            yield pd.DataFrame({"name": b["name"], "content": [to_png(np.asarray(p, np.uint8).reshape(h, w, c)) for p, h, w, c in at]})

    return images.select("name", "height", "width", "channels", "pixels").mapInPandas(write, "name string, content binary")


def decoded(files: DataFrame) -> DataFrame:
    """(name, height, width, channels, pixels) of (name, content), pixels as bytes."""

    def frame(names: list[str], rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["height", "width", "channels", "pixels"]).assign(name=names)[["name", "height", "width", "channels", "pixels"]]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, rows, held = [], [], 0
            for name, content in zip(b["name"], b["content"], strict=True):
                a = from_png(content)
                names.append(name)
                rows.append((*a.shape, a.tobytes()))
                held += a.nbytes
                if held >= HELD:  # large images go on before all are read
                    yield frame(names, rows)
                    names, rows, held = [], [], 0
            if rows:
                yield frame(names, rows)

    return files.select("name", "content").mapInPandas(read, "name string, height int, width int, channels int, pixels binary")
