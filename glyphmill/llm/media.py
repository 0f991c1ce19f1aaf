"""Media columns: Netpbm and BMP to numpy arrays, area resize by integral images, NPY tiles, difference hashes.

Texts stand in for media bytes: the UTF-8 bytes of a text, filled up with bytes 255 to a positive multiple of 576,
become the samples of a binary greymap (P5), which stores 8-bit samples without loss.

Defined results: a null or empty text is 576 filler bytes; equal texts have equal values; malformed images
raise ValueError in decode() and give null columns in decode_column(); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame

from .common import id_and_text

UNIT = 576
TILE = 16
STRIP_PIXELS = 1 << 20


def _header(data: bytes, count: int) -> tuple[list[int], int]:
    """The numbers behind a Netpbm magic, and where the samples begin. Comments run from # to the line's end."""
    numbers, at = [], 2
    while len(numbers) < count:
        while at < len(data) and (data[at : at + 1].isspace() or data[at] == 35):
            if data[at] == 35:
                end = data.find(b"\n", at)
                at = len(data) if end < 0 else end
            else:
                at += 1
        start = at
        while at < len(data) and 48 <= data[at] <= 57:
            at += 1
        if start == at:
            raise ValueError("Netpbm: a number is missing in the header")
        numbers.append(int(data[start:at]))
    return numbers, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as (height, width) or (height, width, 3) arrays; uint8, or uint16 if the maximum is above 255. Bitmaps are 0 (black) and 255."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    bitmap, channels = kind in (b"P1", b"P4"), 3 if kind in (b"P3", b"P6") else 1
    numbers, at = _header(data, 2 if bitmap else 3)
    width, height, most = (*numbers, 1)[:3]
    if width <= 0 or height <= 0 or not 0 < most < 65536:
        raise ValueError("Netpbm: bad size or maximum")
    n = width * height * channels
    if n > 8 * len(data):
        raise ValueError("Netpbm: samples are missing")
    if kind == b"P4":
        row = (width + 7) // 8
        bits = np.frombuffer(data, np.uint8, row * height, at).reshape(height, row)
        return (1 - np.unpackbits(bits, axis=1)[:, :width]) * np.uint8(255)
    if kind == b"P1":
        samples = np.array([c - 48 for c in data[at - 1 :] if c in (48, 49)][:n], np.uint8)
    elif kind in (b"P2", b"P3"):
        words = data[at - 1 :].split()[:n]
        if not all(len(w) < 10 and w.isdigit() for w in words):
            raise ValueError("Netpbm: a sample is no number")
        samples = np.array(words, np.int64)
    else:
        samples = np.frombuffer(data, ">u2" if most > 255 else np.uint8, n, at)
    if len(samples) < n:
        raise ValueError("Netpbm: samples are missing")
    if len(samples) and samples.max() > most:
        raise ValueError("Netpbm: a sample is above the maximum")
    if samples.dtype == np.int64:
        samples = samples.astype(np.uint16 if most > 255 else np.uint8)
    if bitmap:
        samples = (1 - samples) * np.uint8(255)
    return samples.reshape((height, width) if channels == 1 else (height, width, 3))


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits: (height, width) if every palette entry is grey, else (height, width, 3)."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not a BMP image")
    offset, size, width, height, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32) or width <= 0 or height == 0 or packed == 3 and bits != 32:
        raise ValueError("BMP: this kind is not supported")
    rows, row = abs(height), (width * bits + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, rows * row, offset).reshape(rows, row)
    if height > 0:
        raw = raw[::-1]
    if bits >= 24:
        return raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, 2::-1].copy()
    colours = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + size).reshape(-1, 4)[:, 2::-1]
    if bits == 8:
        index = raw[:, :width]
    else:
        per = 8 // bits
        index = np.stack([raw >> (8 - bits * (k + 1)) & (1 << bits) - 1 for k in range(per)], axis=2).reshape(rows, -1)[:, :width]
    if index.max() >= len(palette):
        raise ValueError("BMP: a sample is not in the palette")
    image = palette[index]
    grey = (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all()
    return image[:, :, 0].copy() if grey else image


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_netpbm(image: np.ndarray) -> bytes:
    """uint8 arrays as P5 or P6."""
    height, width = image.shape[:2]
    return b"P%d\n%d %d\n255\n" % (6 if image.ndim == 3 else 5, width, height) + np.ascontiguousarray(image, np.uint8).tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """uint8 arrays as 8-bit grey or 24-bit BMP, bottom row first."""
    height, width = image.shape[:2]
    grey = image.ndim == 2
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1) * np.array([1, 1, 1, 0], np.uint8) if grey else np.zeros((0, 4), np.uint8)
    pixels = image[::-1] if grey else image[::-1, :, ::-1].reshape(height, -1)
    row = (pixels.shape[1] + 3) // 4 * 4
    body = np.zeros((height, row), np.uint8)
    body[:, : pixels.shape[1]] = pixels
    offset = 54 + palette.size
    return b"BM" + struct.pack("<IHHI", offset + body.size, 0, 0, offset) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if grey else 24, 0, body.size, 2835, 2835, len(palette), 0) + palette.tobytes() + body.tobytes()


def _edges(size: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts' edges lie: whole samples before each edge, and the share of the next one."""
    at = np.arange(parts + 1) * size / parts
    whole = np.minimum(at.astype(np.int64), size - 1)
    return whole, at - whole


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the boxes of a height x width grid laid over the image, as float64. Boxes may cut through samples.

    The sum over any box is a difference of the integral image at its corners, linear between samples. The
    integral image is made strip by strip and kept only at the grid's rows, so memory doesn't follow the image's height.
    """
    grey = image if image.ndim == 2 else image.mean(axis=2)
    rows, columns = grey.shape
    x, x_share = _edges(columns, width)
    y, y_share = _edges(rows, height)
    at_rows = np.zeros((height + 1, width + 1))
    carry = np.zeros(width + 1)
    step = max(1, STRIP_PIXELS // columns)
    for top in range(0, rows, step):
        strip = grey[top : top + step]
        sums = np.zeros((len(strip), columns + 1), np.int64 if strip.dtype.kind == "u" else np.float64)
        np.cumsum(strip, axis=1, out=sums[:, 1:])
        at_columns = sums[:, x] + strip[:, x] * x_share
        integral = carry + np.concatenate([np.zeros((1, width + 1)), np.cumsum(at_columns, axis=0)])
        inside = np.flatnonzero((y >= top) & (y < top + len(strip)))
        at_rows[inside] = integral[y[inside] - top] + at_columns[y[inside] - top] * y_share[inside, None]
        carry = integral[-1]
    boxes = np.diff(np.diff(at_rows, axis=0), axis=1)
    return boxes / (rows / height * columns / width)


def to_npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, tile, allow_pickle=False)
    return out.getvalue()


def difference_hash(image: np.ndarray) -> int:
    """64 bits: whether each of 8 x 9 box means is below its right neighbour, row by row, first bit highest."""
    means = area_resize(image, 8, 9)
    return int.from_bytes(np.packbits((means[:, :-1] < means[:, 1:]).ravel()).tobytes(), "big")


def tile(image: np.ndarray, side: int = TILE) -> np.ndarray:
    return np.clip(np.rint(area_resize(image, side, side)), 0, 255).astype(np.uint8)


def shape_of(units: int) -> tuple[int, int]:
    """Height and width of 576 x units samples, both multiples of 24, as near to a square as whole samples allow."""
    d = next(d for d in range(int(units**0.5), 0, -1) if units % d == 0)
    return 24 * (units // d), 24 * d


def payload_image(data: bytes) -> np.ndarray:
    units = max(1, -(-len(data) // UNIT))
    samples = np.full(units * UNIT, 255, np.uint8)
    samples[: len(data)] = np.frombuffer(data, np.uint8)
    return samples.reshape(shape_of(units))


def text_media(docs: DataFrame, form: str = "pgm", keep_media: bool = False) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature; with keep_media also media and tile_npy.

    form: "pgm" or "bmp". The payload's columns come from the stored bytes, decoded again. Narrow, no shuffle.
    """
    encode = {"pgm": encode_netpbm, "bmp": encode_bmp}[form]

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            out: list[list] = [[] for _ in range(10)]
            size = 0
            for i in range(len(ids)):
                data = (texts[i].as_py() or "").encode()
                media = encode(payload_image(data))
                image = decode(media)
                payload = image.tobytes()
                npy = to_npy(tile(image))
                feature = f"dhash={difference_hash(image):016x};tile={hashlib.sha256(npy).hexdigest()[:16]}"
                values = (ids[i], len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, media if keep_media else None, npy if keep_media else None)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
                size += len(media) if keep_media else 0
                if size > 1 << 24 or i == len(ids) - 1:
                    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary()]
                    n = 10 if keep_media else 8
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:n], types[:n], strict=True)], NAMES[:n])
                    out, size = [[] for _ in range(10)], 0

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + (", media binary, tile_npy binary" if keep_media else "")
    return id_and_text(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media", "tile_npy"]


def decode_column(images: DataFrame, key: str, media: str, side: int = TILE) -> DataFrame:
    """For a table with stored images: key, height, width, dhash (16 hex digits) and tile_npy; nulls where the image can't be decoded."""
    key_type = images.schema[key].dataType.simpleString()

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            rows = []
            for data in batch.column("media").to_pylist():
                try:
                    image = decode(bytes(data))
                    rows.append((image.shape[0], image.shape[1], f"{difference_hash(image):016x}", to_npy(tile(image, side))))
                except (ValueError, TypeError):
                    rows.append((None,) * 4)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.binary()), strict=True))], ["key", "height", "width", "dhash", "tile_npy"])

    return images.selectExpr(f"`{key}` key", f"`{media}` media").mapInArrow(run, f"key {key_type}, height int, width int, dhash string, tile_npy binary").withColumnRenamed("key", key)
