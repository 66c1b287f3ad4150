"""Small GeoTIFF files in numpy: strips or tiles, plain or deflate, up to several bands; and a Spark reader over them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..specs import NODATA

_SIZES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}


def read_geotiff(data: bytes, window=None) -> dict:
    """``bands`` (list of arrays), ``x0, y0, gsd_x, gsd_m, epsg, nodata`` of the first image of a file.

    ``window``: a function from the file's head (the same fields, with ``height`` and ``width`` in place of bands) to the
    rows and columns wanted (top, left, bottom, right). Only blocks that it touches are unpacked, and the result is the
    window: ``x0, y0`` are its own corner.
    """
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    if struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF")
    at = struct.unpack_from(order + "I", data, 4)[0]
    tags: dict[int, tuple] = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        code, size = _SIZES.get(kind, ("B", 1))
        where = at + 10 + 12 * i if n * size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
        tags[tag] = (data[where : where + n].rstrip(b"\0"),) if kind == 2 else struct.unpack_from(f"{order}{n * len(code)}{code[0]}", data, where)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, bands, packing = one(256, 0), one(257, 0), one(277, 1), one(259, 1)
    if packing not in (1, 8, 32946) or one(317, 1) != 1:
        raise ValueError("only plain and deflate images without a predictor")
    dtype = np.dtype({1: "u", 2: "i", 3: "f"}[one(339, 1)] + str(one(258, 8) // 8)).newbyteorder(order)
    tiled = 322 in tags
    tw, th = (one(322, 0), one(323, 0)) if tiled else (width, one(278, height))
    offsets, sizes = tags[324 if tiled else 273], tags[325 if tiled else 279]
    planar = one(284, 1) == 2
    across, down = -(-width // tw), -(-height // th)
    scale, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6)
    keys = tags.get(34735, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (3072, 2048)), None)
    nodata = float(tags[42113][0].decode()) if 42113 in tags else None
    head = {"x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "gsd_x": scale[0], "gsd_m": scale[1], "epsg": epsg, "nodata": nodata}
    top, left, bottom, right = window({**head, "height": height, "width": width}) if window else (0, 0, height, width)
    top, left, bottom, right = max(0, top), max(0, left), min(height, bottom), min(width, right)
    if top >= bottom or left >= right:
        top = left = bottom = right = 0
    out = [np.zeros((bottom - top, right - left), dtype.newbyteorder("=")) for _ in range(bands)]
    for k, (o, n) in enumerate(zip(offsets, sizes, strict=True)):
        band, cell = divmod(k, across * down) if planar else (0, k)
        r, c = divmod(cell, across)
        r, c = r * th, c * tw
        if r >= bottom or r + th <= top or c >= right or c + tw <= left:
            continue
        raw = zlib.decompress(data[o : o + n]) if packing != 1 else data[o : o + n]
        depth = 1 if planar else bands
        block = np.frombuffer(raw, dtype)
        block = block[: len(block) // (tw * depth) * tw * depth].reshape(-1, tw, depth)
        r0, r1, c0, c1 = max(r, top), min(r + len(block), bottom), max(c, left), min(c + tw, right)
        for b in range(depth):
            out[band + b][r0 - top : r1 - top, c0 - left : c1 - left] = block[r0 - r : r1 - r, c0 - c : c1 - c, b]
    return head | {"bands": out, "x0": head["x0"] + left * scale[0], "y0": head["y0"] - top * scale[1]}


def write_geotiff(bands: list[np.ndarray], x0: float, y0: float, gsd: float, epsg: int, nodata: float = NODATA, tile: int = 256) -> bytes:
    """A tiled deflate file of 32-bit floats, one plane a band."""
    height, width = bands[0].shape
    across, down = -(-width // tile), -(-height // tile)
    blocks = []
    for b in bands:
        padded = np.full((down * tile, across * tile), nodata, "<f4")
        padded[:height, :width] = b
        blocks += [zlib.compress(padded[r * tile : (r + 1) * tile, c * tile : (c + 1) * tile].tobytes()) for r in range(down) for c in range(across)]
    n, k = len(bands), len(blocks)
    ends = np.cumsum([8] + [len(x) for x in blocks]).tolist()
    none = f"{nodata:g}".encode() + b"\0"
    fields = [
        (256, 4, [width]), (257, 4, [height]), (258, 3, [32] * n), (259, 3, [8]), (262, 3, [1]), (277, 3, [n]), (284, 3, [2]),
        (322, 4, [tile]), (323, 4, [tile]), (324, 4, ends[:-1]), (325, 4, [len(x) for x in blocks]), (339, 3, [3] * n),
        (33550, 12, [gsd, gsd, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (34735, 3, [1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, epsg]), (42113, 2, none),
    ]
    start = ends[-1] + ends[-1] % 2
    extra_at, head, extra = start + 2 + 12 * len(fields) + 4, b"", b""
    for tag, kind, values in fields:
        code, size = _SIZES[kind]
        raw = values if kind == 2 else struct.pack(f"<{len(values)}{code}", *values)
        head += struct.pack("<HHI", tag, kind, len(raw) // size)
        if len(raw) <= 4:
            head += raw.ljust(4, b"\0")
        else:
            head += struct.pack("<I", extra_at + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
    body = b"".join(blocks)
    assert k == len(ends) - 1
    return b"II" + struct.pack("<HI", 42, start) + body + b"\0" * (start - 8 - len(body)) + struct.pack("<H", len(fields)) + head + b"\0\0\0\0" + extra


def read_surfaces(spark: SparkSession, path: str) -> DataFrame:
    """Packed surfaces from GeoTIFF files: band 1 elevation, band 2 provenance; no-data pixels become NaN. Named by tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                got = read_geotiff(raw.as_py())
                elevation = got["bands"][0].astype(np.float32)
                elevation[~np.isfinite(elevation) | (elevation == np.float32(NODATA if got["nodata"] is None else got["nodata"]))] = np.nan
                codes = got["bands"][1].astype(np.int8).tobytes() if len(got["bands"]) > 1 else None
                tile = name.rsplit("/", 1)[-1].rsplit(".", 1)[0].split("__", 1)[0]
                yield pa.RecordBatch.from_pylist([{"tile_id": tile, "height": elevation.shape[0], "width": elevation.shape[1], "x0": got["x0"], "y0": got["y0"], "gsd_m": got["gsd_m"], "epsg": got["epsg"], "elevation": elevation.tobytes(), "provenance": codes}], schema=schema)

    schema = pa.schema([("tile_id", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("x0", pa.float64()), ("y0", pa.float64()), ("gsd_m", pa.float64()), ("epsg", pa.int32()), ("elevation", pa.binary()), ("provenance", pa.binary())])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "tile_id string, height int, width int, x0 double, y0 double, gsd_m double, epsg int, elevation binary, provenance binary")
