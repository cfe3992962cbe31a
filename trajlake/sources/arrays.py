"""NumPy array files and images as columns."""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_npy(spark: SparkSession, path: str, pattern: str = "*.npy") -> DataFrame:
    """path, shape, data (doubles, rows first), error: one row per file; a file that can't be decoded has its error and no data."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for p, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    a = np.load(io.BytesIO(content), allow_pickle=False)
                    row = (p, list(a.shape), a.astype(float).ravel(), None)
                except (ValueError, OSError, EOFError) as e:
                    row = (p, None, None, str(e)[:200])
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.int32())), pa.array(out[2], pa.list_(pa.float64())), pa.array(out[3], pa.string())], ["path", "shape", "data", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(decode, "path string, shape array<int>, data array<double>, error string")


def path_points(arrays: DataFrame) -> DataFrame:
    """path, step, x, y of N x 2 arrays."""
    n = F.get("shape", F.lit(0))
    ok = arrays.where((F.size("shape") == 2) & (F.get("shape", F.lit(1)) == 2) & (n > 0))
    s = ok.select("path", "data", F.explode(F.sequence(F.lit(0), n - 1)).alias("step"))
    return s.select("path", F.col("step").cast("long").alias("step"), F.get("data", F.col("step") * 2).alias("x"), F.get("data", F.col("step") * 2 + 1).alias("y"))


def raster_cells(arrays: DataFrame) -> DataFrame:
    """path, row, col, wx, wy, value of rasters whose first row and first column hold the world coordinates; row and col count from 0 without them."""
    h, w = F.get("shape", F.lit(0)), F.get("shape", F.lit(1))
    c = arrays.where(F.size("shape") == 2).select("path", "data", w.alias("w"), F.explode(F.sequence(F.lit(1), h - 1)).alias("r")).select("path", "data", "w", "r", F.explode(F.sequence(F.lit(1), F.col("w") - 1)).alias("c"))
    at = lambda r, c_: F.get("data", r * F.col("w") + c_)
    return c.select("path", (F.col("r") - 1).alias("row"), (F.col("c") - 1).alias("col"), at(F.lit(0), F.col("c")).alias("wx"), at(F.col("r"), F.lit(0)).alias("wy"), at(F.col("r"), F.col("c")).alias("value"))


def npy_bytes(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a, allow_pickle=False)
    return out.getvalue()


def png_bytes(a: np.ndarray) -> bytes:
    """An 8-bit grey (h, w), RGB or RGBA image as PNG."""
    a = np.ascontiguousarray(a, np.uint8)
    h, w = a.shape[:2]
    colour = {2: 0, 3: {3: 2, 4: 6}}[a.ndim]
    colour = colour if isinstance(colour, int) else colour[a.shape[2]]
    rows = np.hstack([np.zeros((h, 1), np.uint8), a.reshape(h, -1)]).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def png_pixels(data: bytes) -> np.ndarray:
    """The pixels of an 8-bit PNG without interlacing, grey, RGB or RGBA; ValueError for others and for damaged files."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", data, at + 8)
        elif kind == b"IDAT":
            packed += data[at + 8 : at + 8 + n]
        at += 12 + n
    if head is None or head[2] != 8 or head[6] or head[3] not in (0, 2, 6):
        raise ValueError("only plain 8-bit images are read")
    w, h, bands = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    try:
        raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(h, 1 + w * bands)
    except zlib.error as e:
        raise ValueError("damaged pixels") from e
    out = np.zeros((h, w * bands), np.uint8)
    before = np.zeros(w * bands, np.int64)
    for y in range(h):
        how, line = int(raw[y, 0]), raw[y, 1:].astype(np.int64)
        if how == 0:
            row = line
        elif how == 2:
            row = (line + before) & 255
        elif how == 1:
            row = line.reshape(w, bands).cumsum(0).reshape(-1) & 255
        else:
            row = np.zeros(w * bands, np.int64)
            for i in range(w * bands):
                a = row[i - bands] if i >= bands else 0
                b, c = before[i], before[i - bands] if i >= bands else 0
                if how == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((a, b, c), key=lambda v: (abs(p - v), (v != a) + (v != a and v != b)))
                row[i] = (line[i] + guess) & 255
        out[y], before = row, row
    return out.reshape((h, w) if bands == 1 else (h, w, bands))


def resize(a: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resizing; pixel centres lie at halves, and edges repeat."""
    def places(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        i = np.minimum(t.astype(int), max(n - 2, 0))
        return i, np.minimum(i + 1, n - 1), t - i

    r0, r1, fr = places(a.shape[0], h)
    c0, c1, fc = places(a.shape[1], w)
    x = a.astype(float)
    fr = fr.reshape(-1, *[1] * (a.ndim - 1))
    rows = x[r0] * (1 - fr) + x[r1] * fr
    fc = fc.reshape(1, -1, *[1] * (a.ndim - 2))
    return rows[:, c0] * (1 - fc) + rows[:, c1] * fc


def read_images(spark: SparkSession, path: str, mode: str = "RGB", pattern: str = "*.png") -> DataFrame:
    """path, h, w, bands, pixels (rows of 8-bit values), error of all images below a folder, as RGB, BGR or L (grey by the usual weights). Damaged files have an error and no pixels."""
    if mode not in ("RGB", "BGR", "L"):
        raise ValueError(f"no mode {mode}")

    def decode(batches):
        for pdf in batches:
            rows = []
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    a = png_pixels(bytes(data))
                    rgb = np.repeat(a[:, :, None], 3, 2) if a.ndim == 2 else a[:, :, :3]
                    a = rgb if mode == "RGB" else rgb[:, :, ::-1] if mode == "BGR" else ((rgb.astype(np.int64) @ np.array([19595, 38470, 7471]) + 0x8000) >> 16).astype(np.uint8)[:, :, None]
                    rows.append((name, *a.shape, np.ascontiguousarray(a).tobytes(), None))
                except ValueError as e:
                    rows.append((name, None, None, None, None, str(e)))
            out = pd.DataFrame(rows, columns=["path", "h", "w", "bands", "pixels", "error"])
            yield out.astype({c: "Int32" for c in ("h", "w", "bands")})

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(decode, "path string, h int, w int, bands int, pixels binary, error string")


def write_arrays(rows: DataFrame, folder: str) -> DataFrame:
    """Writes each row's array (name, shape, data: doubles) as an NPY file in a folder that all machines share, and returns name and path once it is there whole."""

    def write(batches):
        from pyarrow import fs as pafs

        store, base = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        for pdf in batches:
            done = []
            for name, shape, data in zip(pdf["name"], pdf["shape"], pdf["data"], strict=True):
                place = f"{base}/{name}.npy"
                other = f"{place}.{uuid.uuid4().hex}"
                with store.open_output_stream(other) as f:
                    f.write(npy_bytes(np.asarray(data, float).reshape(tuple(int(n) for n in shape))))
                store.move(other, place)
                done.append((name, place))
            yield pd.DataFrame(done, columns=["name", "path"])

    return rows.select("name", "shape", "data").mapInPandas(write, "name string, path string")
