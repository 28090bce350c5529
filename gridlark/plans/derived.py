"""Spatial inputs derived from the given tables: points, fences and raster files.

The tables hold no coordinates, so ids are turned into positions.  Offsets keep
positions off cell and face borders.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
from pyarrow.fs import LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from ..sources.tiff import locate

# Vectors per derived raster; each vector is one row of 64 pixels.
ROWS_PER_RASTER = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        *more,
        "event_id AS id",
        "CAST((event_id * 7919) % 16800 AS DOUBLE) / 100D - 84D + 0.00317D AS lat",
        "CAST((event_id * 104729) % 35900 AS DOUBLE) / 100D - 179.5D + 0.00713D AS lon",
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS place",
        "CAST((c_custkey * 6481) % 16700 AS DOUBLE) / 100D - 83D + 0.00271D AS lat",
        "CAST((c_custkey * 92821) % 35800 AS DOUBLE) / 100D - 179D + 0.00519D AS lon",
    )


def fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rectangle of 4 by 3 degrees per supplier, as WKT."""
    corners = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS fence",
        "(s_suppkey * 53) % 300 - 150 AS x0",
        "(s_suppkey * 37) % 140 - 70 AS y0",
    ).selectExpr("*", "x0 + 4 AS x1", "y0 + 3 AS y1")
    ring = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    text = ", ', ', ".join(f"{x}, '.0177 ', {y}, '.0131'" for x, y in ring)
    return corners.selectExpr("fence", f"concat('POLYGON((', {text}, '))') AS wkt")


def _packed_bits(data: bytes) -> bytes:
    """PackBits with literal runs only."""
    return b"".join(bytes([len(data[k : k + 128]) - 1]) + data[k : k + 128] for k in range(0, len(data), 128))


def _geotiff(data: np.ndarray, tie: tuple, scale: tuple, epsg: int, nodata: str | None, layout: int, metadata: str | None = None) -> bytes:
    """A GeoTIFF of data (rows, cols, bands); the layout number picks how samples are stored, not their values."""
    rows, cols, bands = data.shape
    order = ">" if layout % 5 == 2 else "<"
    size = 8 if layout % 3 == 1 else 4
    tiled, planar = layout % 2 == 1, layout % 4 == 3
    compression = (1, 8, 32773, 8)[layout % 4]
    predictor = 3 if compression == 8 and layout % 8 >= 4 else 1
    high, wide = (16, 32) if tiled else (rows if layout % 3 == 0 else 9, cols)
    whole = np.zeros((-(-rows // high) * high, -(-cols // wide) * wide, bands), f"{order}f{size}")
    whole[:rows, :cols] = data
    blocks = []
    for planes in [whole[..., b : b + 1] for b in range(bands)] if planar else [whole]:
        for r in range(0, whole.shape[0], high):
            for c in range(0, whole.shape[1], wide):
                block = planes[r : r + high if tiled else min(r + high, rows), c : c + wide]
                if predictor == 3:  # a row's bytes, most significant first, as differences
                    wide_bytes = block.astype(f">f{size}").view(np.uint8).reshape(len(block), -1, size)
                    moved = wide_bytes.transpose(0, 2, 1).reshape(len(block), -1, block.shape[2])
                    raw = np.diff(moved, axis=1, prepend=np.zeros_like(moved[:, :1])).tobytes()
                else:
                    raw = block.tobytes()
                blocks.append({1: bytes, 8: zlib.compress, 32773: _packed_bits}[compression](raw))
    places = np.cumsum([8, *map(len, blocks)])[:-1]

    def shorts(*values: int) -> tuple[int, int, bytes]:
        return 3, len(values), struct.pack(f"{order}{len(values)}H", *values)

    def longs(values) -> tuple[int, int, bytes]:
        return 4, len(values), struct.pack(f"{order}{len(values)}I", *values)

    def doubles(*values: float) -> tuple[int, int, bytes]:
        return 12, len(values), struct.pack(f"{order}{len(values)}d", *values)

    tags = {
        256: shorts(cols), 257: shorts(rows), 258: shorts(*[8 * size] * bands), 259: shorts(compression), 262: shorts(1),
        277: shorts(bands), 284: shorts(2 if planar else 1), 317: shorts(predictor), 339: shorts(*[3] * bands),
        33550: doubles(*scale, 0.0), 33922: doubles(0, 0, 0, *tie, 0.0),
        34735: shorts(1, 1, 0, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg),
    }
    sizes = longs([len(x) for x in blocks])
    tags |= {322: shorts(wide), 323: shorts(high), 324: longs(places), 325: sizes} if tiled else {273: longs(places), 278: shorts(high), 279: sizes}
    if nodata is not None:
        tags[42113] = (2, len(nodata) + 1, nodata.encode() + b"\0")
    if metadata is not None:
        tags[42112] = (2, len(metadata) + 1, metadata.encode() + b"\0")
    body = b"".join(blocks)
    body += b"\0" * (len(body) % 2)
    at = 8 + len(body)
    directory, extra = struct.pack(f"{order}H", len(tags)), b""
    beyond = at + 2 + 12 * len(tags) + 4
    for tag, (kind, count, value) in sorted(tags.items()):
        place = value.ljust(4, b"\0")
        if len(value) > 4:
            place = struct.pack(f"{order}I", beyond + len(extra))
            extra += value + b"\0" * (len(value) % 2)
        directory += struct.pack(f"{order}HHI", tag, kind, count) + place
    head = struct.pack(f"{order}2sHI", b"II" if order == "<" else b"MM", 42, at)
    return head + body + directory + struct.pack(f"{order}I", 0) + extra


_written: dict[tuple[str, str, bool], str] = {}


def rasters(spark: SparkSession, sf_dir: str, own_nodata: bool = False) -> str:
    """Folder of GeoTIFF files written from ``embeddings`` by a Spark job.

    Raster n holds vectors 64n .. 64n+63: band 1 the vector, band 2 its label plus column modulo 5.  Files differ in
    byte order, sample size, strips and tiles, planes, compression and predictor.  A folder is written once per
    application; reading it again costs no write.  ``own_nodata``: 4 is the NoData of raster n, in a tag of its own
    (n % 3 = 0) or a line of the metadata (n % 3 = 1).
    """
    key = (spark.sparkContext.applicationId, sf_dir, own_nodata)
    if key in _written:
        return _written[key]
    folder = scratch_folder(spark)
    system, name = locate(folder)
    folder = name if isinstance(system, LocalFileSystem) else folder  # as the source lists it

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        n = int(pdf["n"].iloc[0])
        first = np.stack(pdf["embedding"].to_list()).astype(np.float32)
        second = pdf["label"].to_numpy()[:, None] + np.arange(first.shape[1])[None, :] % 5
        data = np.stack([first, second.astype(np.float32)], axis=-1)
        even = n % 2 == 0
        content = _geotiff(
            data,
            (10.0 * n + 0.5, 60.0 - n),
            (0.25, 0.5 + n % 3),
            4326 if even else 32600 + n % 60,
            ("4" if n % 3 == 0 else None) if own_nodata else "-9999" if even else None,
            n,
            "<AREA=Point>\nNODATA = 4\n" if own_nodata and n % 3 == 1 else None,
        )
        system, name = locate(folder)
        system.create_dir(name, recursive=True)
        # under its own name only when whole: a task may run again, or be cut off
        with system.open_output_stream(part := f"{name}/r{n}.{uuid.uuid4().hex}") as out:
            out.write(content)
        system.move(part, f"{name}/r{n}.tif")
        return pd.DataFrame({"n": [n]})

    # vec_id is a key, so a group is at most ROWS_PER_RASTER rows
    vectors = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "embedding", "label", f"vec_id DIV {ROWS_PER_RASTER} AS n")
    vectors.groupBy("n").applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()
    _written[key] = folder
    return folder


def file_name(path: str = "path") -> str:
    return f"substring_index({path}, '/', -1)"


def pixel_requests(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """One look-up per event: some off the raster, some of files that are not there."""
    vectors = table(spark, sf_dir, "embeddings")
    last = vectors.agg((F.max("vec_id") / ROWS_PER_RASTER).cast("bigint")).first()[0]
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        f"concat('{folder}/r', event_id % {last + 2}, '.tif') AS path",
        "CAST(event_id % 4 AS INT) AS band",
        "CAST((event_id * 13) % 70 - 3 AS INT) AS col",
        "CAST((event_id * 7) % 70 - 3 AS INT) AS row",
    )
