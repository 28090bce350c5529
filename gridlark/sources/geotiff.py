"""GeoTIFF files as a Spark data source: ``spark.read.format("geotiff")``.

Option ``mode``: ``metadata`` (one row per file, header bytes only), ``tiles``
(blocks of samples, the default), ``pixels``, or ``partials`` (statistics of each block: no sample leaves the reader).  The driver only lists files;
headers and samples are read by the executors.  Small files share a partition,
large ones are cut into slices of blocks.

Options ``bands`` ("1,3"), ``rows`` and ``cols`` ("0-511") leave blocks outside
unread.  They are options and not pushed-down filters on purpose: Spark keeps the
outcome of a Python source's filter push-down with the loaded DataFrame, so two
differently filtered uses of it in one query would disturb each other.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    InputPartition,
)

from .tiff import Tiff, locate, plain

SCHEMAS = {
    "metadata": "path string, width int, height int, bands int, "
    "gt struct<gt0:double,gt1:double,gt2:double,gt3:double,gt4:double,gt5:double>, "
    "gt_text string, nodata double, crs string, block_rows int, block_cols int",
    "partials": "path string, band int, row0 int, col0 int, n long, low double, high double, mean double, square double",
    "tiles": "path string, band int, row0 int, col0 int, rows int, cols int, data array<double>",
    "pixels": "path string, band int, row int, col int, value double",
}
_GT = pa.struct([(f"gt{k}", pa.float64()) for k in range(6)])
_ARROW = {
    "metadata": pa.schema(
        [("path", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("bands", pa.int32()),
         ("gt", _GT), ("gt_text", pa.string()), ("nodata", pa.float64()), ("crs", pa.string()),
         ("block_rows", pa.int32()), ("block_cols", pa.int32())]
    ),
    "partials": pa.schema(
        [("path", pa.string()), ("band", pa.int32()), ("row0", pa.int32()), ("col0", pa.int32()), ("n", pa.int64()),
         ("low", pa.float64()), ("high", pa.float64()), ("mean", pa.float64()), ("square", pa.float64())]
    ),
    "tiles": pa.schema(
        [("path", pa.string()), ("band", pa.int32()), ("row0", pa.int32()), ("col0", pa.int32()),
         ("rows", pa.int32()), ("cols", pa.int32()), ("data", pa.list_(pa.float64()))]
    ),
    "pixels": pa.schema(
        [("path", pa.string()), ("band", pa.int32()), ("row", pa.int32()), ("col", pa.int32()),
         ("value", pa.float64())]
    ),
}
_BATCH_BYTES = 16 << 20
# --- fixed value: transforms with a smaller determinant have no inverse ---
SINGULAR = 1e-12


def _span(text: str | None) -> tuple[int, int]:
    """"10-20" -> (10, 20), both included."""
    low, _, high = (text or "").partition("-")
    return int(low or 0), int(high or (1 << 31))


@dataclass
class Slice(InputPartition):
    """Whole files, or slice ``part`` of ``parts`` of one file."""

    paths: list[str]
    part: int = 0
    parts: int = 1


def list_files(pattern: str) -> list[tuple[str, int]]:
    """(path, size) of a file, of all files under a folder, or of files that match a glob."""
    scheme = re.match(r"^[\w+.-]+://[^/]*|^file:", pattern)
    prefix = scheme.group(0) if scheme and not pattern.startswith("file:") else ""
    wild = re.search(r"[*?\[]", pattern)
    base = pattern[: pattern.rfind("/", 0, wild.start()) + 1] if wild else pattern
    system, name = locate(base or ".")
    info = system.get_file_info(name.rstrip("/") or "/")
    if info.type == fs.FileType.NotFound:
        return []
    if info.type == fs.FileType.File:
        return [(pattern, info.size)]
    found = system.get_file_info(fs.FileSelector(info.path, recursive=True))
    files = [(f.path, f.size) for f in found if f.type == fs.FileType.File]
    if wild:
        _, tail = locate(pattern)
        files = [(p, s) for p, s in files if fnmatch.fnmatchcase(p, tail)]
    else:
        files = [(p, s) for p, s in files if p.lower().endswith((".tif", ".tiff"))]
    root = prefix if prefix and not system.type_name.startswith(("s3", "gcs", "abfs")) else ""
    if prefix and not root:
        root = prefix[: prefix.index("://") + 3]
    return sorted((root + p, s) for p, s in files)


def read_files(
    paths: list[str], mode: str, part: int, parts: int, skip_errors: bool, max_pixels: int, wanted, without_nodata: bool = False
) -> Iterator[pa.RecordBatch]:
    schema = _ARROW[mode]
    for path in paths:
        try:
            tiff = Tiff(path, max_pixels)
            try:
                yield from _batches(tiff, mode, part, parts, wanted, schema, without_nodata)
            finally:
                tiff.close()
        except (OSError, ValueError):
            if not skip_errors:
                raise


def _batches(tiff: Tiff, mode: str, part: int, parts: int, wanted, schema, without_nodata: bool) -> Iterator[pa.RecordBatch]:
    if mode == "metadata":
        gt = {f"gt{k}": v for k, v in enumerate(tiff.transform)}
        text = ",".join(map(plain, tiff.transform))
        row = (tiff.path, tiff.width, tiff.height, tiff.bands, gt, text, tiff.nodata, tiff.crs)
        grid = (tiff.block_rows, tiff.block_cols)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row + grid, strict=True))], schema)
        return
    held, size = [], 0
    for b in tiff.blocks(part, parts, wanted):
        if mode == "partials":
            data = valued(b.data, tiff.nodata) if without_nodata else b.data
            if data.size:
                held.append((tiff.path, b.band, b.row, b.col, *partial(data)))
            continue
        rows, cols = b.data.shape
        if mode == "pixels":
            r, c = np.divmod(np.arange(rows * cols, dtype=np.int32), np.int32(cols))
            n = rows * cols
            columns = [
                pa.repeat(pa.scalar(tiff.path), n), pa.repeat(pa.scalar(b.band, pa.int32()), n),
                pa.array(r + np.int32(b.row)), pa.array(c + np.int32(b.col)), pa.array(b.data.ravel()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            continue
        held.append((b, rows, cols))
        size += b.data.nbytes
        if size >= _BATCH_BYTES:
            yield _tile_batch(tiff.path, held, schema)
            held, size = [], 0
    if held and mode == "partials":
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h, strict=True)) for h in held], schema)
    elif held:
        yield _tile_batch(tiff.path, held, schema)


def valued(data: np.ndarray, nodata: float) -> np.ndarray:
    """The samples that aren't the file's own NoData (NaN where the header has none, or a bad one)."""
    return data[~np.isnan(data)] if np.isnan(nodata) else data[data != nodata]


def partial(data: np.ndarray) -> tuple[int, float, float, float, float]:
    """Count, smallest and largest number, mean and squared deviation of a block; NaN counts, and spoils the last two."""
    numbers = data[~np.isnan(data)]
    low, high = (numbers.min(), numbers.max()) if numbers.size else (np.inf, -np.inf)
    with np.errstate(invalid="ignore"):
        mean = float(data.mean())
        return data.size, float(low), float(high), mean, float(np.square(data - mean).sum())


def _tile_batch(path: str, held: list, schema) -> pa.RecordBatch:
    ends = np.cumsum([0] + [b.data.size for b, _, _ in held]).astype(np.int32)
    data = pa.ListArray.from_arrays(ends, np.concatenate([b.data.ravel() for b, _, _ in held]))
    ints = [[b.band, b.row, b.col, r, c] for b, r, c in held]
    columns = [pa.array(v, pa.int32()) for v in zip(*ints, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), *columns, data], schema=schema)


class GeoTiffReader(DataSourceReader):
    def __init__(self, options):
        self.mode = options.get("mode", "tiles")
        if self.mode not in SCHEMAS:
            raise ValueError(f"mode must be one of {', '.join(SCHEMAS)}")
        if options.get("onerror", "fail") not in ("fail", "skip"):
            raise ValueError("onError must be fail or skip")
        self.skip_errors = options.get("onerror", "fail") == "skip"
        self.without_nodata = options.get("ignorenodata", "false") == "true"
        if self.without_nodata and self.mode != "partials":
            raise ValueError("ignoreNodata is for mode partials")
        self.max_pixels = int(options.get("maxtilepixels", 1 << 18))
        self.partition_bytes = int(options.get("partitionbytes", 64 << 20))
        self.partition_files = int(options.get("partitionfiles", 1000))
        paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.patterns = [p for p in paths if p]
        self.only_bands = {int(b) for b in options["bands"].split(",")} if options.get("bands") else None
        self.rows, self.cols = (_span(options.get(n)) for n in ("rows", "cols"))

    def _files(self) -> list[tuple[str, int]]:
        files = []
        for p in self.patterns:
            found = list_files(p)
            if not found and not self.skip_errors:
                raise FileNotFoundError(f"Cannot open: {p}")
            files += found
        return files

    def partitions(self) -> list[Slice]:
        slices, group, size = [], [], 0
        for path, length in self._files():
            if self.mode != "metadata" and length > self.partition_bytes:
                parts = -(-length // self.partition_bytes)
                slices += [Slice([path], k, parts) for k in range(parts)]
                continue
            read = min(length, 1 << 16) if self.mode == "metadata" else length
            if group and (size + read > self.partition_bytes or len(group) >= self.partition_files):
                slices.append(Slice(group))
                group, size = [], 0
            group.append(path)
            size += read
        return slices + [Slice(group)] if group or not slices else slices

    def _wanted(self, band, row, rows, col, cols) -> bool:
        (r0, r1), (c0, c1) = self.rows, self.cols
        fits = row <= r1 and row + rows > r0 and col <= c1 and col + cols > c0
        return fits and (self.only_bands is None or band in self.only_bands)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_files(
            partition.paths, self.mode, partition.part, partition.parts, self.skip_errors, self.max_pixels, self._wanted,
            self.without_nodata,
        )


class GeoTiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("mode", "tiles")]

    def reader(self, schema) -> GeoTiffReader:
        return GeoTiffReader(self.options)


def read_geotiff(spark: SparkSession, path: str | list[str], mode: str = "tiles", **options) -> DataFrame:
    """The data source, registered and loaded; ``options`` as ``bands="1"``, ``onError="skip"``,
    ``ignoreNodata="true"`` (mode ``partials``: the file's own NoData is left out)."""
    spark.dataSource.register(GeoTiff)
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.format("geotiff").option("mode", mode).option("paths", json.dumps(paths))
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


# What gives no value: an absent file, and one that is no raster.  Other errors of a store fail the task, which Spark repeats.
_MISSING = (FileNotFoundError, ValueError)


def with_values(
    requests: DataFrame, path: str, band: str, row: str, col: str, out: str, clamp: bool = True, world: bool = False
) -> DataFrame:
    """Requests with the sample of their file under ``out``: NaN off the raster or without a readable file.

    Requests meet by file and region; a task opens each of its files once and reads only the blocks that its requests
    need.  No sample is shuffled, and a file with very many requests is split as adaptive execution sees fit.
    ``clamp``: bands go to those there are, negative positions to 0.  ``world``: ``row`` and ``col`` are y and x.
    """
    own = [f.name for f in requests.schema.fields if f.name != out]
    region = (f"coalesce(CAST(`{c}` AS BIGINT), 0) DIV 512" for c in (row, col))
    keyed = requests.selectExpr(
        *(f"`{c}`" for c in own), f"`{path}` AS _path", f"CAST(`{band}` AS BIGINT) AS _band",
        f"CAST(`{row}` AS DOUBLE) AS _row", f"CAST(`{col}` AS DOUBLE) AS _col", *(f"{r} AS _r{k}" for k, r in enumerate(region)),
    )
    keys = ["_path", "_r0", "_r1"]
    met = keyed.hint("rebalance", *keys).sortWithinPartitions(*keys).drop("_r0", "_r1")
    shape = requests.select(*(f"`{c}`" for c in own)).schema.add(out, "double")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, tiff = None, None
        for batch in batches:
            paths = batch.column("_path").to_pylist()
            numbers = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("_band", "_row", "_col")]
            known = ~np.isnan(numbers).any(axis=0) & np.array([p is not None for p in paths], bool)
            values = np.full(len(paths), np.nan)
            edges = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            for a, b in zip(edges, edges[1:]):
                if a == b or paths[a] is None:
                    continue
                if paths[a] != name:
                    if tiff is not None:
                        tiff.close()
                    name = paths[a]
                    try:
                        tiff = Tiff(name)
                    except _MISSING:
                        tiff = None
                if tiff is not None:
                    at = a + np.flatnonzero(known[a:b])
                    values[at] = _sampled(tiff, *(x[at] for x in numbers), clamp, world)
            columns = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, mask=~known)], names=[*own, out])
        if tiff is not None:
            tiff.close()

    return met.mapInArrow(read, shape)


def _sampled(tiff: Tiff, band: np.ndarray, row: np.ndarray, col: np.ndarray, clamp: bool, world: bool) -> np.ndarray:
    if world:
        g0, g1, g2, g3, g4, g5 = tiff.transform
        whole = g1 * g5 - g2 * g4
        if abs(whole) < SINGULAR:
            return np.full(len(row), np.nan)
        x, y = col - g0, row - g3
        col, row = np.floor((g5 * x - g2 * y) / whole), np.floor((g1 * y - g4 * x) / whole)
    band = np.clip(band, 1, tiff.bands)
    if clamp:
        row, col = np.maximum(row, 0), np.maximum(col, 0)
    out = np.full(len(row), np.nan)
    on = np.flatnonzero((row >= 0) & (col >= 0) & (row < tiff.height) & (col < tiff.width))
    if len(on):
        out[on] = tiff.values_at(*(v[on].astype(np.int64) for v in (band - 1, row, col)))
    return out


@F.arrow_udf(T.DoubleType())
def value_at(path: pa.Array, band: pa.Array, col: pa.Array, row: pa.Array) -> pa.Array:
    """One sample per row; each file of a batch is opened once, and only the blocks asked for are read."""
    numbers = [pc.cast(x, pa.float64()).to_numpy(zero_copy_only=False) for x in (band, row, col)]
    known = ~np.isnan(numbers).any(axis=0) & path.is_valid().to_numpy(zero_copy_only=False)
    names = path.dictionary_encode()
    place = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    values = np.full(len(path), np.nan)
    for k, name in enumerate(names.dictionary.to_pylist()):
        at = np.flatnonzero(known & (place == k))
        try:
            tiff = Tiff(name)
        except _MISSING:
            continue
        values[at] = _sampled(tiff, *(x[at] for x in numbers), True, False)
        tiff.close()
    return pa.array(values, mask=~known)


SLICE_BYTES = 64 << 20


def sliced(files: DataFrame, path: str, skip_errors: bool = True, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows of ``files`` for each slice of their file (``_part`` of ``_parts``), dealt anew, so tasks share large files.

    Executors look at the sizes; absent files have no slice, or are an error.
    """

    @F.arrow_udf(T.IntegerType())
    def parts(paths: pa.Array) -> pa.Array:
        out = []
        for name in paths.to_pylist():
            system, place = locate(name) if name is not None else (None, None)
            info = system.get_file_info(place) if system else None
            found = info is not None and info.type == fs.FileType.File
            if not found and not skip_errors and name is not None:
                raise FileNotFoundError(f"Cannot open: {name}")
            out.append(max(1, -(-info.size // slice_bytes)) if found else 0)
        return pa.array(out, pa.int32())

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = files.withColumn("_parts", parts(path)).where("_parts > 0")
    return known.withColumn("_part", F.explode(F.expr("sequence(0, _parts - 1)"))).repartition(tasks, path, "_part")


def scan_geotiff(files: DataFrame, path: str, mode: str = "tiles", skip_errors: bool = True, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The same rows for a table of file paths, which never pass through the driver; several tasks read a large file."""

    def read(batches):
        for batch in batches:
            for name, part, parts in zip(*(c.to_pylist() for c in batch.columns)):
                yield from read_files([name], mode, part, parts, skip_errors, 1 << 18, lambda *_: True)

    whole = 1 << 62 if mode == "metadata" else slice_bytes
    return sliced(files.select(path), path, skip_errors, whole).select(path, "_part", "_parts").mapInArrow(read, SCHEMAS[mode])


def bins_of(data: np.ndarray, low: float, width: float, bins: int) -> np.ndarray:
    """Samples per bin: half-open, all of a raster of width 0 (or of NaN) in the first, as NaN samples are."""
    if not width > 0:
        return np.bincount([0], [data.size], bins).astype(np.int64)
    place = (data.ravel() - low) / width
    place = np.floor(np.where(np.isnan(place), 0, place))
    return np.bincount(place[(place >= 0) & (place < bins)].astype(np.int64), minlength=bins)


def scan_histograms(bounds: DataFrame, bins: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``path, band, counts`` for each slice of the files in ``bounds`` (path, band, low, width): samples per bin.

    Bounds go to the reader; no sample leaves it.
    """
    files = bounds.groupBy("path").agg(F.collect_list(F.struct("band", "low", "width")).alias("_bands"))  # a file's bands

    def read(batches):
        for batch in batches:
            for name, bands, part, parts in zip(*(c.to_pylist() for c in batch.columns)):
                wanted = {b["band"]: (b["low"], b["width"]) for b in bands}
                counts = {b: np.zeros(bins, np.int64) for b in wanted}
                tiff = Tiff(name)
                try:
                    for block in tiff.blocks(part, parts, lambda band, *_: band in wanted):
                        counts[block.band] += bins_of(block.data, *wanted[block.band], bins)
                finally:
                    tiff.close()
                rows = [{"path": name, "band": b, "counts": n.tolist()} for b, n in counts.items()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("band", pa.int32()), ("counts", pa.list_(pa.int64()))]))

    slices = sliced(files, "path", False, slice_bytes).select("path", "_bands", "_part", "_parts")
    return slices.mapInArrow(read, "path string, band int, counts array<long>")
