"""Statistics and histograms of the one file that a SQL call names.

A call reads the header and the blocks of its band from that file and no other, one block at a time, so memory does not
grow with the raster.  Calls over a column are spread as Spark spreads the rows; the file and band of the call before
are kept, so sort requests by path to read a file once.  A file is read by one task: for files too large for that, and
for all bands of many files, the ``partials`` mode of the data source and ``block_histogram`` cut files into slices.

Bands go to those there are.  The table functions raise an error for an absent file or one that is no raster, and give
no rows for a null path; a null band is the first, null bins are the fewest, 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geotiff import _MISSING, bins_of, partial
from .tiff import Tiff

METADATA = "path string, width int, height int, bands int, crs string"
STATS = "min double, max double, mean double, stddev double, count bigint"
HISTOGRAM = "value double, count bigint"
LEAST_BINS = 2
NUMBERS = ("min", "max", "mean", "stddev")


class Band:
    """One band of an open file; statistics are computed once."""

    def __init__(self, tiff: Tiff, number: int | None):
        self.tiff = tiff
        self.number = min(max(number or 1, 1), tiff.bands)
        self._stats = None

    def blocks(self) -> Iterator[np.ndarray]:
        return (b.data for b in self.tiff.blocks(wanted=lambda band, *_: band == self.number))

    def stats(self) -> tuple[float, float, float, float, int]:
        """Smallest and largest number, mean, population standard deviation, samples (NaN among them)."""
        if self._stats is None:
            n, low, high, mean, square = 0, np.inf, -np.inf, 0.0, 0.0
            for data in self.blocks():
                if not data.size:
                    continue
                more, least, most, center, spread = partial(data)
                far, n = center - mean, n + more
                mean += far * more / n
                square += spread + far * far * more * (n - more) / n
                low, high = min(low, least), max(high, most)
            self._stats = (low, high, float(mean), float(np.sqrt(square / n)), n) if n else (0.0, 0.0, 0.0, 0.0, 0)
        return self._stats

    def histogram(self, bins: int | None) -> Iterator[tuple[float, int]]:
        """Center and samples of each bin, in order."""
        bins = max(bins or LEAST_BINS, LEAST_BINS)
        low, high, *_ = self.stats()
        with np.errstate(invalid="ignore"):
            width = float((np.float64(high) - low) / bins)
            centers = low + (np.arange(bins) + 0.5) * width
        counts = np.zeros(bins, np.int64)
        for data in self.blocks():
            counts += bins_of(data, low, width, bins)
        return zip(centers.tolist(), counts.tolist())


class _Files:
    """Holds the file and the band that were asked for last."""

    def __init__(self):
        self._path = self._tiff = self._band = None

    def tiff(self, path: str) -> Tiff:
        if path != self._path:
            self.terminate()
            self._tiff = Tiff(path)
            self._path = path
        return self._tiff

    def band(self, path: str, number: int | None) -> Band:
        found = Band(self.tiff(path), number)
        if self._band is None or self._band.number != found.number:
            self._band = found
        return self._band

    def terminate(self) -> None:
        if self._tiff is not None:
            self._tiff.close()
        self._path = self._tiff = self._band = None


@F.udtf(returnType=METADATA)
class RasterMetadata(_Files):
    def eval(self, path: str):
        if path is not None:
            tiff = self.tiff(path)
            yield path, tiff.width, tiff.height, tiff.bands, tiff.crs


@F.udtf(returnType=STATS)
class RasterStats(_Files):
    def eval(self, path: str, band: int):
        if path is not None:
            yield self.band(path, band).stats()


@F.udtf(returnType=HISTOGRAM)
class RasterHistogram(_Files):
    def eval(self, path: str, band: int, bins: int):
        if path is not None:
            yield from self.band(path, band).histogram(bins)


@F.arrow_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in NUMBERS]))
def first_band_stats(path: pa.Array) -> pa.Array:
    """Statistics of the first band of each file, each different file of a batch read once; null where there is none."""
    names = path.dictionary_encode()
    found = []
    for name in names.dictionary.to_pylist():
        try:
            tiff = Tiff(name)
        except _MISSING:
            found.append(None)
            continue
        try:
            found.append(dict(zip(NUMBERS, Band(tiff, 1).stats())))
        finally:
            tiff.close()
    return pa.array(found, pa.struct([(name, pa.float64()) for name in NUMBERS])).take(names.indices)
