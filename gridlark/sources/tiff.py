"""Reading one GeoTIFF piecewise: header tags, and blocks of samples as numpy arrays."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs

# --- fixed values: the TIFF and GeoTIFF tags, field types and defaults -----------
WIDTH, HEIGHT, BITS, COMPRESSION, SAMPLES, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 277, 284, 317, 339
STRIP_OFFSETS, ROWS_PER_STRIP, STRIP_BYTES = 273, 278, 279
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
PIXEL_SCALE, TIEPOINT, GEO_KEYS, METADATA_TEXT, NODATA_TEXT = 33550, 33922, 34735, 42112, 42113
CRS_KEYS = (3072, 2048)
NO_CRS = "See GeoTIFF tags"
FIELD_TYPES = {
    1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "s", 8: "h",
    9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q",
}
SAMPLE_KINDS = {1: "u", 2: "i", 3: "f"}
RAW, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
# ------------------------------------------------------------------------------------
_HEAD = 1 << 16
_LAZY = {STRIP_OFFSETS, STRIP_BYTES, TILE_OFFSETS, TILE_BYTES}
_FLOAT = re.compile(r"[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|infinity|nan)", re.I)


class TiffError(ValueError):
    pass


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def parse_float(text: str) -> float:
    return float(text) if _FLOAT.fullmatch(text) else math.nan


def plain(x: float) -> str:
    """Shortest decimal digits, no exponent, no trailing point."""
    return "NaN" if math.isnan(x) else np.format_float_positional(x, trim="-")


@dataclass
class Block:
    """Samples of one band: an array (rows, cols) whose top left pixel is (row, col)."""

    band: int
    row: int
    col: int
    data: np.ndarray


class Entries:
    """The values of a tag by number, read a page at a time: tables of offsets grow with the file."""

    PAGE = 1024

    def __init__(self, tiff: Tiff, tag: int):
        self._tiff = tiff
        self._kind, self._count, self._at = tiff.tags[tag]
        self._page, self._values = -1, ()

    def __getitem__(self, k: int) -> int:
        page, place = divmod(k, self.PAGE)
        if not 0 <= k < self._count:
            raise TiffError(f"{self._tiff.path}: no block {k}")
        if page != self._page:
            form = FIELD_TYPES[self._kind]
            first = page * self.PAGE
            n = min(self.PAGE, self._count - first)
            self._values = self._tiff._unpack(form * n, self._at + first * struct.calcsize("=" + form))
            self._page = page
        return self._values[place]


class Tiff:
    """An open file.  ``max_pixels`` bounds the blocks handed out."""

    def __init__(self, path: str, max_pixels: int = 1 << 18):
        self.path, self.max_pixels = path, max_pixels
        system, name = locate(path)
        self._file = system.open_input_file(name)
        self._head = self._file.read_at(_HEAD, 0)
        mark = self._head[:2]
        if mark not in (b"II", b"MM") or len(self._head) < 8:
            raise TiffError(f"{path}: not a TIFF file")
        self._order = "<" if mark == b"II" else ">"
        (version,) = self._unpack("H", 2)
        if version not in (42, 43):
            raise TiffError(f"{path}: not a TIFF file")
        self._big = version == 43
        self.tags = self._read_directory()
        self._describe()

    def close(self) -> None:
        self._file.close()

    # -- bytes ---------------------------------------------------------------------
    def _bytes(self, at: int, size: int) -> bytes:
        if at + size <= len(self._head):
            return self._head[at : at + size]
        got = self._file.read_at(size, at)
        if len(got) < size:
            raise TiffError(f"{self.path}: file ends early")
        return got

    def _unpack(self, form: str, at: int) -> tuple:
        return struct.unpack(self._order + form, self._bytes(at, struct.calcsize("=" + form)))

    def _read_directory(self) -> dict[int, tuple[int, int, int]]:
        """Tag -> (field type, count, place of the values)."""
        word, entry, inline = ("Q", 20, 8) if self._big else ("I", 12, 4)
        (at,) = self._unpack(word, 8 if self._big else 4)
        (entries,) = self._unpack("Q" if self._big else "H", at)
        at += 8 if self._big else 2
        tags = {}
        for place in range(at, at + entries * entry, entry):
            tag, kind = self._unpack("HH", place)
            (count,) = self._unpack(word, place + 4)
            if kind not in FIELD_TYPES:
                continue
            size = struct.calcsize("=" + FIELD_TYPES[kind]) * count
            values = place + entry - inline
            tags[tag] = (kind, count, values if size <= inline else self._unpack(word, values)[0])
        return tags

    def values(self, tag: int) -> list | None:
        if tag not in self.tags:
            return None
        kind, count, at = self.tags[tag]
        form = FIELD_TYPES[kind]
        if form == "s":
            return [self._bytes(at, count)]
        size = struct.calcsize("=" + form) * count
        return list(struct.unpack(self._order + form * count, self._bytes(at, size)))

    def _one(self, tag: int, default: int) -> int:
        found = self.values(tag)
        return int(found[0]) if found else default

    def _text(self, tag: int) -> str | None:
        found = self.values(tag)
        if not found or not isinstance(found[0], bytes):
            return None
        return found[0].split(b"\0", 1)[0].decode("utf-8", "replace")

    # -- header ----------------------------------------------------------------------
    def _describe(self) -> None:
        if WIDTH not in self.tags or HEIGHT not in self.tags:
            raise TiffError(f"{self.path}: no image size")
        self.width, self.height = self._one(WIDTH, 0), self._one(HEIGHT, 0)
        self.bands = self._one(SAMPLES, 1)
        tie = self.values(TIEPOINT) or [0.0] * 6
        scale = self.values(PIXEL_SCALE) or [1.0, 1.0, 0.0]
        tie = [*map(float, tie), *([0.0] * 6)][:6] if len(tie) < 6 else tie
        scale = [*scale, *([1.0] * (2 - len(scale)))]
        self.transform = (float(tie[3]), float(scale[0]), 0.0, float(tie[4]), 0.0, -float(scale[1]))
        self.nodata = self._nodata()
        self.crs = self._crs()
        self.tiled = TILE_OFFSETS in self.tags
        self.compression = self._one(COMPRESSION, RAW)
        self.planar = self._one(PLANAR, 1) == 2 and self.bands > 1
        if self.tiled:
            self._block = (self._one(TILE_HEIGHT, 0), self._one(TILE_WIDTH, 0))
        else:
            self._block = (min(self._one(ROWS_PER_STRIP, self.height), self.height), self.width)
        rows, cols = self._block
        # small strips are handed out together, large raw ones in pieces
        self._group = 1 if self.tiled else max(1, self.max_pixels // max(rows * cols, 1))
        self.block_cols = cols
        self._step_rows = rows * self._group
        self._chunk_rows = max(1, min(self._step_rows, self.max_pixels // max(cols, 1)))

    @property
    def block_rows(self) -> int:
        """Rows of the file's own blocks (strips or tiles), whatever pieces are handed out."""
        return self._block[0]

    def _nodata(self) -> float:
        stated = self._text(NODATA_TEXT)
        if stated is not None:
            return parse_float(stated)
        for line in (self._text(METADATA_TEXT) or "").splitlines():
            if ("NODATA" in line or "NoData" in line) and line.count("="):
                value = parse_float(line.split("=")[1].strip())
                if not math.isnan(value):
                    return value
        return math.nan

    def _crs(self) -> str:
        keys = self.values(GEO_KEYS) or []
        entries = [keys[k : k + 4] for k in range(4, len(keys) - 3, 4)]
        for key, _, _, value in entries[: keys[3] if len(keys) >= 4 else 0]:
            if key in CRS_KEYS:
                return f"EPSG:{value}"
        return NO_CRS

    # -- samples ---------------------------------------------------------------------
    def dtype(self) -> np.dtype:
        bits = set(self.values(BITS) or [1])
        kinds = set(self.values(FORMAT) or [1])
        if len(bits) == 1 and len(kinds) == 1:
            kind, size = SAMPLE_KINDS.get(kinds.pop()), bits.pop()
            if kind and size in ((32, 64) if kind == "f" else (8, 16, 32, 64)):
                return np.dtype(f"{self._order}{kind}{size // 8}")
        raise TiffError(f"{self.path}: Unsupported pixel type")

    def _unit(self, k: int) -> tuple[int, int, int, int]:
        """Piece ``k`` to read independently: (first row, rows, block column, plane)."""
        step, across = self._unit_step(), -(-self.width // self.block_cols)
        k, c = divmod(k, across)
        plane, k = divmod(k, self._unit_rows())
        group, piece = divmod(k, -(-self._step_rows // step))
        row = group * self._step_rows + piece * step
        return row, min(step, (group + 1) * self._step_rows - row, self.height - row), c, plane

    def _unit_step(self) -> int:
        return self._chunk_rows if self.compression == RAW else self._step_rows

    def _unit_rows(self) -> int:
        whole, rest = divmod(self.height, self._step_rows)
        return whole * -(-self._step_rows // self._unit_step()) + -(-rest // self._unit_step())

    def _unit_count(self) -> int:
        return self._unit_rows() * -(-self.width // self.block_cols) * (self.bands if self.planar else 1)

    def _open_samples(self) -> tuple[Entries, Entries, np.dtype, int]:
        if self.compression not in (RAW, LZW, DEFLATE, OLD_DEFLATE, PACKBITS):
            raise TiffError(f"{self.path}: compression {self.compression} is not supported")
        kind, predictor = self.dtype(), self._one(PREDICTOR, 1)
        if predictor not in (1, 2, 3) or predictor == 3 and kind.kind != "f":
            raise TiffError(f"{self.path}: predictor {predictor} is not supported")
        offsets = Entries(self, TILE_OFFSETS if self.tiled else STRIP_OFFSETS)
        return offsets, Entries(self, TILE_BYTES if self.tiled else STRIP_BYTES), kind, predictor

    def blocks(self, part: int = 0, parts: int = 1, wanted=lambda band, row, rows, col, cols: True) -> Iterator[Block]:
        """Blocks of slice ``part`` of ``parts``; ``wanted`` may refuse some unread."""
        opened = self._open_samples()
        low, high = (self._unit_count() * k // parts for k in (part, part + 1))
        for k in range(low, high):
            row, rows, c, plane = self._unit(k)
            col = c * self.block_cols
            cols = min(self.block_cols, self.width - col)
            bands = [plane] if self.planar else range(self.bands)
            bands = [b for b in bands if wanted(b + 1, row, rows, col, cols)]
            if not bands:
                continue
            samples = self._samples(row, rows, c, plane, *opened)
            for b in bands:
                values = samples[:, :cols, 0 if self.planar else b].astype(np.float64)
                for top in range(0, rows, self._chunk_rows):
                    yield Block(b + 1, row + top, col, values[top : top + self._chunk_rows])

    def values_at(self, band: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Samples at positions within the file (bands from 0); each block they need is read once."""
        opened = self._open_samples()
        # raw blocks are read by rows
        high = self._block[0] if self.compression != RAW else min(self._block[0], max(1, (1 << 14) // self.block_cols))
        top = row // self._block[0] * self._block[0]
        top = top + (row - top) // high * high
        plane = band if self.planar else np.zeros_like(band)
        c = col // self.block_cols
        out = np.empty(len(row), np.float64)
        order = np.lexsort((c, top, plane))
        edge = np.flatnonzero(np.diff(top[order]) | np.diff(c[order]) | np.diff(plane[order])) + 1
        for some in np.split(order, edge) if len(order) else []:
            t, block_col, p = int(top[some[0]]), int(c[some[0]]), int(plane[some[0]])
            end = min(t + high, t // self._block[0] * self._block[0] + self._block[0], self.height)
            samples = self._samples(t, end - t, block_col, p, *opened)
            inner = np.zeros(len(some), int) if self.planar else band[some]
            out[some] = samples[row[some] - t, col[some] - block_col * self.block_cols, inner]
        return out

    def _samples(self, row, rows, c, plane, offsets, sizes, kind, predictor) -> np.ndarray:
        block_rows, block_cols = self._block
        across = -(-self.width // block_cols)
        down = -(-self.height // block_rows)
        per_pixel = 1 if self.planar else self.bands
        line = block_cols * per_pixel * kind.itemsize
        pieces = []
        at, end = row, row + rows
        while at < end:
            first = at // block_rows * block_rows
            height = block_rows if self.tiled else min(block_rows, self.height - first)
            index = plane * across * down + first // block_rows * across + c
            take = min(end, first + height) - at
            if self.compression == RAW:
                data = self._bytes(offsets[index] + (at - first) * line, take * line)
            else:
                whole = decompress(self._bytes(offsets[index], sizes[index]), self.compression, height * line)
                data = whole[(at - first) * line : (at - first + take) * line]
            if len(data) < take * line:
                raise TiffError(f"{self.path}: block {index} is too short")
            if predictor == 3:
                data = whole_numbers(data, take, block_cols, per_pixel, kind.itemsize)
                pieces.append(data.astype(kind))
            else:
                pieces.append(np.frombuffer(data, kind).reshape(take, block_cols, per_pixel))
            at += take
        samples = np.concatenate(pieces) if len(pieces) > 1 else pieces[0]
        if predictor == 2:
            samples = np.cumsum(samples, axis=1, dtype=kind.newbyteorder("="))
        return samples


def decompress(data: bytes, compression: int, size: int) -> bytes:
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    return unpack_bits(data, size) if compression == PACKBITS else unpack_lzw(data, size)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < size:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        elif n > 128:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def whole_numbers(data: bytes, rows: int, cols: int, per_pixel: int, size: int) -> np.ndarray:
    """Undoes the floating point predictor: bytes are differences, most significant bytes of a row first."""
    steps = np.frombuffer(data, np.uint8).reshape(rows, -1, per_pixel)
    planes = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(rows, size, cols * per_pixel)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, cols, per_pixel)


def unpack_lzw(data: bytes, size: int) -> bytes:
    """Codes of one width are cut out together; the table grows by one text per code."""
    clear, stop, most = 256, 257, 4096
    bits = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.int64)
    start = [bytes([k]) for k in range(256)] + [b"", b""]
    table, out, at, last = list(start), [], 0, None
    done, end = 0, len(data) * 8
    while done < size:
        # the code width grows one entry early; a code after the first adds an entry
        width = min(12, max(9, (len(table) + 1).bit_length()))
        room = (1 << width) - 1 - len(table) if width < 12 else most
        n = min(max(room + (last is None), 1), (end - at) // width)
        if n <= 0:
            break
        place = at + width * np.arange(n)
        byte = place >> 3
        codes = (bits[byte] << 16 | bits[byte + 1] << 8 | bits[byte + 2]) >> (24 - width - (place & 7)) & (1 << width) - 1
        marks = np.flatnonzero((codes == clear) | (codes == stop))
        used = int(marks[0]) if len(marks) else n
        for code in codes[:used].tolist():
            text = table[code] if code < len(table) else last + last[:1]
            out.append(text)
            done += len(text)
            if last is not None:
                table.append(last + text[:1])
            last = text
        at += width * (used + (used < n))
        if used < n:
            if codes[used] == stop:
                break
            table, last = list(start), None
    return b"".join(out)
