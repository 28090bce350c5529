"""Writes small GeoTIFF files of many layouts for the tests."""

import struct
import zlib

import numpy as np

KINDS = {"u": 1, "i": 2, "f": 3}


def pack_bits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        run = 1
        while at + run < len(data) and run < 128 and data[at + run] == data[at]:
            run += 1
        if run > 1:
            out += bytes([257 - run, data[at]])
            at += run
        else:
            out += bytes([0, data[at]])
            at += 1
    return bytes(out)


def lzw(data: bytes) -> bytes:
    codes, table, width = [(256, 9)], {bytes([k]): k for k in range(256)}, 9
    size, text = 258, b""
    for k in data:
        if text + bytes([k]) in table:
            text += bytes([k])
            continue
        codes.append((table[text], width))
        table[text + bytes([k])] = size
        size += 1
        text = bytes([k])
        if size > 4093:
            codes += [(table[text], width), (256, width)]
            table, width, size, text = {bytes([k]): k for k in range(256)}, 9, 258, b""
            continue
        width = max(9, size.bit_length())
    if text:
        codes.append((table[text], width))
        size += 1
        width = min(12, max(9, size.bit_length()))
    codes.append((257, width))
    bits = "".join(f"{c:0{w}b}" for c, w in codes)
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


PACKERS = {1: bytes, 8: zlib.compress, 32773: pack_bits, 5: lzw}


def write_tiff(
    path, data, order="<", compression=1, rows_per_strip=None, tile=None, planar=False, predictor=1,
    tie=None, scale=None, keys=None, nodata=None, metadata=None, big=False, extra=(),
):
    """``data``: (rows, cols) or (rows, cols, bands) array."""
    data = data[..., None] if data.ndim == 2 else data
    rows, cols, bands = data.shape
    data = data.astype(data.dtype.newbyteorder(order))
    blocks = []
    for plane in [data[..., k : k + 1] for k in range(bands)] if planar else [data]:
        if tile:
            for r in range(0, rows, tile[0]):
                for c in range(0, cols, tile[1]):
                    part = plane[r : r + tile[0], c : c + tile[1]]
                    block = np.zeros((*tile, plane.shape[2]), data.dtype)
                    block[: part.shape[0], : part.shape[1]] = part
                    blocks.append(block)
        else:
            step = rows_per_strip or rows
            blocks += [plane[r : r + step] for r in range(0, rows, step)]
    if predictor == 2:
        blocks = [
            np.concatenate([b[:, :1], np.diff(b, axis=1)], axis=1).astype(data.dtype) for b in blocks
        ]
    packed = [PACKERS[compression](b.tobytes()) for b in blocks]
    head = 16 if big else 8
    offsets, body = [], b""
    for p in packed:
        offsets.append(head + len(body))
        body += p + b"\0" * (len(p) % 2)
    entries = [
        (256, "I", [cols]), (257, "I", [rows]), (258, "H", [data.dtype.itemsize * 8] * bands),
        (259, "H", [compression]), (277, "H", [bands]), (284, "H", [2 if planar else 1]),
        (339, "H", [KINDS[data.dtype.kind]] * bands),
    ]
    places = (324, 325) if tile else (273, 279)
    entries += [(places[0], "I", offsets), (places[1], "I", [len(p) for p in packed])]
    entries += [(322, "H", [tile[1]]), (323, "H", [tile[0]])] if tile else [(278, "I", [rows_per_strip or rows])]
    if predictor != 1:
        entries.append((317, "H", [predictor]))
    if tie:
        entries.append((33922, "d", [0, 0, 0, *tie, 0]))
    if scale:
        entries.append((33550, "d", [*scale, 0]))
    if keys:
        flat = [1, 1, 0, len(keys)] + [v for k, value in keys for v in (k, 0, 1, value)]
        entries.append((34735, "H", flat))
    for tag, text in ((42113, nodata), (42112, metadata)):
        if text is not None:
            entries.append((tag, "s", text.encode() + b"\0"))
    entries += list(extra)
    kinds = {"H": 3, "I": 4, "d": 12, "s": 2}
    word, inline, entry = ("Q", 8, 20) if big else ("I", 4, 12)
    at = head + len(body)
    beyond = at + (8 if big else 2) + entry * len(entries) + struct.calcsize("=" + word)
    directory, tail = struct.pack(order + ("Q" if big else "H"), len(entries)), b""
    for tag, kind, values in sorted(entries):
        raw = values if kind == "s" else struct.pack(order + kind * len(values), *values)
        place = raw.ljust(inline, b"\0")
        if len(raw) > inline:
            place = struct.pack(order + word, beyond + len(tail))
            tail += raw + b"\0" * (len(raw) % 2)
        directory += struct.pack(order + "HH" + word, tag, kinds[kind], len(values)) + place
    mark = {"<": b"II", ">": b"MM"}[order]
    top = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    with open(path, "wb") as f:
        f.write(top + body + directory + struct.pack(order + word, 0) + tail)
    return str(path)
