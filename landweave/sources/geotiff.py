"""The TIFF format: directories by byte ranges, and tiles or strips, compressed or not, as arrays."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

Read = Callable[[int, int], bytes]

#: Fixed values of the format: type sizes and codes, tag numbers, compressions.
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, FORMAT = 322, 323, 324, 325, 339
SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113
PROJECTED, GEOGRAPHIC = 3072, 2048
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
CLEAR, END = 256, 257
KINDS = {1: "u", 2: "i", 3: "f"}
#: Bytes that are read at once from a file's head, where the directories of most files are.
HEAD = 16_384


def directory(read: Read, size: int) -> dict:
    """What the first directory of a file says: layout, georeference, and offsets and sizes of tiles (planes, rows, columns)."""
    head = read(0, min(HEAD, size))

    def part(at: int, n: int) -> bytes:
        return head[at : at + n] if at + n <= len(head) else read(at, n)

    order = {b"II": "<", b"MM": ">"}[head[:2]]
    (version,) = struct.unpack_from(order + "H", head, 2)
    big = {42: False, 43: True}[version]
    (at,) = struct.unpack_from(order + ("Q" if big else "I"), head, 8 if big else 4)
    counter, entry, inline = ("Q", 20, 8) if big else ("H", 12, 4)
    (count,) = struct.unpack(order + counter, part(at, struct.calcsize(counter)))
    body = part(at + struct.calcsize(counter), count * entry)
    tags: dict[int, tuple] = {}
    for k in range(count):
        number, kind = struct.unpack_from(order + "HH", body, k * entry)
        (n,) = struct.unpack_from(order + ("Q" if big else "I"), body, k * entry + 4)
        if kind not in TYPES:
            continue
        width, code = TYPES[kind]
        place = k * entry + (12 if big else 8)
        raw = body[place : place + width * n] if width * n <= inline else part(struct.unpack_from(order + ("Q" if big else "I"), body, place)[0], width * n)
        tags[number] = (raw,) if code == "s" else struct.unpack(f"{order}{n * len(code)}{code[0]}", raw)
    if TRANSFORM in tags:
        a = tags[TRANSFORM]
        if a[1] or a[4]:
            raise ValueError("the grid is turned")
        scale, corner = (a[0], -a[5]), (a[3], a[7])
    else:
        tie = tags[TIEPOINT]
        scale = tags[SCALE][:2]
        corner = (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1])
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    width, height, samples = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, (1,))[0]
    planar = tags.get(PLANAR, (1,))[0]
    tiled = TILE_OFFSETS in tags
    tile_width = tags[TILE_WIDTH][0] if tiled else width
    tile_height = tags[TILE_HEIGHT][0] if tiled else min(height, tags.get(STRIP_ROWS, (height,))[0])
    shape = (samples if planar == 2 else 1, -(-height // tile_height), -(-width // tile_width))
    bits = tags.get(BITS, (1,))
    dtype = f"{order}{KINDS[tags.get(FORMAT, (1,))[0]]}{bits[0] // 8}"
    if len(set(bits)) > 1 or bits[0] not in (8, 16, 32, 64):
        raise ValueError(f"samples of {bits} bits")
    nodata = tags[NODATA][0].split(b"\0")[0].strip() if NODATA in tags else b""
    layout = {"width": width, "height": height, "tile_width": tile_width, "tile_height": tile_height, "tiled": tiled, "samples": samples, "planar": planar, "dtype": dtype, "compression": tags.get(COMPRESSION, (PLAIN,))[0], "predictor": tags.get(PREDICTOR, (1,))[0]}
    return {
        "layout": layout,
        "epsg": codes.get(PROJECTED) or codes.get(GEOGRAPHIC),
        "minx": corner[0], "maxy": corner[1], "step_x": scale[0], "step_y": scale[1],
        "nodata": float(nodata) if nodata else None,
        "offsets": np.array(tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], dtype=np.int64).reshape(shape),
        "sizes": np.array(tags[TILE_BYTES if tiled else STRIP_BYTES], dtype=np.int64).reshape(shape),
    }


def unpacked_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest first, that grow one code early."""
    out: list[bytes] = []
    table: list[bytes] = []
    held = bits = 0
    width, last = 9, b""
    for byte in data:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == END:
            break
        if code == CLEAR:
            table = [bytes([k]) for k in range(256)] + [b"", b""]
            width, last = 9, b""
            continue
        if not last:
            last = table[code]
            out.append(last)
            continue
        word = table[code] if code < len(table) else last + last[:1]
        if code > len(table):
            raise ValueError("not LZW")
        out.append(word)
        table.append(last + word[:1])
        last = word
        width = min(12, (len(table) + 1).bit_length())
    return b"".join(out)


def tile_array(raw: bytes, layout: dict, row: int) -> np.ndarray:
    """A tile's values (samples in the tile, rows, columns); row: the tile's row, as the last strip may be lower."""
    kind = layout["compression"]
    if kind in (DEFLATE, OLD_DEFLATE):
        raw = zlib.decompress(raw)
    elif kind == LZW:
        raw = unpacked_lzw(raw)
    elif kind != PLAIN:
        raise ValueError(f"compression {kind}")
    dtype, width, height = np.dtype(layout["dtype"]), layout["tile_width"], layout["tile_height"]
    if not layout["tiled"]:
        height = min(height, layout["height"] - row * height)
    samples = layout["samples"] if layout["planar"] == 1 else 1
    if len(raw) < height * width * samples * dtype.itemsize:
        raise ValueError("a tile is cut short")
    lines = np.frombuffer(raw, np.uint8, height * width * samples * dtype.itemsize).reshape(height, -1)
    if layout["predictor"] == 3:  # byte planes, the highest first, each byte less the one before
        summed = np.cumsum(lines.reshape(height, -1, samples), axis=1, dtype=np.uint8).reshape(height, dtype.itemsize, -1)
        values = np.ascontiguousarray(summed.transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(height, width, samples)
    else:
        values = lines.view(dtype).reshape(height, width, samples)
        if layout["predictor"] == 2:  # each value less the one before
            unsigned = np.dtype(f"u{dtype.itemsize}")
            values = np.cumsum(values.astype(dtype.newbyteorder("=")).view(unsigned), axis=1, dtype=unsigned).view(dtype.newbyteorder("="))
    return values.transpose(2, 0, 1)
