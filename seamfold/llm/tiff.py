"""Reading and writing of baseline TIFF images with 8-bit samples, from and to bytes."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

# fixed values of the TIFF 6.0 specification and its common additions
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
_KINDS = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIPS, SAMPLES, ROWS_PER_STRIP, STRIP_SIZES, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES = 317, 322, 323, 324, 325
CLEAR, END = 256, 257
#: Bytes that one byte of a strip can become at most: an LZW code of 12 bits stands for up to 3840 of them.
MOST_EXPANSION = 2600
_BASE = [bytes((i,)) for i in range(256)] + [b"", b""]


class TiffError(ValueError):
    pass


@dataclass
class Page:
    number: int
    width: int
    height: int
    channels: int
    compression: int
    predictor: int
    tiled: bool
    samples: np.ndarray = field(repr=False)  # height x width x channels


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as repeats, the rest as literals."""
    a = np.frombuffer(data, np.uint8)
    cuts = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]]) if len(a) else np.zeros(1, np.int64)
    size = np.diff(cuts)
    out, literal = bytearray(), 0
    for i in np.flatnonzero(size >= 3).tolist():
        start, end = int(cuts[i]), int(cuts[i + 1])
        _literals(out, data, literal, start)
        while end - start >= 2:
            n = min(128, end - start)
            out += bytes((257 - n, data[start]))
            start += n
        literal = start
    _literals(out, data, literal, len(data))
    return bytes(out)


def _literals(out: bytearray, data: bytes, start: int, end: int) -> None:
    for at in range(start, end, 128):
        part = data[at : min(at + 128, end)]
        out.append(len(part) - 1)
        out += part


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += 2 + n
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out[:size])


def lzw_encode(data: bytes) -> bytes:
    """Codes from 9 to 12 bits, most significant bit first, widening one code early."""
    bits = count = 0
    out, width = bytearray(), 9

    def put(code: int) -> None:
        nonlocal bits, count
        bits, count = bits << width | code, count + width
        while count >= 8:
            count -= 8
            out.append(bits >> count & 255)
        bits &= (1 << count) - 1

    put(CLEAR)
    table, fresh, held = {}, 258, -1
    for byte in data:
        if held < 0:
            held = byte
            continue
        if (code := table.get(held << 8 | byte)) is not None:
            held = code
            continue
        put(held)
        table[held << 8 | byte] = fresh
        fresh += 1
        if fresh == 4094:
            put(CLEAR)
            table, fresh, width = {}, 258, 9
        elif fresh in (512, 1024, 2048):
            width += 1
        held = byte
    if held >= 0:
        put(held)
        fresh += 1
        width += fresh in (512, 1024, 2048)
    put(END)
    if count:
        out.append(bits << (8 - count) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out, bits, count, width = bytearray(), 0, 0, 9
    table, last = _BASE[:], None
    for byte in data:
        bits, count = bits << 8 | byte, count + 8
        if count < width:
            continue
        count -= width
        code, bits = bits >> count, bits & ((1 << count) - 1)
        if code == END:
            break
        if code == CLEAR:
            table, last, width = _BASE[:], None, 9
            continue
        if last is None:
            entry = table[code]
        else:
            known = len(table)
            if code > known:
                raise TiffError("an LZW code comes before its entry")
            entry = table[code] if code < known else last + last[:1]
            table.append(last + entry[:1])
            if known in (510, 1022, 2046):
                width += 1
        out += entry
        last = entry
        if len(out) >= size:
            break
    return bytes(out[:size])


def _encode(data: bytes, compression: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return pack_bits(data)
    if compression == LZW:
        return lzw_encode(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.compress(data, 1)
    raise TiffError(f"compression {compression} is not known")


def _decode(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        out = data[:size]
    elif compression == PACKBITS:
        out = unpack_bits(data, size)
    elif compression == LZW:
        out = lzw_decode(data, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, size)
    else:
        raise TiffError(f"compression {compression} is not known")
    if len(out) != size:
        raise TiffError(f"a strip or tile holds {len(out)} bytes instead of {size}")
    return out


def write(pages: list[dict], order: str = "<") -> bytes:
    """A TIFF of pages: samples (height x width x channels, uint8), compression, predictor, rows (of a strip) or tile (height, width; multiples of 16)."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    patch = 4
    for page in pages:
        a = page["samples"]
        a = a[:, :, None] if a.ndim == 2 else a
        height, width, channels = a.shape
        compression, predictor = page.get("compression", NONE), page.get("predictor", 1)
        if tile := page.get("tile"):
            full = np.zeros((-(-height // tile[0]) * tile[0], -(-width // tile[1]) * tile[1], channels), np.uint8)
            full[:height, :width] = a
            blocks = [full[y : y + tile[0], x : x + tile[1]] for y in range(0, height, tile[0]) for x in range(0, width, tile[1])]
        else:
            rows = page.get("rows", height)
            blocks = [a[y : y + rows] for y in range(0, height, rows)]
        places, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], b[:, 1:] - b[:, :-1]], axis=1)
            data = _encode(np.ascontiguousarray(b).tobytes(), compression)
            places.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        tags = {WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [8] * channels), COMPRESSION: (3, [compression]), PHOTOMETRIC: (3, [2 if channels == 3 else 1]), SAMPLES: (3, [channels]), PLANAR: (3, [1]), PREDICTOR: (3, [predictor])}
        tags |= {TILE_WIDTH: (4, [tile[1]]), TILE_HEIGHT: (4, [tile[0]]), TILES: (4, places), TILE_SIZES: (4, sizes)} if tile else {STRIPS: (4, places), ROWS_PER_STRIP: (4, [rows]), STRIP_SIZES: (4, sizes)}
        entries = bytearray()
        for tag, (kind, values) in sorted(tags.items()):
            data = struct.pack(order + str(len(values)) + _KINDS[kind], *values)
            if len(data) > 4:
                at = len(out)
                out += data + b"\0" * (len(data) % 2)
                data = struct.pack(order + "I", at)
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        struct.pack_into(order + "I", out, patch, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        patch = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _tags(data: bytes, order: str, at: int) -> tuple[dict[int, list], int]:
    (n,) = struct.unpack_from(order + "H", data, at)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind not in _KINDS:
            continue
        form = f"{order}{count}{_KINDS[kind]}"
        place = at + 10 + 12 * i
        if struct.calcsize(form) > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        tags[tag] = list(struct.unpack_from(form, data, place))
    return tags, struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def walk(data: bytes) -> Iterator[Page]:
    """The pages of a TIFF, in the order of its directories; TiffError if it is broken."""
    try:
        order = {b"II": "<", b"MM": ">"}[data[:2]]
        magic, at = struct.unpack_from(order + "HI", data, 2)
        if magic != 42:
            raise TiffError("not a TIFF")
        seen: set[int] = set()
        while at:
            if at in seen:
                raise TiffError("the directories form a circle")
            seen.add(at)
            tags, at = _tags(data, order, at)
            yield _page(data, tags, len(seen) - 1)
    except TiffError:
        raise
    except (struct.error, LookupError, zlib.error, ValueError, TypeError, ArithmeticError, MemoryError) as e:
        raise TiffError(f"broken: {e!r}") from e


def _page(data: bytes, tags: dict[int, list], number: int) -> Page:
    one = lambda tag, default=None: tags.get(tag, [default])[0]
    width, height, channels = tags[WIDTH][0], tags[HEIGHT][0], one(SAMPLES, 1)
    compression, predictor, planes = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1)
    if any(b != 8 for b in tags.get(BITS, [1])) or predictor not in (1, 2) or planes not in (1, 2):
        raise TiffError("only 8-bit samples and predictors 1 and 2 are read")
    tiled = TILES in tags
    places, sizes = (tags[TILES], tags[TILE_SIZES]) if tiled else (tags[STRIPS], tags[STRIP_SIZES])
    rows, columns = (tags[TILE_HEIGHT][0], tags[TILE_WIDTH][0]) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    deep = 1 if planes == 2 else channels
    if min(width, height, channels, rows, columns) < 1:
        raise TiffError("a page, strip or tile has no samples")
    blocks = -(-height // rows) * -(-width // columns) * (channels if planes == 2 else 1)
    if not blocks == len(places) == len(sizes):
        raise TiffError(f"{len(places)} offsets and {len(sizes)} sizes for {blocks} strips or tiles")
    # no strip can hold more than its codec's largest expansion, so nothing larger is ever allocated
    if rows * columns * deep * blocks > MOST_EXPANSION * sum(sizes) or sum(sizes) > max(1, blocks) * len(data):
        raise TiffError(f"{width} x {height} samples cannot come from {len(data)} bytes")
    out = np.zeros((height, width, channels), np.uint8)
    block = iter(zip(places, sizes, strict=True))
    for plane in range(channels if planes == 2 else 1):
        for y in range(0, height, rows):
            for x in range(0, width, columns):
                place, size = next(block)
                tall = rows if tiled else min(rows, height - y)
                b = np.frombuffer(_decode(data[place : place + size], compression, tall * columns * deep), np.uint8).reshape(tall, columns, deep)
                if predictor == 2:
                    b = np.cumsum(b, axis=1, dtype=np.uint8)
                part = out[y : y + tall, x : x + columns]
                part = part[:, :, plane : plane + 1] if planes == 2 else part
                part[:] = b[: part.shape[0], : part.shape[1]]
    return Page(number, width, height, channels, compression, predictor, tiled, out)
