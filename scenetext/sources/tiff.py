"""Reading and writing one TIFF image held in memory, for the scan and the image sink.

Covers 8- and 16-bit unsigned samples, strips or tiles, stored plain or
deflated, with the usual georeference tags. Anything else raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

# Tag numbers of the file format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
SAMPLE_FORMAT, PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 339, 33550, 33922, 34735, 42113

# Field types (code, struct letter) and compression schemes.
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
PLAIN, DEFLATE, DEFLATE_OLD = 1, 8, 32946

# What reading a damaged or foreign file can raise.
DAMAGED = (ValueError, LookupError, struct.error, ZeroDivisionError)

# Most bytes that one deflated byte can stand for.
DEFLATE_RATIO = 1032

# Geo keys that name a coordinate system.
PROJECTED_CRS, GEOGRAPHIC_CRS = 3072, 2048


def read_header(data: bytes) -> dict:
    return read_header_at(lambda start, n: data[start : start + n])


def read_header_at(read: Callable[[int, int], bytes]) -> dict:
    """Size, sample layout and georeference of the first image of a file.

    ``read(start, n)`` gets bytes of the file; only the tag table and its
    values are asked for.
    """
    magic = read(0, 4)
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(bytes(magic))
    if order is None:
        raise ValueError("not a TIFF file")
    try:
        tags = _read_tags(read, order)
        cols, rows = tags[WIDTH][0], tags[HEIGHT][0]
    except (struct.error, LookupError) as e:
        raise ValueError("damaged TIFF header") from e
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
    crs = codes.get(PROJECTED_CRS, codes.get(GEOGRAPHIC_CRS))
    xmin, ymin, xmax, ymax = 0.0, 0.0, float(cols), float(rows)
    if PIXEL_SCALE in tags and TIE_POINT in tags:
        sx, sy = tags[PIXEL_SCALE][:2]
        i, j, _, x, y = tags[TIE_POINT][:5]
        xmin, ymax = x - i * sx, y + j * sy
        xmax, ymin = xmin + cols * sx, ymax - rows * sy
    nodata = b"".join(tags[NODATA]).rstrip(b"\0 ").decode("ascii") if NODATA in tags else None
    return {
        "order": order,
        "tags": tags,
        "cols": cols,
        "rows": rows,
        "bands": tags.get(SAMPLES, (1,))[0],
        "extent": {"xmin": xmin, "ymin": ymin, "xmax": xmax, "ymax": ymax},
        "crs": f"EPSG:{crs}" if crs else None,
        "nodata": int(float(nodata)) if nodata else None,
    }


def _read_tags(read: Callable[[int, int], bytes], order: str) -> dict[int, tuple]:
    start = struct.unpack(order + "I", read(4, 4))[0]
    count = struct.unpack(order + "H", read(start, 2))[0]
    tags = {}
    for tag, kind, n, value in struct.iter_unpack(order + "HHI4s", read(start + 2, 12 * count)):
        if kind not in TYPES:
            continue
        layout = f"{order}{n}{TYPES[kind]}"
        size = struct.calcsize(layout)
        if size > 4:
            value = read(struct.unpack(order + "I", value)[0], size)
        tags[tag] = struct.unpack(layout, value[:size])
    return tags


def read_band(data: bytes, header: dict, band: int = 0) -> np.ndarray:
    """One band of the image as a 2-D array of unsigned numbers."""
    return read_block_rows(lambda start, n: data[start : start + n], header, band, 0, n_block_rows(header))


def n_block_rows(header: dict) -> int:
    """Rows of blocks (strips or tiles), the least that can be read on their own."""
    return -(-header["rows"] // _block_size(header)[1])


def block_height(header: dict) -> int:
    return _block_size(header)[1]


def _block_size(header: dict) -> tuple[int, int]:
    tags, cols, rows = (header[k] for k in ("tags", "cols", "rows"))
    if TILE_OFFSETS in tags:
        return tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]
    return cols, min(rows, tags.get(ROWS_PER_STRIP, (rows,))[0])


def read_block_rows(
    read: Callable[[int, int], bytes], header: dict, band: int, first_row: int, end_row: int
) -> np.ndarray:
    """Block rows ``first_row`` to ``end_row`` (excluded) of one band; ``read(start, n)`` is asked for
    their blocks only."""
    tags, cols, rows, bands = (header[k] for k in ("tags", "cols", "rows", "bands"))
    bits = set(tags.get(BITS, (1,)))
    scheme = tags.get(COMPRESSION, (PLAIN,))[0]
    if bits not in ({8}, {16}) or set(tags.get(SAMPLE_FORMAT, (1,))) != {1}:
        raise ValueError("only 8- and 16-bit unsigned samples are read")
    if scheme not in (PLAIN, DEFLATE, DEFLATE_OLD):
        raise ValueError(f"compression {scheme} is not read")
    if not 0 <= band < bands:
        raise ValueError(f"no band {band} in a file of {bands}")
    predictor = tags.get(PREDICTOR, (1,))[0]
    if predictor not in (1, 2):
        raise ValueError(f"predictor {predictor} is not read")
    width, height = _block_size(header)
    tiled = TILE_OFFSETS in tags
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    dtype = np.dtype(f"{header['order']}u{bits.pop() // 8}")
    planar = tags.get(PLANAR, (1,))[0] == 2
    depth = 1 if planar else bands
    across, down = -(-cols // width), -(-rows // height)
    first = band * across * down if planar else 0
    if len(offsets) < first + across * down:
        raise ValueError("image data ends early")
    wanted = range(first_row * across, end_row * across)
    tall_all = min(rows, end_row * height) - first_row * height
    if tall_all * cols * dtype.itemsize > DEFLATE_RATIO * sum(counts[first + k] for k in wanted):
        raise ValueError("image data ends early")
    out = None
    for k in wanted:
        top, left = k // across * height, k % across * width
        # A strip may end with the image; a tile is always stored in full.
        tall = height if tiled else min(height, rows - top)
        block = read(offsets[first + k], counts[first + k])
        if len(block) < counts[first + k]:
            raise ValueError("image data ends early")
        if scheme != PLAIN:
            try:
                block = zlib.decompress(block)
            except zlib.error as e:
                raise ValueError("damaged image data") from e
        if len(block) < tall * width * depth * dtype.itemsize:
            raise ValueError("image data ends early")
        cells = np.frombuffer(block, dtype, tall * width * depth).reshape(tall, width, depth)
        if predictor == 2:
            cells = np.cumsum(cells, axis=1, dtype=dtype.newbyteorder("="))
        cells = cells[: rows - top, : cols - left, 0 if planar else band]
        if out is None:
            # only now, as the numbers of a damaged header may ask for any size
            out = np.zeros((tall_all, cols), dtype.newbyteorder("="))
        at = top - first_row * height
        out[at : at + cells.shape[0], left : left + cells.shape[1]] = cells
    return np.zeros((0, cols), dtype.newbyteorder("=")) if out is None else out


def write_image(
    bands: np.ndarray,
    extent: tuple[float, float, float, float] | None = None,
    epsg: int | None = None,
    nodata: int | None = None,
    deflate: bool = True,
    tile: int | None = None,
) -> bytes:
    """Little-endian file from an array ``[band, row, col]`` of uint8 or uint16."""
    bands = np.ascontiguousarray(bands)
    depth, rows, cols = bands.shape
    dtype = bands.dtype.newbyteorder("<")
    pixels = np.moveaxis(bands, 0, -1).astype(dtype)
    height, width = (tile, tile) if tile else (rows, cols)
    blocks = []
    for top in range(0, rows, height):
        for left in range(0, cols, width):
            block = np.zeros((height, width, depth), dtype)
            part = pixels[top : top + height, left : left + width]
            block[: part.shape[0], : part.shape[1]] = part
            blocks.append(zlib.compress(block.tobytes()) if deflate else block.tobytes())
    starts = np.cumsum([8] + [len(b) for b in blocks])
    tags: dict[int, tuple[int, tuple]] = {
        WIDTH: (4, (cols,)),
        HEIGHT: (4, (rows,)),
        BITS: (3, (8 * dtype.itemsize,) * depth),
        COMPRESSION: (3, (DEFLATE if deflate else PLAIN,)),
        PHOTOMETRIC: (3, (2 if depth == 3 else 1,)),
        SAMPLES: (3, (depth,)),
        PLANAR: (3, (1,)),
        SAMPLE_FORMAT: (3, (1,) * depth),
    }
    offsets, counts = tuple(int(s) for s in starts[:-1]), tuple(len(b) for b in blocks)
    if tile:
        tags |= {TILE_WIDTH: (4, (tile,)), TILE_HEIGHT: (4, (tile,))}
        tags |= {TILE_OFFSETS: (4, offsets), TILE_COUNTS: (4, counts)}
    else:
        tags |= {ROWS_PER_STRIP: (4, (rows,)), STRIP_OFFSETS: (4, offsets), STRIP_COUNTS: (4, counts)}
    if extent:
        xmin, ymin, xmax, ymax = extent
        tags[PIXEL_SCALE] = (12, ((xmax - xmin) / cols, (ymax - ymin) / rows, 0.0))
        tags[TIE_POINT] = (12, (0.0, 0.0, 0.0, xmin, ymax, 0.0))
    if epsg:
        tags[GEO_KEYS] = (3, (1, 1, 0, 1, PROJECTED_CRS, 0, 1, epsg))
    if nodata is not None:
        tags[NODATA] = (2, tuple(bytes([c]) for c in f"{nodata}\0".encode()))
    table_at = int(starts[-1]) + int(starts[-1]) % 2
    extra_at = table_at + 2 + 12 * len(tags) + 4
    table, extra = struct.pack("<H", len(tags)), b""
    for tag, (kind, values) in sorted(tags.items()):
        packed = struct.pack(f"<{len(values)}{TYPES[kind]}", *values)
        entry = struct.pack("<HHI", tag, kind, len(values))
        if len(packed) <= 4:
            table += entry + packed.ljust(4, b"\0")
        else:
            table += entry + struct.pack("<I", extra_at + len(extra))
            extra += packed + b"\0" * (len(packed) % 2)
    body = b"".join(blocks).ljust(table_at - 8, b"\0")
    return b"II*\0" + struct.pack("<I", table_at) + body + table + b"\0\0\0\0" + extra
