"""Media columns of baseline JPEG.

``jpeg_store`` keeps a payload as a grey baseline JPEG: one flat 8x8 block per byte, so that
the DC coefficient is the sample and nothing is lost. ``jpeg_features`` reads any baseline
JPEG column: it parses the markers, Huffman-decodes the scan and reconstructs the DC-only
luminance thumbnail (one sample per block), which for a stored payload is the payload.

Both work on a block of images at once in numpy. Restart intervals cut a scan into
segments of 192 blocks, and the decoder advances all segments of all images in lock-step.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks, text_bytes

#: Blocks in a restart interval; payloads are padded to a multiple of it.
INTERVAL = 192
#: Most blocks in a column of an image, and most intervals in a row (65,535 pixels each way).
MOST_ROWS, MOST_ACROSS = 8191, 42
#: Samples that are packed together, a multiple of eight intervals; and bytes of scans that are decoded together.
GROUP_BYTES, DECODE_BYTES = 2048 * 8 * INTERVAL, 4 << 20
#: Huffman codes of the luminance DC differences: how many codes of each length from 1 to 16, and the
#: categories in code order (fixed values of the JPEG standard, table K.3).
DC_COUNTS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_VALUES = tuple(range(12))
#: The only AC code needed is the end of a block, in one bit.
AC_COUNTS = (1,) + (0,) * 15
AC_VALUES = (0,)


def _codes(counts: tuple[int, ...]) -> list[tuple[int, int]]:
    """(code, length) in code order."""
    out, code = [], 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((code, length))
            code += 1
        code <<= 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each sample difference from -255 to 255: category code, value, end of block."""
    codes = dict(zip(DC_VALUES, _codes(DC_COUNTS), strict=True))
    bits, sizes = np.zeros(511, np.int32), np.zeros(511, np.int32)
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, length = codes[category]
        value = d if d >= 0 else d + (1 << category) - 1
        bits[d + 255] = ((code << category) | value) << 1
        sizes[d + 255] = length + category + 1
    return bits, sizes


@cache
def _tables() -> bytes:
    quant = _segment(0xDB, b"\0" + bytes([8] + [1] * 63))
    return quant + _segment(0xC4, b"\0" + bytes(DC_COUNTS) + bytes(DC_VALUES) + b"\x10" + bytes(AC_COUNTS) + bytes(AC_VALUES)) + _segment(0xDD, struct.pack(">H", INTERVAL))


def _header(rows: int, across: int, payload: int) -> bytes:
    """Up to the scan; a comment keeps the payload's bytes, as rows may be filled up."""
    frame = _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, across * INTERVAL * 8, 1) + b"\1\x11\0")
    return b"\xff\xd8" + _segment(0xFE, b"%d" % payload) + _tables() + frame + _segment(0xDA, b"\1\1\0\0\x3f\0")


def _scans(samples: np.ndarray, per_image: np.ndarray) -> list[bytes]:
    """Entropy-coded scans of images of ``per_image`` intervals each, whose samples follow one another."""
    x = samples.reshape(-1, INTERVAL).astype(np.int16)
    diffs = np.diff(x, axis=1, prepend=np.int16(128)) + np.int16(255)
    bits, sizes = _symbols()
    size = sizes[diffs]
    ends = np.cumsum(size, axis=1, dtype=np.int32)
    seg_bits = ends[:, -1]
    seg_bytes = (seg_bits + 7) >> 3
    base = np.concatenate([[0], np.cumsum(seg_bytes, dtype=np.int64)])
    at = ends - size + (base[:-1, None] << 3).astype(np.int32)
    window = (bits[diffs] << (24 - size - (at & 7))).ravel()
    first, total = (at >> 3).ravel(), int(base[-1])
    # Symbols that start in the same byte follow one another: one window for each such byte.
    heads = np.flatnonzero(np.diff(first, prepend=-1))
    starting = np.zeros(total + 2, np.int32)
    starting[first[heads]] = np.bitwise_or.reduceat(window, heads)
    packed = (starting >> 16).astype(np.uint8)
    packed[1:] |= (starting[:-1] >> 8).astype(np.uint8)
    packed[2:] |= starting[:-2].astype(np.uint8)
    packed = packed[:total]
    packed[base[1:] - 1] |= ((1 << (-seg_bits & 7)) - 1).astype(np.uint8)
    # Stuffed zeros after each FF, and a restart marker between the intervals of an image.
    full = packed == 255
    image = np.repeat(np.arange(len(per_image)), per_image)
    marks = np.arange(len(x)) - image
    shift = np.cumsum(full) - full + np.repeat(2 * marks, seg_bytes)
    where = np.arange(total) + shift
    out = np.zeros(total + int(full.sum()) + 2 * (len(x) - len(per_image)), np.uint8)
    out[where] = packed
    last = base[1:] - 1
    seg_end = where[last] + 1 + full[last]
    first_seg = np.concatenate([[0], np.cumsum(per_image)])
    inner = np.ones(len(x), bool)
    inner[first_seg[1:] - 1] = False
    number = np.arange(len(x)) - first_seg[image]
    out[seg_end[inner]] = 255
    out[seg_end[inner] + 1] = 0xD0 + (number[inner] & 7)
    cut = np.concatenate([[0], seg_end[first_seg[1:] - 1]])
    return [out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def jpeg_encode(payloads: list[bytes]) -> list[bytes]:
    """A grey baseline JPEG for each payload (a positive multiple of 192 bytes); a payload that is larger
    than one image can hold becomes several images, one after the other."""
    most = MOST_ROWS * MOST_ACROSS * INTERVAL
    images = []  # (payload index, rows, across, bytes)
    data, counts = [], []
    for i, p in enumerate(payloads):
        for at in range(0, len(p), most):
            part = p[at : at + most]
            across = -(-len(part) // (INTERVAL * MOST_ROWS))
            rows = -(-len(part) // (INTERVAL * across))
            images.append((i, rows, across, len(part)))
            data.append(part.ljust(rows * across * INTERVAL))
            counts.append(rows * across)
    out: list[list[bytes]] = [[] for _ in payloads]
    start = 0
    while start < len(images):  # bit places of a group fit 32 bits
        stop, size = start + 1, len(data[start])
        while stop < len(images) and size + len(data[stop]) <= GROUP_BYTES:
            size, stop = size + len(data[stop]), stop + 1
        if size > GROUP_BYTES:
            scans = [_long_scan(data[start])]
        else:
            scans = _scans(np.frombuffer(b"".join(data[start:stop]), np.uint8), np.array(counts[start:stop]))
        for (i, rows, across, n), scan in zip(images[start:stop], scans, strict=True):
            out[i] += [_header(rows, across, n), scan, b"\xff\xd9"]
        start = stop
    return [b"".join(x) for x in out]


def _long_scan(samples: bytes) -> bytes:
    """The scan of a large image, group by group: after a multiple of eight intervals stands the eighth restart marker."""
    parts = [np.frombuffer(samples[at : at + GROUP_BYTES], np.uint8) for at in range(0, len(samples), GROUP_BYTES)]
    return b"\xff\xd7".join(_scans(x, np.array([len(x) // INTERVAL]))[0] for x in parts)


class _Image:
    """What the markers of one image say."""

    def __init__(self):
        self.quant, self.huffman, self.interval, self.comment = {}, {}, 0, b""
        self.components, self.scan, self.width, self.height = [], [], 0, 0

    def read(self, data: bytes, at: int) -> int:
        """Parse from the start-of-image marker at ``at``; the place of the entropy-coded data."""
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("not a JPEG image")
        at += 2
        while True:
            while data[at + 1] == 0xFF:
                at += 1
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")  # of DC
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.huffman[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xC0:
                _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
                self.components = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
            elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a baseline JPEG image")
            elif marker == 0xDD:
                self.interval = int.from_bytes(body[:2], "big")
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDA:
                self.scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
                return at

    def layout(self) -> list[tuple[int, bytes, bytes]]:
        """(component, DC table, AC table) of each block of an MCU."""
        by_id = {c[0]: c for c in self.components}
        return [(k, self.huffman[dc], self.huffman[16 | ac]) for k, (c, dc, ac) in enumerate(self.scan) for _ in range(by_id[c][1] * by_id[c][2] if len(self.scan) > 1 else 1)]

    def mcus(self) -> tuple[int, int]:
        """Across and down."""
        if len(self.scan) == 1:
            return -(-self.width // 8), -(-self.height // 8)
        h, v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


@cache
def _lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for each 16 bits that may come next."""
    symbol, length = np.zeros(65536, np.int32), np.full(65536, 16, np.int32)
    for (code, size), value in zip(_codes(tuple(table[:16])), table[16:], strict=True):
        a = code << (16 - size)
        symbol[a : a + (1 << (16 - size))] = value
        length[a : a + (1 << (16 - size))] = size
    return symbol, length


def _decode(words: np.ndarray, bit: np.ndarray, counts: np.ndarray, layout: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """DC values of the first component's blocks, one row per segment. words: 32 bits from each byte
    on; bit: where each segment starts, changed in place; counts: MCUs of each segment, descending."""
    most, wanted = int(counts.max(initial=0)), [k for k, b in enumerate(layout) if b[0] == 0]
    out = np.zeros((len(bit), most * len(wanted)), np.int32)
    before = np.zeros((1 + max(b[0] for b in layout), len(bit)), np.int64)
    last = len(words) - 1

    def peek(at: np.ndarray) -> np.ndarray:
        return ((words[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(16)).astype(np.int32)

    column = 0
    for mcu in range(most):
        live = int(np.searchsorted(-counts, -mcu, side="left"))
        at = bit[:live]
        for component, dc, ac in layout:
            symbol, length = _lookup(dc)
            w = peek(at)
            size = symbol[w]
            at += length[w]
            value = peek(at) >> (16 - size)
            at += size
            before[component, :live] += np.where((size > 0) & (value < (1 << size >> 1)), value - (1 << size) + 1, value)
            if component == 0:
                out[:live, column] = before[0, :live]
                column += 1
            symbol, length = _lookup(ac)
            w = peek(at)
            run = symbol[w]
            at += length[w]
            if run.any():  # other coefficients: skip them
                k = np.ones(live, np.int64)
                busy = np.flatnonzero(run)
                run = run[busy]
                while len(busy):
                    at[busy] += run & 15
                    k[busy] += (run >> 4) + 1
                    busy = busy[k[busy] < 64]
                    w = peek(at[busy])
                    run = symbol[w]
                    at[busy] += length[w]
                    busy, run = busy[run != 0], run[run != 0]
    return out


def _segments(big: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, layout: list[tuple[int, bytes, bytes]], per: int) -> np.ndarray:
    """DC values (16 bits hold them) of segments in order, of which each lies from a start to an end, decoded
    some megabytes at a time."""
    out, a = [], 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + DECODE_BYTES, side="right")))
        part = big[starts[a] : ends[b - 1] + 2]
        keep = np.ones(len(part), bool)
        keep[1:] &= ~((part[1:] == 0) & (part[:-1] == 255))
        moved = np.cumsum(keep) - keep
        clean = np.concatenate([part[keep].astype(np.uint32), np.zeros(4, np.uint32)])
        words = (clean[:-3] << 24) | (clean[1:-2] << 16) | (clean[2:-1] << 8) | clean[3:]
        own = counts[a:b]
        order = np.argsort(-own, kind="stable")
        values = _decode(words, moved[starts[a:b][order] - starts[a]] * 8, own[order], layout)[np.argsort(order, kind="stable")]
        out.append(values[np.arange(values.shape[1]) < own[:, None] * per].astype(np.int16))
        a = b
    return np.concatenate(out) if out else np.zeros(0, np.int16)


def jpeg_thumbnails(files: list[bytes]) -> list[list[tuple[int, int, bytes, np.ndarray]]]:
    """For each file its images: width, height, comment and the DC-only luminance thumbnail (uint8, one
    sample per 8x8 block of the first component, in rows)."""
    data = b"".join(files)
    big = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero((big[:-1] == 255) & (big[1:] != 0) & (big[1:] != 255))
    restart = (big[marks + 1] >= 0xD0) & (big[marks + 1] <= 0xD7)
    stops, restarts = marks[~restart], marks[restart]
    images = []  # (file, image, scan start, scan end)
    start = 0
    for i, f in enumerate(files):
        at, start = start, start + len(f)
        while at < start:
            image = _Image()
            scan = image.read(data, at)
            end = int(stops[np.searchsorted(stops, scan)])
            images.append((i, image, scan, end))
            at = end
            if data[at + 1] == 0xD9:
                at += 2
            else:  # further scans carry no luminance
                at = data.find(b"\xff\xd8\xff", at)
                at = start if at < 0 else at
    groups: dict[tuple, list[int]] = {}
    for k, (_, image, _, _) in enumerate(images):
        groups.setdefault(tuple(image.layout()), []).append(k)
    out: list[list[tuple[int, int, bytes, np.ndarray]]] = [[] for _ in files]
    thumbs: dict[int, np.ndarray] = {}
    for layout, members in groups.items():
        starts, counts, ends, spans = [], [], [], []
        for k in members:
            _, image, scan, end = images[k]
            cuts = restarts[np.searchsorted(restarts, scan) : np.searchsorted(restarts, end)] + 2
            across, down = image.mcus()
            n = across * down
            each = image.interval or n
            own = np.minimum(each, n - each * np.arange(-(-n // each)))
            begins = np.concatenate([[scan], cuts])[: len(own)]
            own = own[: len(begins)]
            spans.append((k, int(own.sum())))
            starts.append(begins)
            counts.append(own)
            ends.append(np.append(cuts, end)[: len(begins)])
        per = sum(b[0] == 0 for b in layout)
        values = _segments(big, np.concatenate(starts), np.concatenate(ends), np.concatenate(counts), list(layout), per)
        at = 0
        for k, n in spans:
            thumbs[k] = values[at : at + n * per]
            at += n * per
    for k, (i, image, _, _) in enumerate(images):
        across, _ = image.mcus()
        component = next(c for c in image.components if c[0] == image.scan[0][0])
        quant, raw = image.quant[component[3]], thumbs.pop(k)
        dc = np.concatenate([np.clip((raw[p : p + DECODE_BYTES].astype(np.int32) * quant + 4) // 8 + 128, 0, 255).astype(np.uint8) for p in range(0, max(1, len(raw)), DECODE_BYTES)])
        h, v = (component[1], component[2]) if len(image.scan) > 1 else (1, 1)
        dc = dc[: len(dc) // (across * h * v) * across * h * v]
        dc = dc.reshape(-1, across, v, h).swapaxes(1, 2).reshape(-1, across * h)
        out[i].append((image.width, image.height, image.comment, dc))
    return out


def _readable(files: list[bytes]) -> list[list[tuple[int, int, bytes, np.ndarray]]]:
    """``jpeg_thumbnails`` of files of which some may be broken: those have no images."""
    try:
        return jpeg_thumbnails(files)
    except (ValueError, KeyError, IndexError, StopIteration, ZeroDivisionError, struct.error):
        return [x for f in files for x in _readable([f])] if len(files) > 1 else [[]]


def thumbnail_hashes(thumb: np.ndarray) -> str:
    """Average hash and difference hash of a thumbnail, from the means of an 8 by 9 grid, as 32 hex digits."""
    if not thumb.size:
        return "0" * 32
    rows, cols = (np.arange(8) * thumb.shape[0]) // 8, (np.arange(9) * thumb.shape[1]) // 9
    last = lambda a, n: np.maximum(np.append(a[1:], n), a + 1)
    area = np.concatenate([np.zeros((1, thumb.shape[1])), np.cumsum(thumb, axis=0, dtype=np.float64)])
    sums = area[last(rows, thumb.shape[0])] - area[rows]
    area = np.concatenate([np.zeros((8, 1)), np.cumsum(sums, axis=1)], axis=1)
    ends = last(cols, thumb.shape[1])
    grid = (area[:, ends] - area[:, cols]) / ((last(rows, thumb.shape[0]) - rows)[:, None] * (ends - cols))
    average = grid[:, :8] > grid[:, :8].mean()
    return np.packbits(average).tobytes().hex() + np.packbits(grid[:, 1:] > grid[:, :-1]).tobytes().hex()


def jpeg_store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text's UTF-8) and media (the JPEG) of every whole text.

    The payload is the text's bytes with spaces up to a positive multiple of 192, so null and
    empty texts give 192 spaces. Equal texts give equal media, and repeated rows a row each. An empty table gives an empty result. Other columns are not read.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            texts = text_bytes(block.column("text"))
            media = jpeg_encode([t.ljust(max(INTERVAL, -(-len(t) // INTERVAL) * INTERVAL)) for t in texts])
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(store, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def jpeg_features(media: DataFrame, *, media_col: str = "media") -> DataFrame:
    """``media`` without its media column and with width, height, thumb_hash and payload (binary: the samples
    that the media hold, as many as their comment says). A null file, and one that is no whole baseline JPEG, gives 0, 0,
    zeros and an empty payload; of several images in a file the first gives the dimensions and the hash."""
    others = [c for c in media.columns if c != media_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, media_col, 3 << 20):
            found = _readable(text_bytes(block.column(media_col)))
            payload = [b"".join(t.tobytes()[: int(c) if c.isdigit() else None] for _, _, c, t in images) for images in found]
            first = [images[0] if images else (0, 0, b"", np.zeros((0, 0), np.uint8)) for images in found]
            made = [pa.array([x[0] for x in first], pa.int32()), pa.array([x[1] for x in first], pa.int32()), pa.array([thumbnail_hashes(x[3]) for x in first], pa.string()), pa.array(payload, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in others), *made], [*others, "width", "height", "thumb_hash", "payload"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema if f.name != media_col)
    return media.mapInArrow(read, f"{kept}, width int, height int, thumb_hash string, payload binary")
