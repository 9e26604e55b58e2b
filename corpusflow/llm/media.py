"""Progressive JPEG: scans accumulated into coefficients, decoded to RGB tensors in numpy.

``decode`` reads any 8-bit progressive Huffman JPEG of one or three components: spectral
selection and successive approximation scans, end-of-band runs, restart intervals and any
sampling factors. ``encode_payload`` stores bytes losslessly as quantised coefficients (the
format's unit): one 8x8 block holds 64 bytes, each as a coefficient of magnitude
``256 + byte``, so that ``decode_coefficients`` gives them back whatever the colours clip to.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Position in an 8x8 block (row-major) of each coefficient in zigzag order.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p // 8 if (p // 8 + p % 8) % 2 else p % 8)))
_COS = np.array([[(math.sqrt(0.125) if u == 0 else 0.5) * math.cos((2 * x + 1) * u * math.pi / 16) for u in range(8)] for x in range(8)], np.float32)
#: Signs of the stored coefficients, by zigzag position, so that they don't add up at a corner.
_SIGN = np.where(np.arange(64) * 7 % 5 < 2, -1, 1).astype(np.int16)
_SIGN[0] = 1
_FLIP = np.where(_SIGN < 0, 255, 0).astype(np.uint8)
_LOW_BAND = 5
_BASE = 256


@dataclass
class Component:
    id: int
    h: int
    v: int
    quant: int
    blocks_wide: int = 0
    blocks_high: int = 0
    own_wide: int = 0
    own_high: int = 0
    coef: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int16))


@dataclass
class Image:
    width: int = 0
    height: int = 0
    components: list[Component] = field(default_factory=list)
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    comment: bytes = b""
    scans: int = 0


class _Huffman:
    """A table as lookups by length; ``single`` is the symbol of a table that has only one, of one bit."""

    def __init__(self, counts: bytes, symbols: bytes) -> None:
        self.codes: dict[tuple[int, int], int] = {}
        code = k = 0
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                self.codes[length, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        self.single = symbols[0] if len(symbols) == 1 and counts[0] == 1 else None
        lengths = {length for length, _ in self.codes}
        self.fixed = lengths.pop() if len(lengths) == 1 else None


class _Bits:
    """Bits of one entropy-coded segment, stuffing removed; reads past the end give zeros."""

    def __init__(self, data: bytes) -> None:
        self.raw = data.replace(b"\xff\x00", b"\xff")
        self.size = len(self.raw) * 8
        self.text = ""
        self.base = self.at = 0

    def _need(self, n: int) -> None:
        """Keep a window of bits as text, so that memory stays bounded for long segments."""
        while self.at + n > self.base + len(self.text):
            if self.at - self.base > 1 << 16:
                cut = self.at - self.base
                self.text, self.base = self.text[cut:], self.at
            start = (self.base + len(self.text)) // 8
            piece = self.raw[start : start + 4096] or b"\0" * 64
            self.text += f"{int.from_bytes(piece, 'big'):0{len(piece) * 8}b}"

    def get(self, n: int) -> int:
        if not n:
            return 0
        self._need(n)
        a = self.at - self.base
        self.at += n
        return int(self.text[a : a + n], 2)

    def symbol(self, table: _Huffman) -> int:
        if table.fixed:
            got = table.codes.get((table.fixed, self.get(table.fixed)))
            if got is None:
                raise ValueError("no such Huffman code")
            return got
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.get(1)
            if (length, code) in table.codes:
                return table.codes[length, code]
        raise ValueError("no such Huffman code")

    def extend(self, n: int) -> int:
        x = self.get(n)
        return x if not n or x >> (n - 1) else x - (1 << n) + 1

    def array(self, n: int) -> np.ndarray:
        """The next ``n`` bits as an array of zeros and ones."""
        first, end = self.at // 8, (self.at + n + 7) // 8
        bits = np.unpackbits(np.frombuffer(self.raw[first:end], np.uint8))[self.at % 8 :][:n]
        self.at += n
        self.text, self.base = "", self.at // 8 * 8
        return bits if len(bits) == n else np.concatenate((bits, np.zeros(n - len(bits), np.uint8)))


def decode_coefficients(data: bytes) -> Image:
    """Parse a progressive JPEG and accumulate its scans into coefficient arrays (zigzag order)."""
    img, at, restart = Image(), 2, 0
    huff: dict[tuple[int, int], _Huffman] = {}
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    while at < len(data):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        part = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            k = 0
            while k < len(part):
                wide, name = part[k] >> 4, part[k] & 15
                n = 128 if wide else 64
                img.quant[name] = np.frombuffer(part[k + 1 : k + 1 + n], ">u2" if wide else "u1").astype(np.float32)
                k += 1 + n
        elif marker == 0xC4:
            k = 0
            while k < len(part):
                counts = part[k + 1 : k + 17]
                huff[part[k] >> 4, part[k] & 15] = _Huffman(counts, part[k + 17 : k + 17 + sum(counts)])
                k += 17 + sum(counts)
        elif marker == 0xC2:
            _frame(img, part)
        elif 0xC0 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("only progressive Huffman frames are read")
        elif marker == 0xDD:
            restart = int.from_bytes(part[:2], "big")
        elif marker == 0xFE:
            img.comment += part
        elif marker == 0xDA:
            at = _scan(img, part, huff, restart, data, at)
    return img


def _frame(img: Image, part: bytes) -> None:
    if part[0] != 8:
        raise ValueError("only 8-bit samples are read")
    img.height, img.width = int.from_bytes(part[1:3], "big"), int.from_bytes(part[3:5], "big")
    img.components = [Component(part[k], part[k + 1] >> 4, part[k + 1] & 15, part[k + 2]) for k in range(6, 6 + 3 * part[5], 3)]
    top_h, top_v = max(c.h for c in img.components), max(c.v for c in img.components)
    wide, high = -(-img.width // (8 * top_h)), -(-img.height // (8 * top_v))
    for c in img.components:
        c.blocks_wide, c.blocks_high = wide * c.h, high * c.v
        c.own_wide = -(-(-(-img.width * c.h // top_h)) // 8)
        c.own_high = -(-(-(-img.height * c.v // top_v)) // 8)
        c.coef = np.zeros((c.blocks_wide * c.blocks_high, 64), np.int16)


def _segments(data: bytes, at: int) -> tuple[list[bytes], int]:
    """The entropy-coded segments from ``at`` to the next marker that isn't a restart."""
    out, begin, k = [], at, at
    while True:
        k = data.find(b"\xff", k)
        if k < 0 or k + 1 >= len(data):
            return [*out, data[begin:]], len(data)
        if data[k + 1] == 0:
            k += 2
        elif 0xD0 <= data[k + 1] <= 0xD7:
            out.append(data[begin:k])
            begin = k = k + 2
        else:
            return [*out, data[begin:k]], k


def _scan(img: Image, part: bytes, huff: dict, restart: int, data: bytes, at: int) -> int:
    n = part[0]
    by_id = {c.id: c for c in img.components}
    comps = [(by_id[part[1 + 2 * k]], part[2 + 2 * k]) for k in range(n)]
    first, last, high, low = part[1 + 2 * n], part[2 + 2 * n], part[3 + 2 * n] >> 4, part[3 + 2 * n] & 15
    pieces, end = _segments(data, at)
    img.scans += 1
    if n == 1:
        c = comps[0][0]
        rows = (np.arange(c.own_high)[:, None] * c.blocks_wide + np.arange(c.own_wide)[None, :]).ravel()
        units = [[(0, r)] for r in rows.tolist()] if first == 0 else None
    else:
        rows, units = None, _interleaved([c for c, _ in comps])
    total = len(rows) if units is None else len(units)
    step = restart or total or 1
    for k, raw in enumerate(pieces):
        bits, span = _Bits(raw), range(k * step, min(total, (k + 1) * step))
        if not span:
            break
        if first == 0:
            _dc(comps, [units[i] for i in span], bits, huff, high, low)
        else:
            _ac(comps[0][0].coef, rows[span.start : span.stop], bits, huff[1, comps[0][1] & 15], first, last, high, low)
    return end


def _interleaved(comps: list[Component]) -> list[list[tuple[int, int]]]:
    wide, high = comps[0].blocks_wide // comps[0].h, comps[0].blocks_high // comps[0].v
    out = []
    for y in range(high):
        for x in range(wide):
            out.append([(n, (y * c.v + dy) * c.blocks_wide + x * c.h + dx) for n, c in enumerate(comps) for dy in range(c.v) for dx in range(c.h)])
    return out


def _dc(comps: list, units: list, bits: _Bits, huff: dict, high: int, low: int) -> None:
    flat = [x for u in units for x in u]
    if high:
        got = bits.array(len(flat)).astype(np.int16) << low
        which, rows = np.array(flat).T
        for n, (c, _) in enumerate(comps):
            own = which == n
            c.coef[rows[own], 0] |= got[own]
        return
    tables = [huff[0, t >> 4] for _, t in comps]
    before = [0] * len(comps)
    values: list[list[int]] = [[] for _ in comps]
    places: list[list[int]] = [[] for _ in comps]
    for n, row in flat:
        before[n] += bits.extend(bits.symbol(tables[n]))
        values[n].append(before[n])
        places[n].append(row)
    for n, (c, _) in enumerate(comps):
        c.coef[places[n], 0] = np.array(values[n], np.int16) << low


def _span(rows: np.ndarray) -> np.ndarray | slice:
    """Rows that follow each other as a slice, which numpy reads without copies."""
    return slice(int(rows[0]), int(rows[-1]) + 1) if rows[-1] - rows[0] + 1 == len(rows) else rows


def _ac(coef: np.ndarray, rows: np.ndarray, bits: _Bits, table: _Huffman, first: int, last: int, high: int, low: int) -> None:
    if not high:
        band = last - first + 1
        if table.single is not None and table.single < 16 and table.single:
            # every coefficient has the one symbol "no zeros before, s bits": places of all bits are known
            s = table.single
            got = bits.array(len(rows) * band * (s + 1)).reshape(-1, s + 1)
            if s <= 8:
                value = (np.packbits(got[:, 1:], axis=1)[:, 0] >> (8 - s)).astype(np.int16)
            else:
                value = (got[:, 1:].astype(np.int16) @ (1 << np.arange(s - 1, -1, -1, dtype=np.int16))).astype(np.int16)
            value[got[:, 1] == 0] -= (1 << s) - 1
            coef[_span(rows), first : last + 1] = (value << low).reshape(-1, band)
            return
        run = 0
        for r in rows.tolist():
            if run:
                run -= 1
                continue
            k = first
            while k <= last:
                rs = bits.symbol(table)
                zeros, s = rs >> 4, rs & 15
                if s:
                    k += zeros
                    coef[r, k] = bits.extend(s) << low
                    k += 1
                elif zeros == 15:
                    k += 16
                else:
                    run = (1 << zeros) + bits.get(zeros) - 1
                    break
        return
    plus = 1 << low
    run, k = 0, 0
    while k < len(rows):
        if run:
            # in a run only coefficients that aren't zero have a bit each: corrected all at once
            n = min(run, len(rows) - k)
            span = _span(rows[k : k + n])
            block = coef[span, first : last + 1]
            if block.all():
                block = block + np.sign(block) * (bits.array(block.size).astype(np.int16) * plus).reshape(block.shape)
            else:
                at = np.nonzero(block)
                block[at] += (np.sign(block[at]) * (bits.array(len(at[0])).astype(np.int16) * plus)).astype(np.int16)
            coef[span, first : last + 1] = block
            k, run = k + n, 0
            continue
        r, z = int(rows[k]), first
        while z <= last:
            rs = bits.symbol(table)
            zeros, s = rs >> 4, rs & 15
            if not s and zeros < 15:
                run = (1 << zeros) + bits.get(zeros)
                break
            new = (plus if bits.get(1) else -plus) if s else 0
            while z <= last:
                if coef[r, z]:
                    if bits.get(1):
                        coef[r, z] += plus if coef[r, z] > 0 else -plus
                elif zeros:
                    zeros -= 1
                else:
                    break
                z += 1
            if new and z <= last:
                coef[r, z] = new
            z += 1
        if run:
            # the rest of this block is the first of the run
            block = coef[r, z : last + 1]
            at = np.flatnonzero(block)
            block[at] += (np.sign(block[at]) * (bits.array(len(at)).astype(np.int16) * plus)).astype(np.int16)
            run -= 1
        k += 1


def to_rgb(img: Image) -> np.ndarray:
    """The full-resolution tensor (height, width, 3) of an image, chroma upsampled by repetition."""
    planes = []
    top_h, top_v = max(c.h for c in img.components), max(c.v for c in img.components)
    for c in img.components:
        block = np.zeros((len(c.coef), 64), np.float32)
        block[:, ZIGZAG] = c.coef * img.quant[c.quant]
        block = _COS @ block.reshape(-1, 8, 8) @ _COS.T + 128
        plane = block.reshape(c.blocks_high, c.blocks_wide, 8, 8).transpose(0, 2, 1, 3).reshape(c.blocks_high * 8, c.blocks_wide * 8)
        if c.h != top_h or c.v != top_v:
            plane = np.repeat(np.repeat(plane, top_v // c.v, axis=0), top_h // c.h, axis=1)
        planes.append(plane[: img.height, : img.width])
    if len(planes) == 1:
        grey = np.clip(np.rint(planes[0]), 0, 255).astype(np.uint8)
        return np.repeat(grey[:, :, None], 3, axis=2)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.stack((y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb), axis=2)
    return np.clip(np.rint(rgb, out=rgb), 0, 255).astype(np.uint8)


def decode(data: bytes) -> np.ndarray:
    """RGB tensor of a progressive JPEG."""
    return to_rgb(decode_coefficients(data))


# -- storing bytes ----------------------------------------------------------------------


def _marker(code: int, part: bytes) -> bytes:
    return bytes((0xFF, code)) + (len(part) + 2).to_bytes(2, "big") + part


def _pad(bits: np.ndarray) -> bytes:
    """Bits as stuffed bytes, filled up with ones."""
    rest = -len(bits) % 8
    return np.packbits(np.concatenate((bits, np.ones(rest, np.uint8))) if rest else bits).tobytes().replace(b"\xff", b"\xff\x00")


def _number_bits(x: int, n: int) -> list[int]:
    return [x >> k & 1 for k in range(n - 1, -1, -1)]


_DC_TABLE = b"\x00" + bytes((0, 0, 0, 9)) + bytes(12) + bytes(range(9))
_ONE_TABLE = b"\x10" + bytes((1,)) + bytes(15) + bytes((8,))
_RUN_TABLE = b"\x11" + bytes((0, 0, 0, 15)) + bytes(12) + bytes(k << 4 for k in range(15))
_MCU = 6
_MAX_WIDE = 4095


def encode_payload(payload: bytes, length: int) -> bytes:
    """A progressive 4:2:0 JPEG whose coefficients are the payload, a positive multiple of 64 bytes.

    ``length`` (the bytes before padding) and the number of blocks go into a comment.
    Scans: DC without its last bit, two AC bands without their last bits, then the last
    bits of AC and of DC.
    """
    n = len(payload) // 64
    units = -(-n // _MCU)
    wide = min(_MAX_WIDE, max(1, math.isqrt(units)))
    high = -(-units // wide)
    if high > _MAX_WIDE:
        raise ValueError("more than one image can hold")
    blocks = np.zeros((wide * high * _MCU, 64), np.uint8)
    blocks[:n] = np.frombuffer(payload, np.uint8).reshape(n, 64)
    cells = blocks.reshape(high, wide, _MCU, 64)
    luma = cells[:, :, :4].reshape(high, wide, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64)
    planes = [luma, cells[:, :, 4].reshape(-1, 64), cells[:, :, 5].reshape(-1, 64)]

    out = [b"\xff\xd8", _marker(0xFE, b"%d %d" % (length, n)), _marker(0xDB, b"\x00" + b"\x01" * 64)]
    frame = b"\x08" + (high * 16).to_bytes(2, "big") + (wide * 16).to_bytes(2, "big") + b"\x03" + bytes((1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0))
    out += [_marker(0xC2, frame), _marker(0xC4, _DC_TABLE + _ONE_TABLE + _RUN_TABLE)]
    tail = lambda comps, a, b, hl: _marker(0xDA, bytes((len(comps), *(x for c in comps for x in c), a, b, hl)))

    # DC: half of 256 + byte, as differences within each component, in order of the cells
    half = (cells[:, :, :, 0].reshape(-1, _MCU).astype(np.int32) + _BASE) >> 1
    y = half[:, :4].ravel()
    diff = np.empty_like(half)
    first = y.copy()
    first[1:] -= y[:-1]
    diff[:, :4] = first.reshape(-1, 4)
    diff[:, 4:] = half[:, 4:]
    diff[1:, 4:] -= half[:-1, 4:]
    diff = diff.ravel()
    size = np.frexp(np.abs(diff).astype(np.float64))[1].astype(np.int64)
    code = (size << 8 | np.where(diff < 0, diff + (1 << size) - 1, diff)).astype(np.int64)
    lens = size + 4
    # each difference is 4 bits of size and `size` bits of value: lay all bits out at once
    spots = np.concatenate(([0], np.cumsum(lens)))
    of = np.repeat(np.arange(len(lens)), lens)
    back = (lens[of] - 1) - (np.arange(spots[-1]) - spots[of])
    word = (code >> 8 << size) | (code & 255)
    out += [tail([(1, 0), (2, 0), (3, 0)], 0, 0, 0x01), _pad((word[of] >> back & 1).astype(np.uint8))]

    for a, b in ((1, _LOW_BAND), (_LOW_BAND + 1, 63)):
        for cid, p in enumerate(planes, 1):
            # a negative value has the complement of its bits
            value = ((p[:, a : b + 1] >> 1 | 0x80) ^ _FLIP[a : b + 1]).ravel()
            bits = np.zeros((len(value), 9), np.uint8)
            bits[:, 1:] = np.unpackbits(value).reshape(-1, 8)
            out += [tail([(cid, 0)], a, b, 0x01), _pad(bits.ravel())]
    for cid, p in enumerate(planes, 1):
        last, k, bits = p[:, 1:] & 1, 0, []
        while k < len(p):
            power = min(14, (len(p) - k).bit_length() - 1)
            run = min(len(p) - k, (2 << power) - 1)
            bits += [np.array(_number_bits(power, 4) + _number_bits(run - (1 << power), power), np.uint8), last[k : k + run].ravel()]
            k += run
        out += [tail([(cid, 1)], 1, 63, 0x10), _pad(np.concatenate(bits))]
    out += [tail([(1, 0), (2, 0), (3, 0)], 0, 0, 0x10), _pad(cells[:, :, :, 0].ravel() & 1), b"\xff\xd9"]
    return b"".join(out)


def read_payload(img: Image) -> bytes:
    """The payload of a decoded image that ``encode_payload`` made."""
    n = int(img.comment.split()[1])
    y, cb, cr = (c.coef for c in img.components)
    wide, high = img.components[1].blocks_wide, img.components[1].blocks_high
    cells = np.empty((high, wide, _MCU, 64), np.int16)
    cells[:, :, :4] = y.reshape(high, 2, wide, 2, 64).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, 64)
    cells[:, :, 4], cells[:, :, 5] = cb.reshape(high, wide, 64), cr.reshape(high, wide, 64)
    return (np.abs(cells.reshape(-1, 64)[:n]) - _BASE).astype(np.uint8).tobytes()


def payload_of(text: str | None) -> tuple[bytes, int]:
    """A text as UTF-8, filled up with zero bytes to a positive multiple of 64, and its length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw)), len(raw)


def feature_of(rgb: np.ndarray) -> str:
    """Height and width, the mean of each channel, and a 64-bit mean hash of an 8x8 reduction of the green channel."""
    means = rgb.reshape(-1, 3).mean(axis=0, dtype=np.float64)
    h, w = rgb.shape[0] // 8 * 8, rgb.shape[1] // 8 * 8
    small = rgb[:h, :w, 1].reshape(8, h // 8, 8, w // 8).mean(axis=(1, 3), dtype=np.float64)
    bits = np.packbits(small > small.mean()).tobytes().hex()
    return f"{rgb.shape[0]}x{rgb.shape[1]}:{means[0]:.3f},{means[1]:.3f},{means[2]:.3f}:{bits}"


#: Rows go back to Spark once their tensors hold about so many bytes.
_BATCH_BYTES = 8 << 20


def stored_row(text: str | None) -> tuple:
    """What ``store`` gives for one text, but for its doc_id."""
    payload, n = payload_of(text)
    media = encode_payload(payload, n)
    img = decode_coefficients(media)
    back, rgb = read_payload(img), to_rgb(img)
    digests = (hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(rgb))
    return (int(img.comment.split()[0]), len(back), *digests, media, rgb.shape[0], rgb.shape[1], rgb.tobytes())


def store(docs: DataFrame, text: str = "text") -> DataFrame:
    """Store each text as a progressive JPEG and read it back.

    Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature, media (the file), height, width and rgb (the full-resolution
    tensor's bytes, row by row). Everything but the media columns is taken from
    the decoded file. Null and empty texts are 64 zero bytes. Repeated rows give repeated
    rows, an empty table an empty result; other columns are ignored. Texts of any length are
    stored whole; rows leave a task in batches of bounded size, so that long ones don't pile up.
    """
    own = docs.select("doc_id", F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, kind = [], 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows.append((doc_id, *stored_row(t)))
                held += len(rows[-1][-1])
                if held > _BATCH_BYTES:
                    yield _stored_batch(rows, kind)
                    rows, held = [], 0
        if rows:
            yield _stored_batch(rows, kind)

    kinds = ", ".join(f"{name} {spark}" for name, (spark, _) in _STORED.items())
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, {kinds}")


#: Columns of ``store`` after doc_id, with their types in Spark and in Arrow.
_STORED = {
    "n_bytes": ("long", pa.int64()), "payload_bytes": ("long", pa.int64()), "payload_sha256": ("string", pa.string()), "tail_crc32": ("long", pa.int64()),
    "media_bytes": ("long", pa.int64()), "media_sha256": ("string", pa.string()), "feature": ("string", pa.string()),
    "media": ("binary", pa.binary()), "height": ("int", pa.int32()), "width": ("int", pa.int32()), "rgb": ("binary", pa.binary()),
}


def _stored_batch(rows: list[tuple], doc_id: pa.DataType) -> pa.RecordBatch:
    kinds = [doc_id, *(arrow for _, arrow in _STORED.values())]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", *_STORED])
