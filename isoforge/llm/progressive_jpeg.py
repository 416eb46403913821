"""Progressive JPEG: coefficient arrays built up over scans, and RGB tensors from them.

``encode_coefficients`` writes quantised coefficients as a progressive JPEG: DC, then two
bands of AC coefficients (spectral selection) without their lowest bit, then a refining scan
for that bit (successive approximation). ``decode`` reads any progressive or sequential
Huffman JPEG of 8 bits: each scan adds to the arrays. Scans whose Huffman table
makes every coefficient equally wide are read with numpy table look-ups; all others bit by bit.

A payload is stored without loss in the format's own unit: byte ``b`` is coefficient ``b + 2``
(never zero, also without its lowest bit), 384 bytes are a unit of four blocks of brightness and one of
each colour, which has half the rows and columns. UTF-8 never holds bytes beyond 0xF4, so
coefficients stay within 246.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import per_text, save, table

BLOCK_BYTES = 192
_SHIFT = 2
#: Blocks across and down of each component in a unit.
SAMPLING = ((2, 2), (1, 1), (1, 1))
UNIT_BLOCKS = sum(h * v for h, v in SAMPLING)
#: Rows of units in one column, so that the height fits in 16 bits.
_TALLEST = 4095
#: The bands of AC coefficients that are sent one after the other.
BANDS = ((1, 5), (6, 63))


@lru_cache(1)
def zigzag() -> np.ndarray:
    """Row-major place of each coefficient in zigzag order."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


@lru_cache(1)
def cosines() -> np.ndarray:
    """Inverse transform of one dimension: samples = cosines @ coefficients."""
    x, u = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    return np.cos((2 * x + 1) * u * np.pi / 16) / 2 * np.where(u == 0, np.sqrt(0.5), 1)


# Huffman tables: counts of codes by length 1 to 16, and symbols in order.
#: A size of s bits has a code of 9 - s bits, so that any DC difference takes 9 bits.
DC_TABLE = ([1] * 9 + [0] * 7, [*range(8, -1, -1)])
#: A size of s bits has a code of 8 - s bits, so that any AC coefficient takes a byte.
AC_TABLE = ([1] * 7 + [0] * 9, [*range(7, 0, -1)])
#: Only runs of ended blocks.
END_TABLE = ([0, 0, 0, 15] + [0] * 12, [16 * r for r in range(15)])


def _sized(width: int, least: int, most: int) -> np.ndarray:
    """Word of ``width`` bits for each value from ``least`` to ``most``: ones, a zero, then the value's bits."""
    out = []
    for v in range(least, most + 1):
        s = abs(v).bit_length()
        ones = width - 1 - s
        code = ((1 << ones) - 1) << 1
        out.append(code << s | (v if v >= 0 else v + (1 << s) - 1))
    return np.array(out)


_DC_WORDS = _sized(9, -255, 255)
_AC_WORDS = _sized(8, 0, 127).astype(np.uint8)
_DC_VALUES = np.zeros(512, np.int32)
_DC_VALUES[_DC_WORDS] = np.arange(-255, 256)
_AC_VALUES = np.zeros(256, np.int32)
for _v in range(-127, 128):
    if _v:
        _AC_VALUES[_sized(8, _v, _v)[0]] = _v


def _stuffed(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes: filled up with ones, a zero byte after each 0xFF."""
    pad = -len(bits) % 8
    return np.packbits(np.concatenate((bits, np.ones(pad, np.uint8)))).tobytes().replace(b"\xff", b"\xff\x00")


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    return ((values[:, None] >> np.arange(width - 1, -1, -1)) & 1).astype(np.uint8).ravel()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, slot: int, table: tuple[list[int], list[int]]) -> bytes:
    return _segment(0xC4, bytes([kind << 4 | slot, *table[0], *table[1]]))


def _scan(components: list[int], first: int, last: int, high: int, low: int, slot: int, body: bytes) -> bytes:
    own = b"".join(bytes([c + 1, slot]) for c in components)
    return _segment(0xDA, bytes([len(components)]) + own + bytes([first, last, high << 4 | low])) + body


def unit_order(rows: int, columns: int, h: int, v: int) -> np.ndarray:
    """Numbers, row by row, of a component's blocks in the order of interleaved units."""
    return np.arange(rows * columns).reshape(rows // v, v, columns // h, h).transpose(0, 2, 1, 3).reshape(-1, h * v)


def encode_coefficients(planes: list[np.ndarray], sampling=SAMPLING, comment: bytes = b"") -> bytes:
    """Of arrays (rows, columns, 64) in zigzag order, values 2 to 255, one for each component."""
    down, across = max(v for _, v in sampling), max(h for h, _ in sampling)
    height, width = 8 * planes[0].shape[0] // sampling[0][1] * down, 8 * planes[0].shape[1] // sampling[0][0] * across
    out = [b"\xff\xd8", _segment(0xFE, comment), _segment(0xDB, bytes([0]) + bytes([1] * 64))]
    frame = b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(sampling))
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, height, width, len(planes)) + frame))
    out += [_huffman(0, 0, DC_TABLE), _huffman(1, 0, AC_TABLE), _huffman(1, 1, END_TABLE)]
    orders = [unit_order(*p.shape[:2], *s) for p, s in zip(planes, sampling, strict=True)]
    flat = [p.reshape(-1, 64) for p in planes]
    halves, every = [p >> 1 for p in flat], [*range(len(planes))]
    steps = [np.diff(p[o.ravel(), 0], prepend=0).reshape(o.shape) for p, o in zip(halves, orders, strict=True)]
    out.append(_scan(every, 0, 0, 0, 1, 0x00, _stuffed(_bits(_DC_WORDS[np.concatenate(steps, 1).ravel() + 255], 9))))
    for a, b in BANDS:
        for c, half in enumerate(halves):
            out.append(_scan([c], a, b, 0, 1, 0x00, _AC_WORDS[half[:, a : b + 1]].tobytes()))
    low = [(p & 1).astype(np.uint8) for p in flat]
    out.append(_scan(every, 0, 0, 1, 0, 0x00, _stuffed(np.concatenate([p[o, 0] for p, o in zip(low, orders, strict=True)], 1).ravel())))
    for c, own in enumerate(low):
        bits = []
        for a in range(0, len(own), 32767):
            run = min(len(own) - a, 32767)
            r = run.bit_length() - 1
            bits += [_bits(np.array([r]), 4), _bits(np.array([run - (1 << r)]), r), own[a : a + run, 1:].ravel()]
        out.append(_scan([c], 1, 63, 1, 0, 0x01, _stuffed(np.concatenate(bits))))
    return b"".join([*out, b"\xff\xd9"])


class _Bits:
    """Bits of one entropy-coded segment, with look-up of Huffman codes."""

    def __init__(self, body: bytes):
        self.all = np.unpackbits(np.frombuffer(body.replace(b"\xff\x00", b"\xff"), np.uint8))
        self.at = 0

    def take(self, n: int) -> int:
        part = self.all[self.at : self.at + n]
        self.at += n
        return int("".join(map(str, part.tolist())) or "0", 2)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | int(self.all[self.at])
            self.at += 1
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such Huffman code")

    def signed(self, size: int) -> int:
        v = self.take(size)
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _codes(table: tuple[list[int], list[int]]) -> dict[tuple[int, int], int]:
    out, code, k = {}, 0, 0
    for length, count in enumerate(table[0], 1):
        for _ in range(count):
            out[length, code] = table[1][k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


class Picture:
    """Coefficient arrays of a picture as its scans come in."""

    def __init__(self):
        self.tables: dict[int, tuple[list[int], list[int]]] = {}
        self.quant: dict[int, np.ndarray] = {}
        self.comment, self.restart = b"", 0

    def frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        own = [body[6 + 3 * i : 9 + 3 * i] for i in range(n)]
        self.ids, self.h, self.v, self.tq = [x[0] for x in own], [x[1] >> 4 for x in own], [x[1] & 15 for x in own], [x[2] for x in own]
        self.mcus = -(-self.width // (8 * max(self.h))), -(-self.height // (8 * max(self.v)))
        self.coefficients = [np.zeros((self.mcus[1] * v, self.mcus[0] * h, 64), np.int32) for h, v in zip(self.h, self.v, strict=True)]

    def _places(self, own: list[int]) -> list[list[tuple[int, int, int]]]:
        """Component, row and column of the blocks of each unit of a scan."""
        if len(own) == 1:
            c = own[0]
            wide = -(-(-(-self.width * self.h[c] // max(self.h))) // 8)
            tall = -(-(-(-self.height * self.v[c] // max(self.v))) // 8)
            return [[(c, y, x)] for y in range(tall) for x in range(wide)]
        return [
            [(c, my * self.v[c] + j, mx * self.h[c] + i) for c in own for j in range(self.v[c]) for i in range(self.h[c])]
            for my in range(self.mcus[1]) for mx in range(self.mcus[0])
        ]

    def scan(self, header: bytes, body: bytes) -> None:
        n = header[0]
        own = [self.ids.index(header[1 + 2 * i]) for i in range(n)]
        slots = [header[2 + 2 * i] for i in range(n)]
        first, last, high, low = header[1 + 2 * n], header[2 + 2 * n], header[3 + 2 * n] >> 4, header[3 + 2 * n] & 15
        if not self._wide_scan(own, slots, first, last, high, low, body):
            self._bit_scan(own, slots, first, last, high, low, body)

    def _wide_scan(self, own, slots, first, last, high, low, body) -> bool:
        """Scans of equally wide coefficients, without restarts, of whole units; False if this is none."""
        whole = self.width % (8 * max(self.h)) == self.height % (8 * max(self.v)) == 0
        if self.restart or not whole or first == 0 and (last or own != [*range(len(self.ids))] or len(own) == 1):
            return False
        flat = [c.reshape(-1, 64) for c in self.coefficients]
        n = len(flat[own[0]])
        if first == 0:
            orders = [unit_order(*c.shape[:2], h, v) for c, h, v in zip(self.coefficients, self.h, self.v, strict=True)]
            edges = np.cumsum([0, *(o.shape[1] for o in orders)])
            count = len(orders[0]) * int(edges[-1])
            if not high and any(self.tables.get(s >> 4) != DC_TABLE for s in slots):
                return False
            bits = np.unpackbits(np.frombuffer(body.replace(b"\xff\x00", b"\xff"), np.uint8), count=count * (1 if high else 9))
            values = bits.astype(np.int32) if high else _DC_VALUES[bits.reshape(-1, 9) @ (1 << np.arange(8, -1, -1))]
            for c, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                part, order = values.reshape(len(orders[0]), -1)[:, a:b].ravel(), orders[c].ravel()
                if high:
                    flat[c][order, 0] |= part << low
                else:
                    flat[c][order, 0] = np.cumsum(part) << low
        elif high == 0:
            if self.tables.get(16 | slots[0] & 15) != AC_TABLE:
                return False
            words = np.frombuffer(body.replace(b"\xff\x00", b"\xff"), np.uint8).reshape(n, -1)
            flat[own[0]][:, first : last + 1] = _AC_VALUES[words] << low
        else:
            if self.tables.get(16 | slots[0] & 15) != END_TABLE:
                return False
            bits, at, done = np.unpackbits(np.frombuffer(body.replace(b"\xff\x00", b"\xff"), np.uint8)), 0, 0
            while done < n:
                r = int(bits[at : at + 4] @ (8, 4, 2, 1))
                run = (1 << r) + int(bits[at + 4 : at + 4 + r] @ (1 << np.arange(r - 1, -1, -1)))
                at += 4 + r
                part = flat[own[0]][done : done + run, first : last + 1]
                there = part != 0
                count = int(there.sum())
                part[there] += np.sign(part[there]) * (bits[at : at + count].astype(np.int32) << low)
                at, done = at + count, done + run
        return True

    def _bit_scan(self, own, slots, first, last, high, low, body) -> None:
        segments = [body]
        if self.restart:
            segments, begin = [], 0
            for i in range(len(body) - 1):
                if body[i] == 0xFF and 0xD0 <= body[i + 1] <= 0xD7:
                    segments.append(body[begin:i])
                    begin = i + 2
            segments.append(body[begin:])
        codes = {k: _codes(t) for k, t in self.tables.items()}
        slot_of = dict(zip(own, slots, strict=True))
        units = self._places(own)
        size = self.restart or len(units)
        for s, segment in enumerate(segments):
            bits, before, ended = _Bits(segment), dict.fromkeys(own, 0), 0
            for unit in units[s * size : (s + 1) * size]:
                for c, y, x in unit:
                    block = self.coefficients[c][y, x]
                    if first == 0 and high:
                        block[0] |= bits.take(1) << low
                    elif first == 0:
                        before[c] += bits.signed(bits.symbol(codes[slot_of[c] >> 4]))
                        block[0] = before[c] << low
                    if last:
                        ac, from_ = codes.get(16 | slot_of[c] & 15), max(first, 1)
                        ended = self._refine(bits, block, ac, from_, last, low, ended) if high else self._new(bits, block, ac, from_, last, low, ended)

    @staticmethod
    def _new(bits, block, codes, k, last, low, ended) -> int:
        if ended:
            return ended - 1
        while k <= last:
            run, size = divmod(bits.symbol(codes), 16)
            if size:
                k += run
                block[k] = bits.signed(size) * (1 << low)
            elif run == 15:
                k += 15
            else:
                return (1 << run) + bits.take(run) - 1
            k += 1
        return 0

    @staticmethod
    def _refine(bits, block, codes, k, last, low, ended) -> int:
        def correct(i):
            if bits.take(1):
                block[i] += (1 << low) if block[i] > 0 else -(1 << low)

        while k <= last and not ended:
            run, size = divmod(bits.symbol(codes), 16)
            if not size and run < 15:
                ended = (1 << run) + bits.take(run)
                break
            new = bits.signed(1) * (1 << low) if size else 0
            while k <= last:
                if block[k]:
                    correct(k)
                elif run:
                    run -= 1
                else:
                    block[k] = new
                    k += 1
                    break
                k += 1
        if ended:
            for i in range(k, last + 1):
                if block[i]:
                    correct(i)
            return ended - 1
        return 0

    def rgb(self) -> np.ndarray:
        """Full-resolution tensor (height, width, 3): inverse transform, chroma upsampled, colours."""
        planes = []
        for c, own in enumerate(self.coefficients):
            q = self.quant[self.tq[c]]
            square = np.zeros(own.shape)
            square[..., zigzag()] = own * q
            square = cosines() @ square.reshape(*own.shape[:2], 8, 8) @ cosines().T
            plane = square.transpose(0, 2, 1, 3).reshape(8 * own.shape[0], 8 * own.shape[1]) + 128
            plane = plane.repeat(max(self.v) // self.v[c], 0).repeat(max(self.h) // self.h[c], 1)
            planes.append(plane[: self.height, : self.width])
        if len(planes) == 1:
            planes = [planes[0], np.full_like(planes[0], 128), np.full_like(planes[0], 128)]
        y, b, r = planes[0], planes[1] - 128, planes[2] - 128
        colours = np.stack((y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b), -1)
        return np.clip(np.floor(colours + 0.5), 0, 255).astype(np.uint8)


def decode(jpeg: bytes) -> Picture:
    out, at = Picture(), 2
    while at < len(jpeg):
        marker = jpeg[at + 1]
        if marker == 0xD9:
            break
        size = struct.unpack(">H", jpeg[at + 2 : at + 4])[0]
        body, at = jpeg[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xFE:
            out.comment = body
        elif marker == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                out.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                counts = [*body[1:17]]
                out.tables[body[0]] = counts, [*body[17 : 17 + sum(counts)]]
                body = body[17 + sum(counts) :]
        elif marker in (0xC0, 0xC1, 0xC2):
            out.frame(body)
        elif marker == 0xDD:
            out.restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            end = jpeg.find(b"\xff", at)
            while jpeg[end + 1] == 0 or 0xD0 <= jpeg[end + 1] <= 0xD7:
                end = jpeg.find(b"\xff", end + 2)
            out.scan(body, jpeg[at:end])
            at = end
    return out


def store(payload: bytes) -> bytes:
    """The progressive JPEG of a payload: a positive multiple of 192 bytes, none beyond 253."""
    n = -(-len(payload) // (64 * UNIT_BLOCKS))
    columns = -(-n // _TALLEST)
    rows = -(-n // columns)
    units = np.frombuffer(payload.ljust(rows * columns * 64 * UNIT_BLOCKS, b"\0"), np.uint8).reshape(rows, columns, UNIT_BLOCKS, 64).astype(np.int32) + _SHIFT
    planes, first = [], 0
    for h, v in SAMPLING:
        own = units[:, :, first : first + h * v].reshape(rows, columns, v, h, 64)
        planes.append(own.transpose(0, 2, 1, 3, 4).reshape(rows * v, columns * h, 64))
        first += h * v
    return encode_coefficients(planes, SAMPLING, str(len(payload)).encode())


def load(picture: Picture) -> bytes:
    units = [c.reshape(-1, 64)[unit_order(*c.shape[:2], h, v)] for c, h, v in zip(picture.coefficients, picture.h, picture.v, strict=True)]
    return (np.concatenate(units, 1) - _SHIFT).astype(np.uint8).tobytes()[: int(picture.comment)]


def padded(text: bytes) -> bytes:
    return text.ljust(max(BLOCK_BYTES, -(-len(text) // BLOCK_BYTES) * BLOCK_BYTES), b" ")


def feature_of(tensor: np.ndarray) -> str:
    """Height, width, and the sums and sums of squares of red, green and blue: whole numbers."""
    flat = tensor.reshape(-1, 3).astype(np.int64)
    return f"{tensor.shape[0]}x{tensor.shape[1]};{','.join(map(str, flat.sum(0).tolist()))};{','.join(map(str, (flat**2).sum(0).tolist()))}"


PAYLOAD = "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"


def store_texts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_bytes`` and the stored ``media`` of each whole text.

    Null counts as empty; an empty text is one block of spaces. Equal texts have equal media.
    """

    def columns(texts):
        return [pa.array(list(map(len, texts)), pa.int64()), pa.array([store(padded(t)) for t in texts], pa.binary())]

    return per_text(docs, keep, text, "n_bytes long, media binary", columns)


def decode_media(stored: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The full-resolution RGB ``tensor`` (rows of red, green and blue bytes) and ``shape`` of stored pictures; null stays null."""

    def columns(pictures):
        found = [decode(p).rgb() if p else None for p in pictures]
        return [pa.array([None if t is None else t.tobytes() for t in found], pa.binary()), pa.array([None if t is None else [*t.shape] for t in found], pa.list_(pa.int32()))]

    return per_text(stored, keep, media, "tensor binary, shape array<int>", columns)


def read_payloads(stored: DataFrame, media: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Digests of the payloads read back from stored pictures, and the features of their tensors."""

    def columns(pictures):
        rows = []
        for own in map(decode, pictures):
            back = load(own)
            rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), feature_of(own.rgb())))
        return list(zip(*rows, strict=True))

    return per_text(stored, keep, media, PAYLOAD, columns)


def op9_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = save(spark, store_texts(table(spark, sf_dir, "documents")), "media", "zstd")
    own = stored.withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    return read_payloads(own, "media", ("doc_id", "n_bytes", "media_bytes", "media_sha256"))
