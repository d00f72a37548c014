"""FLAC sound: files cut into frames at their sync codes, frames decoded each in its own row, and files written.

A frame begins with a sync code and a header that ends in its own check byte, and holds
its number; it needs nothing from other frames. So a long recording is many rows, and
rows of one recording are decoded by many tasks. The format is that of RFC 9639: constant,
verbatim, fixed and linear-prediction subframes, Rice-coded residuals, joint stereo.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parkwright.sources.shared import slices

MAGIC, SYNCS = b"fLaC", (b"\xff\xf8", b"\xff\xf9")
#: Sample sizes and rates by their codes in a frame header.
SIZES = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}
RATES = {1: 88200, 2: 176400, 3: 192000, 4: 8000, 5: 16000, 6: 22050, 7: 24000, 8: 32000, 9: 44100, 10: 48000, 11: 96000}
LEFT_SIDE, SIDE_RIGHT, MID_SIDE = 8, 9, 10
#: Recordings or frames whose samples or bytes a worker holds at once.
CLIPS = 64


def _table(polynomial: int, width: int) -> list[int]:
    """What a byte does to a check sum of ``width`` bits."""
    top, mask = 1 << (width - 1), (1 << width) - 1
    step = lambda c, _: (c << 1 ^ polynomial if c & top else c << 1) & mask
    return [reduce(step, range(8), byte << (width - 8)) for byte in range(256)]


_CRC8, _CRC16 = _table(0x07, 8), _table(0x8005, 16)


def crc8(data: bytes) -> int:
    return reduce(lambda c, b: _CRC8[c ^ b], data, 0)


def crc16(data: bytes) -> int:
    c = 0
    for b in data:
        c = (c << 8 & 0xFF00) ^ _CRC16[c >> 8 ^ b]
    return c


def stream_info(data: bytes) -> tuple[dict[str, int], int]:
    """The rate, channels, bits and samples of a file, and where its frames begin."""
    if data[:4] != MAGIC:
        raise ValueError("not FLAC bytes")
    at, info, last = 4, None, False
    while not last:
        if at + 4 > len(data):
            raise ValueError("FLAC bytes without frames")
        last, kind, size = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        if kind == 0:
            packed = int.from_bytes(data[at + 14 : at + 22], "big")
            info = {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1}
            info["block"] = int.from_bytes(data[at + 4 : at + 6], "big")
        at += 4 + size
    if info is None:
        raise ValueError("FLAC bytes without a description")
    return info, at


def frame_header(data: bytes, at: int) -> dict[str, int] | None:
    """The header of the frame at ``at``; None if there is none."""
    if data[at : at + 2] not in SYNCS or len(data) < at + 6:
        return None
    block, rate, channels, size = data[at + 2] >> 4, data[at + 2] & 15, data[at + 3] >> 4, data[at + 3] >> 1 & 7
    if not block or rate == 15 or channels > MID_SIDE or size == 3 or data[at + 3] & 1:
        return None
    # a number in as many bytes as the first has leading ones
    first, end = data[at + 4], at + 5
    ones = 8 - (first ^ 0xFF).bit_length()
    if ones in (1, 8):
        return None
    number = first & (0x7F >> ones)
    for byte in data[end : end + max(ones - 1, 0)]:
        number, end = number << 6 | byte & 63, end + 1
    extra = {6: 1, 7: 2}.get(block, 0)
    samples = int.from_bytes(data[end : end + extra], "big") + 1 if extra else 192 if block == 1 else 576 << (block - 2) if block < 6 else 256 << (block - 8)
    end += extra
    given = {12: 1, 13: 2, 14: 2}.get(rate, 0)
    hertz = int.from_bytes(data[end : end + given], "big") * {12: 1000, 14: 10}.get(rate, 1) if given else RATES.get(rate, 0)
    end += given
    if end >= len(data) or crc8(data[at:end]) != data[end]:
        return None
    return {"number": number, "variable": data[at + 1] & 1, "samples": samples, "rate": hertz, "channels": channels, "bits": SIZES.get(size, 0), "body": end + 1}


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(first sample, bytes) of each frame of a file: sync codes whose header holds and has the number that is due."""
    info, start = stream_info(data)
    due, first, begun, sync = 0, 0, None, None
    for at in _syncs(data, start):
        header = frame_header(data, at)
        if header is None or header["number"] != (first if header["variable"] else due) or (sync is not None and data[at : at + 2] != sync):
            continue
        if begun is not None:
            yield begun[0], data[begun[1] : at]
        begun, sync, due, first = (first, at), data[at : at + 2], due + 1, first + header["samples"]
    if begun is not None:
        yield begun[0], data[begun[1] :]
    if info["samples"] and first != info["samples"]:
        raise ValueError(f"{first} of {info['samples']} samples")


def _syncs(data: bytes, start: int) -> Iterator[int]:
    at = data.find(b"\xff", start)
    while at >= 0:
        if data[at : at + 2] in SYNCS:
            yield at
        at = data.find(b"\xff", at + 1)


class _Bits:
    """Numbers from the bits of a frame."""

    def __init__(self, data: bytes):
        self.bits, self.at = np.unpackbits(np.frombuffer(data, np.uint8)), 0
        places = np.where(self.bits, np.arange(len(self.bits)), len(self.bits))
        # of each place the next one
        self.next = np.minimum.accumulate(places[::-1])[::-1].tolist()

    def take(self, n: int) -> int:
        if self.at + n > len(self.bits):
            raise ValueError("a frame ends early")
        out = int("".join(map(str, self.bits[self.at : self.at + n])) or "0", 2)
        self.at += n
        return out

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def many(self, count: int, n: int) -> np.ndarray:
        """``count`` signed numbers of ``n`` bits."""
        rows = self.bits[self.at : self.at + count * n].reshape(count, n).astype(np.int64)
        self.at += count * n
        return rows @ np.r_[-(1 << (n - 1)), 1 << np.arange(n - 2, -1, -1)] if n else np.zeros(count, np.int64)

    def unary(self) -> int:
        end = self.next[self.at]
        n, self.at = end - self.at, end + 1
        return n

    def rice(self, count: int, k: int) -> np.ndarray:
        """``count`` numbers: a quotient in unary and ``k`` bits each, the sign in the last."""
        ends, at, following = [], self.at, self.next
        for _ in range(count):
            at = following[at]
            ends.append(at)
            at += 1 + k
        ends = np.array(ends, np.int64)
        quotients = ends - np.r_[self.at, ends[:-1] + 1 + k][:count]
        rest = self.bits[ends[:, None] + 1 + np.arange(k)].astype(np.int64) @ (1 << np.arange(k - 1, -1, -1)) if k and count else 0
        self.at, value = at, quotients << k | rest
        return value >> 1 ^ -(value & 1)


def _residual(bits: _Bits, n: int, order: int) -> np.ndarray:
    method, parts = bits.take(2), bits.take(4)
    if method > 1:
        raise ValueError("a residual of an unknown kind")
    width, out = 4 + method, []
    for part in range(1 << parts):
        count, k = (n >> parts) - (0 if part else order), bits.take(width)
        if k == (1 << width) - 1:
            raw = bits.take(5)
            out.append(bits.many(count, raw) if raw else np.zeros(count, np.int64))
        else:
            out.append(bits.rice(count, k))
    return np.concatenate(out)


def _undone(first: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """A sequence from its first numbers and its differences of that order."""
    for order in range(len(first), 0, -1):
        # the last difference of one order less that the first numbers have
        last = np.diff(first, order - 1)[-1]
        residual = last + np.cumsum(residual)
    return np.r_[first, residual]


def _predicted(first: list[int], residual: list[int], factors: list[int], shift: int) -> np.ndarray:
    out, order, backwards = list(first), len(factors), factors[::-1]
    for e in residual:
        out.append(e + (sum(map(mul, backwards, out[-order:])) >> shift))
    return np.array(out, np.int64)


def _subframe(bits: _Bits, n: int, size: int) -> np.ndarray:
    if bits.take(1):
        raise ValueError("a subframe that is none")
    kind, wasted = bits.take(6), 0
    if bits.take(1):
        wasted = bits.unary() + 1
        size -= wasted
    if kind == 0:
        out = np.full(n, bits.signed(size), np.int64)
    elif kind == 1:
        out = bits.many(n, size)
    elif 8 <= kind <= 12:
        first = bits.many(kind - 8, size)
        out = _undone(first, _residual(bits, n, kind - 8))
    elif kind >= 32:
        order = kind - 31
        first, precision, shift = bits.many(order, size).tolist(), bits.take(4) + 1, bits.signed(5)
        factors = bits.many(order, precision).tolist()
        out = _predicted(first, _residual(bits, n, order).tolist(), factors, shift)
    else:
        raise ValueError("a subframe of an unknown kind")
    return out << wasted


def decode_frame(data: bytes, bits: int) -> np.ndarray:
    """Samples by channel of one frame; ``bits`` is the size of samples where the frame doesn't say."""
    header = frame_header(data, 0)
    if header is None or crc16(data[:-2]) != int.from_bytes(data[-2:], "big"):
        raise ValueError("a damaged frame")
    n, kind, size, given = header["samples"], header["channels"], header["bits"] or bits, _Bits(data[header["body"] : -2])
    side = {LEFT_SIDE: 1, SIDE_RIGHT: 0, MID_SIDE: 1}.get(kind)
    channels = [_subframe(given, n, size + (c == side)) for c in range(2 if side is not None else kind + 1)]
    if kind == LEFT_SIDE:
        channels[1] = channels[0] - channels[1]
    elif kind == SIDE_RIGHT:
        channels[0] = channels[0] + channels[1]
    elif kind == MID_SIDE:
        twice = channels[0] << 1 | channels[1] & 1
        channels = [twice + channels[1] >> 1, twice - channels[1] >> 1]
    return np.stack(channels, 1)


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """(samples x channels between -1 and 1, rate) of a file."""
    info, _ = stream_info(data)
    parts = [decode_frame(f, info["bits"]) for _, f in frames(data)]
    whole = np.concatenate(parts) if parts else np.zeros((0, info["channels"]), np.int64)
    return whole / (1 << (info["bits"] - 1)), info["rate"]


def _bits_of(values: np.ndarray, n: int) -> np.ndarray:
    return (values[:, None] >> np.arange(n - 1, -1, -1) & 1).astype(np.uint8).ravel()


def _coded(channel: np.ndarray, size: int) -> np.ndarray:
    """The bits of a subframe: a constant, or the fixed order and Rice parameter of fewest bits, or the numbers as they are."""
    one = lambda x, n: _bits_of(np.array([x]), n)
    if (channel == channel[0]).all():
        return np.r_[one(0, 8), one(int(channel[0]), size)]
    best = len(channel) * size, None
    for order in range(min(5, len(channel))):
        residual = np.diff(channel, order)
        value = residual << 1 ^ residual >> 63
        for k in range(15):
            cost = int((value >> k).sum()) + len(value) * (k + 1) + order * size
            if cost < best[0]:
                best = cost, (order, k, value)
    if best[1] is None:
        return np.r_[one(2, 8), _bits_of(channel, size)]
    order, k, value = best[1]
    quotients = value >> k
    lengths = quotients + 1 + k
    starts = np.cumsum(lengths) - lengths
    coded = np.zeros(int(lengths.sum()), np.uint8)
    coded[starts + quotients] = 1
    if k:
        coded[(starts + quotients)[:, None] + 1 + np.arange(k)] = value[:, None] >> np.arange(k - 1, -1, -1) & 1
    return np.r_[one((8 + order) << 1, 8), _bits_of(channel[:order], size), one(0, 6), one(k, 4), coded]


def encode(samples: np.ndarray, rate: int, bits: int = 16, block: int = 4096, joint: bool = True) -> bytes:
    """A file of whole numbers, a line for each sample and a column for each channel; two channels as the first and the difference if ``joint``."""
    x = np.asarray(samples, np.int64)
    x = x[:, None] if x.ndim == 1 else x
    channels, out = x.shape[1], []
    for number, at in enumerate(range(0, len(x), block)):
        part = x[at : at + block]
        sides = [part[:, 0], part[:, 0] - part[:, 1]] if joint and channels == 2 else list(part.T)
        kind = LEFT_SIDE if joint and channels == 2 else channels - 1
        head = SYNCS[0] + bytes([7 << 4, kind << 4]) + _number(number) + (len(part) - 1).to_bytes(2, "big")
        body = np.packbits(np.concatenate([_coded(c, bits + (joint and channels == 2 and k == 1)) for k, c in enumerate(sides)])).tobytes()
        frame = head + bytes([crc8(head)]) + body
        out.append(frame + crc16(frame).to_bytes(2, "big"))
    packed = rate << 44 | channels - 1 << 41 | bits - 1 << 36 | len(x)
    info = block.to_bytes(2, "big") * 2 + bytes(6) + packed.to_bytes(8, "big") + bytes(16)
    return MAGIC + b"\x80" + len(info).to_bytes(3, "big") + info + b"".join(out)


def _number(n: int) -> bytes:
    """A number as the frame header has it: in the manner of UTF-8, up to 36 bits."""
    if n < 128:
        return bytes([n])
    size = next(s for s in range(2, 8) if n < 1 << (5 * s + 1))
    rest = [0x80 | n >> 6 * k & 63 for k in range(size - 2, -1, -1)]
    return bytes([(0xFF << (8 - size) & 0xFF) | n >> 6 * (size - 1), *rest])


def flac_bytes(rows: DataFrame, key: str, samples: str, rate: int, block: int = 4096) -> DataFrame:
    """(key, content): files of 16-bit whole numbers."""
    kind = rows.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, CLIPS):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([encode(np.array(x.as_py()), rate, block=block) if x.is_valid else None for x in b.column(1)], pa.binary())], names=[key, "content"])

    return rows.select(key, samples).mapInArrow(work, f"{key} {kind}, content binary")


def frame_rows(rows: DataFrame, key: str, content: str) -> DataFrame:
    """(key, first_sample, frame, bits, rate, error): a row for each frame of each file, dealt out evenly; what is no such file has one row with an error."""
    kind = rows.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    info, _ = stream_info(data or b"")
                    found = [(k, at, f, info["bits"], info["rate"], None) for at, f in frames(data)]
                except ValueError as e:
                    found = [(k, None, None, None, None, f"[ERROR: {e}]")]
                columns = list(zip(*found, strict=True)) or [()] * 6
                types = (b.schema.field(0).type, pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[key, "first_sample", "frame", "bits", "rate", "error"])

    cut_up = rows.select(key, content).mapInArrow(work, f"{key} {kind}, first_sample long, frame binary, bits int, rate int, error string")
    # a recording's frames go to all cores, however little they weigh
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut_up.repartition(tasks, F.xxhash64(key, "first_sample"))


def decoded(parts: DataFrame, key: str) -> DataFrame:
    """(key, first_sample, samples, rate, error): the mean of the channels of each frame of ``frame_rows``; a damaged frame has an error."""
    kind = parts.schema[key].dataType.simpleString()

    def one(frame: bytes | None, bits: int | None, error: str | None) -> tuple[list[float] | None, str | None]:
        try:
            return (None, error) if frame is None else ((decode_frame(frame, bits).mean(1) / (1 << (bits - 1))).tolist(), None)
        except (ValueError, IndexError) as e:
            return None, f"[ERROR: {e}]"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, CLIPS):
            found = [one(*row) for row in zip(*(b.column(c).to_pylist() for c in (2, 3, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s for s, _ in found], pa.list_(pa.float32())), b.column(4), pa.array([e for _, e in found], pa.string())], names=[key, "first_sample", "samples", "rate", "error"])

    return parts.select(key, "first_sample", "frame", "bits", "rate", "error").mapInArrow(work, f"{key} {kind}, first_sample long, samples array<float>, rate int, error string")
