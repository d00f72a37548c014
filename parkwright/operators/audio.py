"""Sound: WAV and FLAC bytes, downmix and resampling, in Arrow batches of whole clips."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from math import ceil, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.functions.numbers import MAX_CLIP_SECONDS, SAMPLE_RATE
from parkwright.operators import flac
from parkwright.sources.shared import slices

#: Crossings of zero that the resampling filter has on either side, and the part of the band it lets through.
CROSSINGS, ROLLOFF = 6, 0.99
_AUDIO = "samples array<float>, sampling_rate int, error string"


def encode_wav(samples: np.ndarray, rate: int = SAMPLE_RATE) -> bytes:
    """16-bit WAV bytes of whole numbers, one line for each frame and one column for each channel."""
    frames = np.asarray(samples, "<i2").reshape(len(samples), -1)
    channels, data = frames.shape[1], frames.tobytes()
    form = struct.pack("<HHIIHH", 1, channels, rate, rate * channels * 2, channels * 2, 16)
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """(frames x channels between -1 and 1, rate) of WAV bytes: whole numbers of 8 to 32 bits, or floats."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not WAV bytes")
    at, form, body = 12, None, None
    while at + 8 <= len(data):
        name, (size,) = data[at : at + 4], struct.unpack_from("<I", data, at + 4)
        part = data[at + 8 : at + 8 + size]
        form, body = (part, body) if name == b"fmt " else (form, part) if name == b"data" and body is None else (form, body)
        at += 8 + size + size % 2
    if form is None or body is None:
        raise ValueError("WAV bytes without a format or data")
    kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", form)
    if kind == 0xFFFE:  # the kind is the first part of a longer name
        (kind,) = struct.unpack_from("<H", form, 24)
    width = bits // 8
    if kind == 3 and width in (4, 8):
        x = np.frombuffer(body[: len(body) // width * width], f"<f{width}").astype(float)
    elif kind == 1 and width == 1:
        x = (np.frombuffer(body, np.uint8).astype(float) - 128) / 128
    elif kind == 1 and width in (2, 3, 4):
        raw = np.frombuffer(body[: len(body) // width * width], np.uint8).reshape(-1, width)
        # the bytes of a sample at the high end of 32 bits, so that the sign is where it should be
        whole = np.zeros((len(raw), 4), np.uint8)
        whole[:, 4 - width :] = raw
        x = whole.view("<i4").ravel() / 2.0**31
    else:
        raise ValueError(f"WAV of kind {kind} with {bits} bits")
    return x[: len(x) // channels * channels].reshape(-1, channels), rate


def mono(x: np.ndarray) -> np.ndarray:
    """One channel: the mean over the first axis if it is at most 8 long and shorter than the last, else over the last."""
    if x.ndim < 2:
        return x
    return x.mean(axis=0) if x.shape[0] <= 8 and x.shape[0] < x.shape[-1] else x.mean(axis=-1)


def resampled(x: np.ndarray, rate: int, to: int = SAMPLE_RATE) -> np.ndarray:
    """``x`` at another rate through a windowed sinc filter, which keeps out what the lower rate can't hold."""
    if rate == to or not len(x):
        return x
    up, down = to // gcd(rate, to), rate // gcd(rate, to)
    band = min(1.0, to / rate) * ROLLOFF
    half, n = ceil(CROSSINGS / band), ceil(len(x) * to / rate)
    lines = ceil(n / up)
    padded = np.r_[np.zeros(half), x, np.zeros(half + lines * down)]
    out = np.empty((lines, up))
    for phase in range(up):  # outputs of one phase see the same filter, ``down`` samples apart
        first, rest = divmod(phase * down, up)
        u = (rest / up - np.arange(-half + 1, half + 1)) * band
        taps = band * np.sinc(u) * np.where(np.abs(u) < CROSSINGS, np.cos(np.pi * u / CROSSINGS / 2) ** 2, 0)
        windows = np.lib.stride_tricks.sliding_window_view(padded[first + 1 :], 2 * half)[::down][:lines]
        out[:, phase] = windows @ taps
    return out.ravel()[:n]


def wav_bytes(rows: DataFrame, key: str, frames: str) -> DataFrame:
    """(key, content): 16-bit WAV bytes of frames of whole numbers."""
    kind = rows.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, flac.CLIPS):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([encode_wav(np.array(x.as_py())) if x.is_valid else None for x in b.column(1)], pa.binary())], names=[key, "content"])

    return rows.select(key, frames).mapInArrow(work, f"{key} {kind}, content binary")


def audio_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, audio) of the files in a folder of any store that Spark reads; ``audio`` holds their bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.struct(F.col("content").alias("bytes")).alias("audio"))


def prepared(rows: DataFrame, key: str, audio: str, to: int | None = SAMPLE_RATE, most_seconds: float | None = MAX_CLIP_SECONDS) -> DataFrame:
    """(key, samples, sampling_rate, error): one channel at the rate ``to``, at most ``most_seconds``; None leaves either as it is.

    ``audio`` is a struct with an ``array`` (of samples, or of channels) and its
    ``sampling_rate``, or else with WAV or FLAC ``bytes``. What can't be read has an error
    instead of samples. Long recordings are better decoded by their frames (``flac``).
    """
    kind = rows.schema[key].dataType.simpleString()

    def one(a: dict | None) -> tuple[np.ndarray | None, int | None, str | None]:
        try:
            if a is None or (a.get("array") is None and a.get("bytes") is None):
                raise ValueError("no audio")
            if a.get("array") is not None:
                x, rate = mono(np.array(a["array"], float)), int(a.get("sampling_rate") or SAMPLE_RATE)
            else:
                x, rate = flac.decode(a["bytes"]) if a["bytes"][:4] == flac.MAGIC else decode_wav(a["bytes"])
                x = x.mean(axis=1)
            if to is not None:
                x, rate = resampled(x, rate, to), to
            return (x if most_seconds is None else x[: int(most_seconds * rate)]).astype(np.float32), rate, None
        except (ValueError, IndexError, struct.error, ZeroDivisionError) as e:
            return None, None, f"[ERROR: {e}]"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, flac.CLIPS):
            samples, rates, errors = zip(*[one(a.as_py()) for a in b.column(1)], strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(samples, pa.list_(pa.float32())), pa.array(rates, pa.int32()), pa.array(errors, pa.string())], names=[key, "samples", "sampling_rate", "error"])

    return rows.select(key, audio).mapInArrow(work, f"{key} {kind}, {_AUDIO}")
