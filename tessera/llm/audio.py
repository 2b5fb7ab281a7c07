"""Audio columns: 8-bit PCM, polyphase resampling, log-mel filterbanks and hysteresis segmentation.

encode() stores payloads as WAV files (mono, 8 bits a sample) in a binary column, store() puts them into a table; features() reads them back and
stores each one's log-mel frames as Arrow tensors of a fixed shape, FRAMES x BANDS, with their spans of time (an Arrow stream in a binary column,
which read_tensors() reads), and its loud segments. The last tensor is filled up with the floor value; its span ends where the sound ends. The digest is
made from the tensors as stored.

A null payload is an empty one. A sound shorter than one window has one frame, filled up with silence. Repeated rows are treated alike, an empty table
gives an empty one, and columns of sounds beyond the media stay as they are.
"""
from __future__ import annotations

import struct
from functools import lru_cache
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, bounded_batches, materialise, record_batches

RATE, TARGET = 8000, 6000
WINDOW, HOP, BANDS, FRAMES = 256, 128, 16, 64
TAPS = 8
FLOOR = -12.0
#: A segment begins above the upper and ends below the lower of these, in units of the frames' spread above their mean.
UPPER, LOWER = 0.5, -0.25


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """A RIFF file of unsigned 8-bit samples."""
    pad = b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + len(pad)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + pad


def read_wav(data: bytes) -> tuple[bytes, int]:
    """Samples and rate of such a file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not mono PCM of 8 bits")
        elif name == b"data":
            return data[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no data")


@lru_cache(8)
def _phases(up: int, down: int) -> np.ndarray:
    """The low-pass filter's phases: row p holds the taps for outputs at phase p."""
    n = 2 * TAPS * max(up, down) + 1
    t = (np.arange(n) - n // 2) / max(up, down)
    h = np.sinc(t) * np.hanning(n + 2)[1:-1]
    h *= up / h.sum()
    width = -(-n // up)
    out = np.zeros((up, width))
    for p in range(up):
        x = h[p::up]
        out[p, : len(x)] = x
    return out.astype(np.float32)


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """x at another rate: each output is one phase of the filter over the inputs around it."""
    g = gcd(rate, target)
    up, down = target // g, rate // g
    if up == down or not len(x):
        return x.astype(np.float32)
    phases = _phases(up, down)
    width = phases.shape[1]
    centre = (2 * TAPS * max(up, down) + 1) // 2
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(width, np.float32), x.astype(np.float32), np.zeros(width + 1, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    out = np.empty(n, np.float32)
    for first in range(min(up, n)):
        k = np.arange(first, n, up)
        place = k * down + centre
        ends, p = place // up, int(place[0] % up)
        out[k] = windows[ends + 1] @ phases[p][::-1]
    return out


@lru_cache(4)
def _mel(rate: int) -> np.ndarray:
    hz = lambda m: 700 * (10 ** (m / 2595) - 1)
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = hz(np.linspace(0, top, BANDS + 2)) / (rate / 2) * (WINDOW // 2)
    k = np.arange(WINDOW // 2 + 1)
    rise = (k - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - k) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).T.astype(np.float32)


_HANN = np.hanning(WINDOW).astype(np.float32)


def log_mel(x: np.ndarray, rate: int = TARGET) -> np.ndarray:
    """Frames x BANDS: logs of the mel energies of overlapping windows. Long sounds go in blocks of frames."""
    n = max(1, 1 + -(-max(0, len(x) - WINDOW) // HOP))
    padded = np.zeros((n - 1) * HOP + WINDOW, np.float32)
    padded[: len(x)] = x
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::HOP]
    out = np.empty((n, BANDS), np.float32)
    for i in range(0, n, 512):
        out[i : i + 512] = np.abs(np.fft.rfft(windows[i : i + 512] * _HANN)).astype(np.float32) ** 2 @ _mel(rate)
    return np.maximum(np.log(out + 1e-6), FLOOR)


def segments(frames: np.ndarray) -> list[tuple[int, int]]:
    """Runs of frames [begin, end) that are loud: begun above one limit, ended below a lower one."""
    e = frames.mean(1)
    spread = e.std()
    if not spread > 1e-6:
        return []
    z = (e - e.mean()) / spread
    strong, weak = z > UPPER, z >= LOWER
    edge = np.diff(np.concatenate([[0], weak.astype(np.int8), [0]]))
    return [(int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True) if strong[a:b].any()]


def payload(text: bytes) -> bytes:
    """The text's bytes and zeros up to a multiple of 64, which is above 0."""
    return text + b"\0" * (-len(text) % 64 or 64 * (not text))


def analyse(data: bytes) -> tuple[bytes, np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """From a stored sound: its samples, tensors (k, FRAMES, BANDS), the tensors' spans and the segments, in seconds."""
    samples, rate = read_wav(data)
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    frames = log_mel(resample(x, rate, TARGET))
    k = -(-len(frames) // FRAMES)
    tensors = np.full((k * FRAMES, BANDS), FLOOR, np.float32)
    tensors[: len(frames)] = frames
    step, length = HOP / TARGET, len(x) / rate
    spans = [(i * FRAMES * step, min(length, ((i + 1) * FRAMES - 1) * step + WINDOW / TARGET)) for i in range(k)]
    loud = [(a * step, min(length, (b - 1) * step + WINDOW / TARGET)) for a, b in segments(frames)]
    return samples, tensors.reshape(k, FRAMES, BANDS), spans, loud


def feature_digest(tensors: np.ndarray, loud: list[tuple[float, float]]) -> str:
    """Means and spreads of the bands to one decimal, and the number and length of the loud segments."""
    flat = tensors.reshape(-1, BANDS)
    flat = flat[(flat > FLOOR).any(1)] if (flat > FLOOR).any() else flat
    mean, spread = flat.mean(0, dtype=np.float64), flat.std(0, dtype=np.float64)
    return "m=" + ",".join(f"{v:.1f}" for v in mean) + ";s=" + ",".join(f"{v:.1f}" for v in spread) + f";n={len(loud)};t={sum(b - a for a, b in loud):.2f}"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's payload as a WAV file."""
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(it):
        for b in record_batches(it):
            texts = as_bytes(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([wav(payload(t)) for t in texts], pa.large_binary()).cast(pa.binary())], [id_col, "n_bytes", "media"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, media binary")


def store(sounds: DataFrame) -> DataFrame:
    """sounds, written as a table in the shared folder and read back from there."""
    return materialise(sounds, "media")


SEGMENTS = T.ArrayType(T.StructType([T.StructField("begin", T.DoubleType()), T.StructField("end", T.DoubleType())]))


def tensor_table(tensors: np.ndarray, spans: list[tuple[float, float]]) -> pa.Table:
    """begin, end and a fixed-shape tensor in each row."""
    column = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(tensors, np.float32))
    return pa.table({"begin": pa.array([x for x, _ in spans], pa.float64()), "end": pa.array([y for _, y in spans], pa.float64()), "tensor": column})


def stored_tensors(tensors: np.ndarray, spans: list[tuple[float, float]]) -> bytes:
    t, sink = tensor_table(tensors, spans), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as writer:
        writer.write_table(t)
    return sink.getvalue().to_pybytes()


def read_tensors(data: bytes) -> pa.Table:
    """The table that stored_tensors() has written."""
    return pa.ipc.open_stream(data).read_all()


def tensor_values(table: pa.Table) -> np.ndarray:
    """All tensors, (k, FRAMES, BANDS)."""
    return table["tensor"].combine_chunks().to_numpy_ndarray()


def features(sounds: DataFrame, media_col: str = "media") -> DataFrame:
    """sounds with samples, stored tensors and their spans, segments and a feature digest."""
    bounded_batches(sounds.sparkSession)
    new = ["samples", "tensors", "segments", "feature"]
    if clash := {c.lower() for c in sounds.columns} & set(new):
        raise ValueError(f"there are columns {sorted(clash)} already")
    schema = T.StructType(list(sounds.schema.fields))
    for name, kind in zip(new, (T.BinaryType(), T.BinaryType(), SEGMENTS, T.StringType()), strict=True):
        schema = schema.add(name, kind)
    at = sounds.columns.index(media_col)

    def run(it):
        span = pa.struct([("begin", pa.float64()), ("end", pa.float64())])
        for b in record_batches(it, 1 << 20):
            samples, cells, loud, digests = [], [], [], []
            for data in b.column(at).to_pylist():
                s, t, spans, runs = analyse(data or wav(b""))
                cells.append(stored_tensors(t, spans))
                samples.append(s)
                loud.append([{"begin": x, "end": y} for x, y in runs])
                digests.append(feature_digest(tensor_values(read_tensors(cells[-1])), runs))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(samples, pa.binary()), pa.array(cells, pa.binary()), pa.array(loud, pa.list_(span)), pa.array(digests, pa.string())], [*b.schema.names, *new])

    return sounds.mapInArrow(run, schema)
