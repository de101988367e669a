"""Media columns: bytes are kept as 8-bit PCM in a WAV container, and audio features are computed from the samples read back.

Samples are resampled by a polyphase filter bank (rate times up/down), cut into overlapped frames for a log-mel filterbank, and
segmented by energy with hysteresis (a segment opens above one threshold and closes below a lower one). Features are laid out
as fixed-shape tensors (PATCH frames x MELS bands) with the time span of each.

Everything is computed text by text in blocks of BLOCK frames, so equal texts give equal values wherever they are, and a long text
needs, beside its sound and tensors as they are stored, the memory of one block. Digests and feature strings are taken from what is
read back: the samples from the container, the frames from the tensors and their spans. Defined results: a null text counts as
empty, whose payload is 576 bytes of 255.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

ALIGN, FILL = 576, 255
RATE_IN, UP, DOWN = 24_000, 2, 3
RATE = RATE_IN * UP // DOWN
FRAME, HOP, MELS, PATCH = 400, 160, 40, 64
TAPS = 16  # of each phase
OPEN_DB, CLOSE_DB = -9.0, -12.0
#: Frames that are transformed at once.
BLOCK = 2_048
TENSOR = pa.fixed_shape_tensor(pa.float32(), [PATCH, MELS])


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The padded payload and the number of bytes before padding."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    return data + bytes([FILL]) * (max(ALIGN, -(-n // ALIGN) * ALIGN) - n), n


def write_wav(payload: bytes, rate: int = RATE_IN) -> bytes:
    """8-bit mono PCM; the data chunk is even, so no pad byte is needed. Over 4 GB the sizes are those of a stream (all ones)."""
    size = len(payload)
    riff, data = (min(x, 0xFFFFFFFF) for x in (36 + size, size))
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", riff, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", data) + payload


def read_wav(media: bytes) -> tuple[np.ndarray, int]:
    """The stored samples as unsigned bytes and their rate, found by walking the chunks."""
    at, rate = 12, 0
    while at + 8 <= len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"fmt ":
            rate = struct.unpack_from("<I", media, at + 12)[0]
        if kind == b"data":
            return np.frombuffer(media, np.uint8, count=-1 if size == 0xFFFFFFFF else size, offset=at + 8), rate
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def polyphase_filters(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """Row p holds the windowed-sinc taps of phase p, each row summing to one."""
    n = taps * up
    t = np.arange(n) - (n - 1) / 2
    cut = 1 / max(up, down)
    h = np.sinc(t * cut) * np.hanning(n + 2)[1:-1]
    bank = h.reshape(taps, up).T[:, ::-1]
    return np.ascontiguousarray(bank / bank.sum(axis=1, keepdims=True), np.float32)


def resampled_length(n: int, up: int = UP, down: int = DOWN) -> int:
    return -(-n * up // down)


def resample(samples: np.ndarray, bank: np.ndarray, down: int = DOWN, first: int = 0, last: int | None = None) -> np.ndarray:
    """Outputs first to last (not included; all by default). Output k comes from input position k*down // up under phase k*down % up,
    with zeros beyond the ends. samples: floats, or bytes of 8-bit sound, whose needed part alone is turned into floats."""
    up, taps = bank.shape
    last = resampled_length(len(samples), up, down) if last is None else last
    out = np.empty(last - first, np.float32)
    if not len(out):
        return out
    a, b = first * down // up - taps // 2, (last - 1) * down // up - taps // 2 + taps
    part = samples[max(0, a) : max(0, b)]
    if part.dtype == np.uint8:
        part = (part.astype(np.float32) - 128) / 128
    part = np.concatenate([np.zeros(max(0, -a), np.float32), part, np.zeros(max(0, b - max(len(samples), 0)) + down, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(part, taps)
    for nth in range(min(up, len(out))):  # outputs k, k + up, ... share one phase and step by `down` inputs
        k = first + nth
        start, n = k * down // up - taps // 2 - a, len(range(k, last, up))
        out[nth::up] = windows[start : start + down * n : down][:n] @ bank[k * down % up]
    return out


def mel_bank(rate: int = RATE, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    to_mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(to_mel(20), to_mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.arange(frame // 2 + 1) * rate / frame
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid))).T.astype(np.float32)


_BANK, _MEL = polyphase_filters(), mel_bank()
_WINDOW = np.hanning(FRAME).astype(np.float32)


def log_mel(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (log-mel rows, frame energy in dB) of samples as stored; the last frame is filled with zeros."""
    n_signal = resampled_length(len(raw))
    n = max(1, -(-max(0, n_signal - FRAME) // HOP) + 1)
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        size = (b - 1 - a) * HOP + FRAME
        signal = resample(raw, _BANK, DOWN, a * HOP, min(n_signal, a * HOP + size))
        signal = np.concatenate([signal, np.zeros(size - len(signal), np.float32)])
        x = np.lib.stride_tricks.sliding_window_view(signal, FRAME)[::HOP] * _WINDOW
        spectrum = np.fft.rfft(x, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        yield np.log(power @ _MEL + np.float32(1e-6)), 10 * np.log10(np.einsum("ij,ij->i", x, x) / FRAME + 1e-9)


def segments(energy: np.ndarray, open_db: float = OPEN_DB, close_db: float = CLOSE_DB) -> np.ndarray:
    """Hysteresis: [first, last + 1) frames from the first above open_db until the first below close_db."""
    mark = np.where(energy >= open_db, 1, np.where(energy < close_db, -1, 0))
    known = np.flatnonzero(mark)
    if not len(known):
        return np.zeros((0, 2), np.int64)
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = np.where(last >= 0, mark[np.maximum(last, 0)], -1) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return turn.reshape(-1, 2)


def tensors_ipc(blocks: Iterator[np.ndarray]) -> bytes:
    """An Arrow stream with one row per patch: start_s, end_s, and the patch as a fixed-shape tensor (zeros fill the last). blocks: of
    log-mel rows, a whole number of patches in all but the last; each becomes a record batch."""
    schema = pa.schema([("start_s", pa.float64()), ("end_s", pa.float64()), ("log_mel", TENSOR)])
    sink, at = io.BytesIO(), 0
    with pa.ipc.new_stream(sink, schema) as writer:
        for mels in blocks:
            n = -(-len(mels) // PATCH)
            full = np.zeros((n * PATCH, MELS), np.float32)
            full[: len(mels)] = mels
            first = at + np.arange(n) * PATCH
            end = (np.minimum(first + PATCH, at + len(mels)) - 1) * HOP + FRAME
            tensor = pa.FixedShapeTensorArray.from_numpy_ndarray(full.reshape(n, PATCH, MELS))
            writer.write_batch(pa.record_batch([pa.array(first * HOP / RATE), pa.array(end / RATE), tensor], schema=schema))
            at += len(mels)
    return sink.getvalue()


def read_tensors(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def stored_frames(blob: bytes) -> Iterator[np.ndarray]:
    """The log-mel rows of stored tensors, a record batch at a time; the spans tell how many frames of a patch are its own."""
    for batch in pa.ipc.open_stream(blob):
        rows = batch.column(2).to_numpy_ndarray().reshape(-1, MELS)
        first, last = batch.column(0)[0].as_py(), batch.column(1)[batch.num_rows - 1].as_py()
        yield rows[: round(((last - first) * RATE - FRAME) / HOP) + 1]


def feature_string(frames: Iterator[np.ndarray], starts: list[float], ends: list[float]) -> str:
    """Number of frames and bands, digest of the values in steps of 1/16, number of segments, and the seconds they cover."""
    n, digest = 0, hashlib.sha256()
    for mels in frames:
        n += len(mels)
        digest.update(np.clip(np.rint(mels * 16), -32768, 32767).astype("<i2").tobytes())
    held = sum(round((e - s) * RATE / HOP) for s, e in zip(starts, ends, strict=True)) * HOP / RATE
    return f"logmel[{n}x{MELS}]:{digest.hexdigest()[:32]};segments={len(starts)};active_s={held:.3f}"


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
_MEDIA = pa.schema([("doc_id", pa.int64()), ("media", pa.binary()), ("tensors", pa.binary()), ("segment_starts_s", pa.list_(pa.float64())), ("segment_ends_s", pa.list_(pa.float64()))])


def media_row(doc_id: int | None, text: str | None) -> tuple:
    media = write_wav(payload_of(text)[0])
    energy: list[np.ndarray] = []

    def blocks() -> Iterator[np.ndarray]:
        for mels, power in log_mel(read_wav(media)[0]):
            energy.append(power)
            yield mels

    tensors = tensors_ipc(blocks())
    power = np.concatenate(energy)
    found = segments(power - power.max())
    return doc_id, media, tensors, (found[:, 0] * HOP / RATE).tolist(), (found[:, 1] * HOP / RATE).tolist()


def digest(doc_id: int | None, text: str | None) -> tuple:
    """Of what media_row stores, read back."""
    _, media, tensors, starts, ends = media_row(doc_id, text)
    back = read_wav(media)[0]
    n = len((text or "").encode("utf-8", "surrogatepass"))
    return doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature_string(stored_frames(tensors), starts, ends)


def _apply(docs: DataFrame, row, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, size = [], 0
            for i, text in zip(ids, texts, strict=True):
                rows.append(row(i.as_py(), x := text.as_py()))
                size += len(x or "")
                if size > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, ddl)


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, media (WAV), tensors (Arrow stream of fixed-shape tensors with time spans), starts and ends of segments."""
    return _apply(docs, media_row, _MEDIA, "doc_id long, media binary, tensors binary, segment_starts_s array<double>, segment_ends_s array<double>")


def media_digests(docs: DataFrame) -> DataFrame:
    """What media_columns stores, read back and reduced to sizes, digests and a feature string."""
    return _apply(docs, digest, _DIGEST, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
