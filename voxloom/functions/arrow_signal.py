"""Waveform stage for long arrays: one Arrow UDF call decodes, resamples,
conditions and measures.

Only the audio column travels to the Python worker; text and ids stay in the
JVM.  Rows of equal length are stacked and processed as one matrix, so short
clips cost no per-row numpy calls, and a long clip is a matrix of one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import SignalParams
from . import codec
from .signal import POWER_FLOOR, QUIET_SHARE, SILENT_DB

Decoder = Callable[[bytes], tuple[np.ndarray, int]]

METRICS_TYPE = T.StructType([
    T.StructField("n_samples", T.IntegerType()),
    T.StructField("max_clip_run", T.IntegerType()),
    T.StructField("snr_db", T.DoubleType()),
    T.StructField("rms_db", T.DoubleType()),
    T.StructField("error", T.StringType()),
])
SIGNAL_TYPE = T.StructType([T.StructField("samples", T.ArrayType(T.FloatType(), False)), *METRICS_TYPE.fields])
STACK_SAMPLES = 1 << 18  # clips of equal length are stacked up to about the size of a core's cache
_ARROW = {"n_samples": pa.int32(), "max_clip_run": pa.int32(), "snr_db": pa.float64(),
          "rms_db": pa.float64(), "error": pa.string()}


def longest_runs(mask: np.ndarray) -> np.ndarray:
    """Longest run of true values in every row of a 2-D mask; the cost follows the number of true values."""
    width = mask.shape[1]
    best = np.zeros(len(mask), np.int32)
    hits = np.flatnonzero(mask)
    if len(hits):
        breaks = (np.diff(hits) != 1) | (hits[1:] % width == 0)
        starts = np.flatnonzero(np.concatenate(([True], breaks)))
        lengths = np.diff(np.append(starts, len(hits)))
        np.maximum.at(best, hits[starts] // width, lengths.astype(np.int32))
    return best


def condition_matrix(x: np.ndarray) -> np.ndarray:
    """Centre every row, then scale it to peak 1 (silent rows stay zero)."""
    x = (x - x.mean(axis=1, dtype=np.float64, keepdims=True)).astype(np.float32)
    top = np.abs(x).max(axis=1, keepdims=True)
    return np.divide(x, top, out=x, where=top > 0)


def measure_matrix(y: np.ndarray, clip_amp: float) -> dict[str, np.ndarray]:
    """Metrics of conditioned rows of equal length."""
    level = np.abs(y)
    n = y.shape[1]
    quiet = max(1, n // QUIET_SHARE)
    power = np.square(y, dtype=np.float64).mean(axis=1)
    lowest = np.partition(level, quiet - 1, axis=1)[:, :quiet]
    noise = np.square(lowest, dtype=np.float64).mean(axis=1)
    with np.errstate(divide="ignore"):
        rms = 20 * np.log10(np.sqrt(power))
    return {
        "max_clip_run": longest_runs(level >= np.float32(clip_amp)),
        "snr_db": np.round(10 * np.log10(np.maximum(power, POWER_FLOOR) / np.maximum(noise, POWER_FLOOR)), 2),
        "rms_db": np.where(power > 0, np.round(rms, 2), SILENT_DB),
    }


def _once(run: Callable, kind: T.DataType) -> Callable[..., Column]:
    """The UDF, marked so that a later filter on its result does not make Spark run it a second time."""
    return F.arrow_udf(run, kind).asNondeterministic()


class _Batch:
    """Collects the outcome of one Arrow batch."""

    def __init__(self, size: int, params: SignalParams, keep_samples: bool, gate: bool):
        self.size, self.params, self.keep, self.gate = size, params, keep_samples, gate
        self.columns = {name: [None] * size for name in _ARROW}
        self.samples: list[np.ndarray | None] = [None] * size
        self.pending: dict[int, list[tuple[int, np.ndarray]]] = {}

    def fail(self, row: int, reason: str) -> None:
        self.columns["error"][row] = reason

    def add(self, row: int, x: np.ndarray, rate: int | None) -> None:
        p = self.params
        if x.ndim > 1:
            x = x.mean(axis=-1, dtype=np.float64).astype(np.float32)
        if len(x) == 0:
            return self.fail(row, "no audio")
        if rate is None or rate <= 0:
            return self.fail(row, f"bad rate {rate}")
        if not np.isfinite(x).all():
            return self.fail(row, "non-finite samples")
        n = codec.resampled_length(len(x), rate, p.target_sr)
        self.columns["n_samples"][row] = n
        seconds = n / p.target_sr
        # The final length is known before any filtering, so rows that fail on it skip the work.
        if n == 0 or (self.gate and not p.min_s <= seconds <= p.max_s):
            return None
        if rate != p.target_sr:
            x = codec.resample(x, rate, p.target_sr)
        self.pending.setdefault(n, []).append((row, x))

    def _measure(self, group: list[tuple[int, np.ndarray]]) -> None:
        rows = [row for row, _ in group]
        y = condition_matrix(np.stack([x for _, x in group]))
        for name, values in measure_matrix(y, self.params.clip_amp).items():
            for row, value in zip(rows, values.tolist()):
                self.columns[name][row] = value
        if self.keep:
            for row, samples in zip(rows, y):
                self.samples[row] = samples

    def finish(self) -> pa.StructArray:
        for n, group in self.pending.items():
            step = max(1, STACK_SAMPLES // n)
            for lo in range(0, len(group), step):
                self._measure(group[lo:lo + step])
        self.pending.clear()
        arrays = [pa.array(self.columns[name], kind) for name, kind in _ARROW.items()]
        names = list(_ARROW)
        if self.keep:
            arrays.insert(0, _list_array(self.samples))
            names.insert(0, "samples")
        return pa.StructArray.from_arrays(arrays, names)


def _list_array(rows: list[np.ndarray | None]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([0 if r is None else len(r) for r in rows], out=offsets[1:])
    present = [r for r in rows if r is not None]
    values = pa.array(np.concatenate(present) if present else np.empty(0, np.float32), pa.float32())
    missing = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=missing)


def _float_rows(column: pa.Array):
    """Numpy views of the rows of a list array, one flat buffer for all of them."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield None if nulls[i] else flat[offsets[i]:offsets[i + 1]]


def samples_stage(params: SignalParams, keep_samples: bool = True, gate: bool = True) -> Callable[[Column, Column], Column]:
    """``stage(samples array<float>, rate int) -> struct`` for already decoded audio."""

    def run(samples: pa.Array, rate: pa.Array) -> pa.Array:
        batch = _Batch(len(samples), params, keep_samples, gate)
        for row, (x, sr) in enumerate(zip(_float_rows(samples), rate.to_pylist())):
            if x is None or len(x) == 0:
                batch.fail(row, "no audio")
            else:
                batch.add(row, x, sr)
        return batch.finish()

    run.__annotations__ = {"samples": pa.Array, "rate": pa.Array, "return": pa.Array}
    return _once(run, SIGNAL_TYPE if keep_samples else METRICS_TYPE)


def bytes_stage(
    params: SignalParams, keep_samples: bool = True, gate: bool = True, decoder: Decoder | None = None
) -> Callable[[Column], Column]:
    """``stage(binary) -> struct`` for encoded audio; a bad row becomes an error, never a failed task."""
    decode = decoder or codec.decode_wav

    def run(content: pa.Array) -> pa.Array:
        batch = _Batch(len(content), params, keep_samples, gate)
        for row, cell in enumerate(content):
            data = cell.as_py()
            if not data:
                batch.fail(row, "no audio")
                continue
            try:
                x, rate = decode(data)
                batch.add(row, np.asarray(x, np.float32), int(rate))
            except Exception as problem:
                batch.fail(row, str(problem) or type(problem).__name__)
        return batch.finish()

    run.__annotations__ = {"content": pa.Array, "return": pa.Array}
    return _once(run, SIGNAL_TYPE if keep_samples else METRICS_TYPE)


def decode_stage(decoder: Decoder | None = None) -> Callable[[Column], Column]:
    """``stage(binary) -> struct<samples, sampling_rate, channels, error>``: mono samples at the stored rate."""
    decode = decoder or codec.decode_wav
    kind = T.StructType([
        T.StructField("samples", T.ArrayType(T.FloatType(), False)),
        T.StructField("sampling_rate", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ])

    def run(content: pa.Array) -> pa.Array:
        rows, rates, channels, errors = [], [], [], []
        for cell in content:
            data, x, rate, width, problem = cell.as_py(), None, None, None, None
            try:
                if not data:
                    raise ValueError("no audio")
                x, rate = decode(data)
                width = 1 if x.ndim == 1 else x.shape[1]
                x = x if x.ndim == 1 else x.mean(axis=-1, dtype=np.float64).astype(np.float32)
            except Exception as caught:
                x, problem = None, str(caught) or type(caught).__name__
            rows.append(x)
            rates.append(rate)
            channels.append(width)
            errors.append(problem)
        return pa.StructArray.from_arrays(
            [_list_array(rows), pa.array(rates, pa.int32()), pa.array(channels, pa.int32()), pa.array(errors, pa.string())],
            ["samples", "sampling_rate", "channels", "error"],
        )

    run.__annotations__ = {"content": pa.Array, "return": pa.Array}
    return _once(run, kind)


def resample_stage(target_sr: int) -> Callable[[Column, Column], Column]:
    """``stage(samples, rate) -> array<float>``; rows already at the target rate should bypass it."""

    def run(samples: pa.Array, rate: pa.Array) -> pa.Array:
        return _list_array([
            None if x is None else codec.resample(x, target_sr if sr is None else sr, target_sr)
            for x, sr in zip(_float_rows(samples), rate.to_pylist())
        ])

    run.__annotations__ = {"samples": pa.Array, "rate": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.ArrayType(T.FloatType(), False))


def resample_column(samples: Column, rate: Column, target_sr: int) -> Column:
    """Resample only where the rate differs; the other rows send nulls to the worker."""
    differs = rate != target_sr
    converted = resample_stage(target_sr)(F.when(differs, samples), F.when(differs, rate))
    return F.when(differs, converted).otherwise(samples)
