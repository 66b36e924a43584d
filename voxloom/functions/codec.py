"""Small numpy helpers used inside Arrow tasks: WAV bytes and rate conversion.

Only uncompressed RIFF/WAVE is read here.  Compressed audio needs a decoder
from the caller; without one its rows are dropped with their own reason.
"""

from __future__ import annotations

from functools import lru_cache
from math import gcd

import numpy as np

PCM, IEEE_FLOAT, EXTENSIBLE = 0x0001, 0x0003, 0xFFFE  # fixed values: format tags of the WAVE header


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """``(frames x channels float32, rate)`` with full scale at 1.0."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("unsupported codec")
    tag = channels = rate = bits = None
    body = None
    at = 12
    while at + 8 <= len(data):
        name, size = data[at:at + 4], int.from_bytes(data[at + 4:at + 8], "little")
        chunk = memoryview(data)[at + 8:at + 8 + size]
        if name == b"fmt ":
            if len(chunk) < 16:
                raise ValueError("incomplete wav")
            tag, channels = np.frombuffer(chunk, "<u2", 2).tolist()
            rate = int(np.frombuffer(chunk, "<u4", 1, 4)[0])
            bits = int(np.frombuffer(chunk, "<u2", 1, 14)[0])
            if tag == EXTENSIBLE:
                tag = int(np.frombuffer(chunk, "<u2", 1, 24)[0])
        elif name == b"data":
            body = chunk
            break
        at += 8 + size + (size & 1)
    if tag is None or body is None or not channels or not rate:
        raise ValueError("incomplete wav")
    samples = _scale(body, tag, bits)
    frames = len(samples) // channels
    return samples[:frames * channels].reshape(frames, channels), rate


def _scale(body: memoryview, tag: int, bits: int) -> np.ndarray:
    width = bits // 8
    body = body[:len(body) // width * width] if width else body
    if tag == IEEE_FLOAT and bits in (32, 64):
        return np.frombuffer(body, f"<f{width}").astype(np.float32)
    if tag == PCM and bits == 8:
        return (np.frombuffer(body, np.uint8).astype(np.float32) - 128) / np.float32(128)
    if tag == PCM and bits in (16, 32):
        return np.frombuffer(body, f"<i{width}").astype(np.float32) * np.float32(2.0 ** (1 - bits))
    if tag == PCM and bits == 24:
        wide = np.zeros((len(body) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(body, np.uint8).reshape(-1, 3)
        return wide.view("<i4")[:, 0].astype(np.float32) * np.float32(2.0**-31)
    raise ValueError("unsupported codec")


def resampled_length(n: int, rate: int, target: int) -> int:
    return n * target // rate


@lru_cache(maxsize=8)
def _sinc_bank(up: int, down: int, zero_crossings: int, beta: float) -> tuple[np.ndarray, int]:
    """One row of Kaiser-windowed sinc taps per output phase."""
    cutoff = min(1.0, up / down)
    half = int(np.ceil(zero_crossings / cutoff))
    offsets = np.arange(-half + 1, half + 1)
    distance = offsets[None, :] - (np.arange(up) / up)[:, None]
    window = np.i0(beta * np.sqrt(np.clip(1 - (distance / half) ** 2, 0, None))) / np.i0(beta)
    bank = cutoff * np.sinc(cutoff * distance) * window
    return (bank / bank.sum(axis=1, keepdims=True)).astype(np.float32), half


@lru_cache(maxsize=8)
def _block_matrix(up: int, down: int, repeat: int, zero_crossings: int, beta: float) -> tuple[np.ndarray, int]:
    """Matrix from a window of input samples to ``up * repeat`` consecutive output samples."""
    bank, half = _sinc_bank(up, down, zero_crossings, beta)
    matrix = np.zeros((down * repeat + 2 * half, up * repeat), np.float32)
    for column in range(up * repeat):
        first, phase = divmod(column * down, up)
        matrix[first:first + 2 * half, column] = bank[phase]
    return matrix, half


BLOCK_OUTPUTS = 128  # outputs per matrix block, at least
MAX_MATRIX = 1 << 20  # larger ratios take the slower form
STEP = 1 << 22  # input values copied at a time


def resample(x: np.ndarray, rate: int, target: int, zero_crossings: int = 32, beta: float = 9.0) -> np.ndarray:
    """Band-limited rate conversion; memory per step is bounded."""
    if rate == target:
        return x
    common = gcd(rate, target)
    up, down = target // common, rate // common
    n_out = resampled_length(len(x), rate, target)
    if n_out == 0:
        return np.empty(0, np.float32)
    repeat = -(-BLOCK_OUTPUTS // up)
    if up * repeat * down * repeat > MAX_MATRIX:
        return _resample_by_phase(x, up, down, n_out, zero_crossings, beta)
    matrix, half = _block_matrix(up, down, repeat, zero_crossings, beta)
    window, outputs = matrix.shape
    hop = down * repeat
    blocks = -(-n_out // outputs)
    padded = np.zeros(max((blocks - 1) * hop + window, half - 1 + len(x)), np.float32)
    padded[half - 1:half - 1 + len(x)] = x
    spans = np.lib.stride_tricks.sliding_window_view(padded, window)[::hop]
    out = np.empty((blocks, outputs), np.float32)
    step = max(1, STEP // window)
    for lo in range(0, blocks, step):
        hi = min(lo + step, blocks)
        np.matmul(np.ascontiguousarray(spans[lo:hi]), matrix, out=out[lo:hi])
    return out.ravel()[:n_out]


def _resample_by_phase(x: np.ndarray, up: int, down: int, n_out: int, zero_crossings: int, beta: float) -> np.ndarray:
    """The same filter, gathered per output sample, for ratios with very many phases."""
    bank, half = _sinc_bank(up, down, zero_crossings, beta)
    padded = np.concatenate([np.zeros(half - 1, np.float32), x, np.zeros(half + 1, np.float32)])
    spans = np.lib.stride_tricks.sliding_window_view(padded, 2 * half)
    out = np.empty(n_out, np.float32)
    step = max(1, STEP // (2 * half))
    for lo in range(0, n_out, step):
        ticks = np.arange(lo, min(lo + step, n_out), dtype=np.int64) * down
        out[lo:lo + len(ticks)] = np.einsum("ij,ij->i", spans[ticks // up], bank[ticks % up])
    return out
