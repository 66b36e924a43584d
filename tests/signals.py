"""Made signals and files for the tests."""

from __future__ import annotations

import struct

import numpy as np


def tone(n: int, hz: float = 220.0, rate: int = 16000, level: float = 0.4) -> np.ndarray:
    return (level * np.sin(2 * np.pi * hz * np.arange(n) / rate)).astype(np.float32)


def with_run(n: int, *runs: int) -> np.ndarray:
    """Zero-mean signal that is at its peak in runs of the given lengths, each answered by an equal negative run."""
    x = np.zeros(n, np.float32)
    x[::2], x[1::2] = 0.1, -0.1
    at = 100
    for length in runs:
        # The runs of the two signs are apart, so neither joins another.
        x[at:at + length] = 1.0
        at += length + 100
        x[at:at + length:1] = -0.9
        x[at + length] = 0.0
        at += length + 100
    return x - 0  # the stage centres the signal itself


def wav(samples: np.ndarray, rate: int = 16000, fmt: str = "s16") -> bytes:
    """RIFF/WAVE bytes; ``samples`` is frames or frames x channels."""
    x = np.asarray(samples, np.float64)
    channels = 1 if x.ndim == 1 else x.shape[1]
    x = x.ravel()
    if fmt == "u8":
        tag, bits, body = 1, 8, np.round(x * 127 + 128).astype("u1").tobytes()
    elif fmt == "s16":
        tag, bits, body = 1, 16, np.round(x * 32767).astype("<i2").tobytes()
    elif fmt == "s24":
        whole = np.round(x * (2**23 - 1)).astype("<i4")
        tag, bits, body = 1, 24, whole.view("u1").reshape(-1, 4)[:, :3].tobytes()
    elif fmt == "s32":
        tag, bits, body = 1, 32, np.round(x * (2**31 - 1)).astype("<i4").tobytes()
    else:
        tag, bits, body = 3, 32, x.astype("<f4").tobytes()
    block = channels * bits // 8
    head = struct.pack("<4sI4s4sIHHIIHH", b"RIFF", 36 + len(body), b"WAVE", b"fmt ", 16, tag, channels, rate, rate * block, block, bits)
    return head + struct.pack("<4sI", b"data", len(body)) + body


def measures(x: np.ndarray, clip_amp: float = 0.999) -> dict:
    """The metrics computed plainly, one signal at a time."""
    x = np.asarray(x, np.float64)
    y = (x - x.mean()).astype(np.float32)
    top = np.abs(y).max()
    y = (y / top if top > 0 else y).astype(np.float64)
    power = np.mean(y**2)
    quiet = np.sort(np.abs(y))[:max(1, len(y) // 10)]
    run = best = 0
    for v in np.abs(y.astype(np.float32)):
        run = run + 1 if v >= np.float32(clip_amp) else 0
        best = max(best, run)
    return {
        "snr_db": 10 * np.log10(max(power, 1e-10) / max(np.mean(quiet**2), 1e-10)),
        "rms_db": 20 * np.log10(np.sqrt(power)) if power > 0 else -120.0,
        "max_clip_run": best,
    }
