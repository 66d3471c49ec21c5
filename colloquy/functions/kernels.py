"""Small numpy kernels for whole waveforms, called inside Spark tasks.

Noise is counter based: sample ``i`` of a clip is a function of the clip's key and ``i`` alone, so a
retried task yields the same samples.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np

# Noise filter taps and noise parameters.
PINK_TAPS = (0.99886, 0.99332, 0.96900, 0.86650, 0.55000, 0.7616, -0.00360)
PINK_FEEDBACK = (-0.49448, 0.01681, 0.00972, 0.00001, -0.00360)
CROWD_WHITE = 0.7
CROWD_PINK = 0.3
SPIKE_EVERY = 100
SPIKE_RANGE = (2.0, 5.0)
HUM_HERTZ = 50.0
HUM_SPREAD = 5.0
HUM_HARMONICS = ((1, 1.0), (2, 0.3), (3, 0.1))

# Streams of one clip key, so that draws for different uses are independent.
_RADIUS, _ANGLE, _WHERE, _SIGN, _HEIGHT, _PITCH, _PINK_RADIUS, _PINK_ANGLE = range(8)
_FEEDBACK_LENGTH = 96


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def hash_counter(key: int, stream: int, n: int) -> np.ndarray:
    """32-bit hashes of the counters 0 .. n-1; distinct within a stream.

    The two halves of the 60-bit key enter by exclusive or before each of two rounds, so that no clip is a shifted
    part of another.
    """
    x = np.arange(n, dtype=np.uint32) * np.uint32(0x9E3779B9) + np.uint32((stream * 0x85EBCA6B) & 0xFFFFFFFF)
    x = _mixed(x ^ np.uint32(key >> 32))
    return _mixed(x ^ np.uint32(key & 0xFFFFFFFF))


def uniforms(key: int, stream: int, n: int) -> np.ndarray:
    """Uniform numbers strictly between 0 and 1."""
    return (hash_counter(key, stream, n) + 0.5) / 4294967296.0


def normals(key: int, n: int, radius: int = _RADIUS, angle: int = _ANGLE) -> np.ndarray:
    """Standard normal numbers (Box-Muller)."""
    return np.sqrt(-2.0 * np.log(uniforms(key, radius, n))) * np.cos(2.0 * np.pi * uniforms(key, angle, n))


def _feedback_response() -> np.ndarray:
    """Impulse response of the feedback filter; past the kept length it is below double precision."""
    h = np.zeros(_FEEDBACK_LENGTH)
    h[0] = 1.0
    for i in range(1, _FEEDBACK_LENGTH):
        h[i] = -sum(a * h[i - 1 - j] for j, a in enumerate(PINK_FEEDBACK) if i - 1 - j >= 0)
    return h


def pink(key: int, n: int) -> np.ndarray:
    """Filtered white noise, silent for the first taps; feedback applied as a convolution."""
    lead = len(PINK_TAPS) - 1
    if n <= lead:
        return np.zeros(n)
    forward = np.convolve(normals(key, n, _PINK_RADIUS, _PINK_ANGLE), PINK_TAPS)[:n]
    forward[:lead] = 0.0
    return np.convolve(forward, _feedback_response())[:n]


def _static(key: int, n: int) -> np.ndarray:
    x = normals(key, n)
    spikes = n // SPIKE_EVERY
    if spikes:
        at = np.argpartition(hash_counter(key, _WHERE, n), spikes - 1)[:spikes]
        sign = np.where(uniforms(key, _SIGN, n)[at] < 0.5, -1.0, 1.0)
        low, high = SPIKE_RANGE
        x[at] = sign * (low + (high - low) * uniforms(key, _HEIGHT, n)[at])
    return x


def _hum(key: int, n: int, sampling_rate: int) -> np.ndarray:
    hertz = HUM_HERTZ + (2.0 * uniforms(key, _PITCH, 1)[0] - 1.0) * HUM_SPREAD
    phase = 2.0 * np.pi * hertz * (np.arange(n) / sampling_rate)
    return sum(level * np.sin(phase * k) for k, level in HUM_HARMONICS)


def to_unit_peak(x: np.ndarray) -> np.ndarray:
    """Scale so that the largest absolute value is 1; silence stays."""
    peak = np.abs(x).max(initial=0.0)
    return x / peak if peak > 0 else x


Maker = Callable[[int, int, int], np.ndarray]

_MAKERS: dict[str, Maker] = {}


def register_noise(name: str, maker: Maker) -> None:
    """Make a kind of noise available by name; ``maker(key, n, sampling_rate)`` returns ``n`` samples of any peak."""
    _MAKERS[name] = maker


def unregister_noise(name: str) -> None:
    _MAKERS.pop(name, None)


def makers() -> dict[str, Maker]:
    """All kinds known now: plans hand them to their tasks, where nothing has been registered."""
    return dict(_MAKERS)


def _crowd(key: int, n: int, _: int) -> np.ndarray:
    return CROWD_WHITE * normals(key, n) + CROWD_PINK * to_unit_peak(pink(key, n))


register_noise("white", lambda key, n, _: normals(key, n))
register_noise("pink", lambda key, n, _: pink(key, n))
register_noise("brown", lambda key, n, _: np.cumsum(normals(key, n)))
register_noise("crowd", _crowd)
register_noise("cafe", _crowd)
register_noise("static", lambda key, n, _: _static(key, n))
register_noise("hum", _hum)


def noise(kind: str, key: int, n: int, sampling_rate: int, known: Mapping[str, Maker] | None = None) -> np.ndarray:
    """``n`` samples of noise with unit peak; unknown kinds are white."""
    known = _MAKERS if known is None else known
    return to_unit_peak(known.get(kind, known["white"])(key, n, sampling_rate))


def limit_peak(x: np.ndarray, limit: float = 1.0) -> np.ndarray:
    """Divide by the peak if it exceeds the limit."""
    peak = np.abs(x).max(initial=0.0)
    return x / peak if peak > limit else x


def mix_at_snr(signal: np.ndarray, added: np.ndarray, snr_db: float) -> tuple[np.ndarray, float]:
    """Add noise at a signal-to-noise ratio; returns the peak-limited mix and the ratio reached."""
    noise_power = float(np.mean(added**2))
    if noise_power == 0:
        return signal, float("inf")
    signal_power = float(np.mean(signal**2))
    scaled = added * np.sqrt(signal_power / 10.0 ** (snr_db / 10.0) / noise_power)
    scaled_power = float(np.mean(scaled**2))
    reached = 10.0 * np.log10(signal_power / scaled_power) if scaled_power > 0 else float("inf")
    return limit_peak(signal + scaled), reached


def lay_pieces(
    total: int,
    chunks: list[np.ndarray],
    position: np.ndarray,
    gain: np.ndarray,
    half_tail: np.ndarray,
    block: np.ndarray,
) -> np.ndarray:
    """Add the gained chunks at their positions.

    The last ``half_tail`` samples of a chunk count half (they share the place with the next segment's
    head). Chunks of the same non-negative ``block`` form one mix whose peak is limited first.
    """
    out = np.zeros(total)
    mixes: dict[int, tuple[int, np.ndarray]] = {}
    for chunk, at, g, tail, b in zip(chunks, position, gain, half_tail, block):
        x = chunk.astype(np.float64) * g
        if tail:
            x[len(x) - tail:] *= 0.5
        if b >= 0:
            mixes[b] = (at, mixes[b][1] + x) if b in mixes else (at, x)
        else:
            out[at:at + len(x)] += x
    for at, x in mixes.values():
        out[at:at + len(x)] += limit_peak(x)
    return out
