"""Waveform expressions on ``array<…>`` columns.

These stay inside the JVM and suit short arrays and single measures. Whole tracks go through the
Arrow path of ``operators.waveforms``, which is several times faster per sample than array lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import seconds

# 16-bit sample range.
PCM_MAX = 32767
PCM_MIN = -32768


def gain(audio: Column, volume: Column | float) -> Column:
    factor = volume if isinstance(volume, Column) else F.lit(float(volume))
    return F.transform(audio, lambda x: x * factor)


def trim_start(audio: Column, samples: Column) -> Column:
    """Drop samples from the start; nothing is left if there are not more."""
    return F.slice(audio, (samples + 1).cast("int"), F.greatest(F.size(audio) - samples, F.lit(0)).cast("int"))


def silence(samples: Column) -> Column:
    return F.array_repeat(F.lit(0.0), samples.cast("int"))


def power(audio: Column) -> Column:
    """Mean square; null for an empty array."""
    total = F.aggregate(audio, F.lit(0.0), lambda acc, x: acc + x * x)
    return F.when(F.size(audio) > 0, total / F.size(audio))


def peak(audio: Column) -> Column:
    return F.array_max(F.transform(audio, F.abs))


def limit_peak(audio: Column, limit: float = 1.0) -> Column:
    """Divide by the peak if it exceeds the limit."""
    top = peak(audio)
    return F.when(top > F.lit(limit), F.transform(audio, lambda x: x / top)).otherwise(audio)


def snr_scale(signal: Column, noise: Column, snr_db: Column) -> Column:
    """Factor that brings the noise to the wanted ratio; null if the noise is silent."""
    wanted = power(signal) / F.pow(F.lit(10.0), snr_db / 10.0)
    return F.when(power(noise) > 0, F.sqrt(wanted / power(noise)))


def snr_mix(signal: Column, noise: Column, scale: Column) -> Column:
    """Signal plus scaled noise, peak limited; the signal itself if the noise is silent."""
    noisy = F.zip_with(signal, noise, lambda x, y: x + scale * y)
    return F.when(scale.isNotNull(), limit_peak(noisy)).otherwise(signal)


def snr_reached(signal: Column, noise: Column, scale: Column) -> Column:
    """Measured ratio in decibels; infinite if the scaled noise is silent."""
    left = power(F.transform(noise, lambda y: y * scale))
    return F.when(left > 0, 10.0 * F.log10(power(signal) / left)).otherwise(F.lit(float("inf")))


def pcm16(audio: Column) -> Column:
    """Round trip through 16-bit samples: scale, round, clip, scale back."""
    def step(x: Column) -> Column:
        level = F.greatest(F.lit(float(PCM_MIN)), F.least(F.lit(float(PCM_MAX)), F.round(x * F.lit(float(PCM_MAX)))))
        return level / F.lit(float(-PCM_MIN))
    return F.transform(audio, step)


def duration(audio: Column, sampling_rate: int) -> Column:
    return seconds(F.size(audio).cast("bigint"), sampling_rate)


def micro(audio: Column) -> Column:
    """Samples as comma-separated integer millionths: an exact, engine-neutral form for comparison."""
    return F.array_join(F.transform(audio, lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string")), ",")
