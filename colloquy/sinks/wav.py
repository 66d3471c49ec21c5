"""One WAV file per track, written by the tasks."""

from __future__ import annotations

import os
import wave
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def write_wav_files(tracks: DataFrame, folder: str, sampling_rate: int) -> DataFrame:
    """Write ``audio`` of each row below ``folder`` under its ``audio_path``; returns the manifest.

    ``folder`` must be shared storage every executor mounts. Files appear under their final name
    only when complete, and a retried task writes the same bytes again. Empty audio is refused.
    """
    place = urlparse(folder)
    if place.scheme not in ("", "file"):
        raise ValueError(f"{folder} is not a mounted folder")
    folder = place.path

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written = []
            audio = batch.column("audio")
            for i, path in enumerate(batch.column("audio_path").to_pylist()):
                samples = audio[i].values.to_numpy(zero_copy_only=False)
                if not len(samples):
                    raise ValueError(f"no audio for {path}")
                levels = np.clip(np.round(samples.astype(np.float64) * 32767.0), -32768, 32767).astype("<i2")
                target = os.path.join(folder, path)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                partial = f"{target}.{os.getpid()}.part"
                with wave.open(partial, "wb") as out:
                    out.setnchannels(1)
                    out.setsampwidth(2)
                    out.setframerate(sampling_rate)
                    out.writeframes(levels.tobytes())
                written.append(os.path.getsize(partial))
                os.replace(partial, target)
            yield pa.RecordBatch.from_arrays(
                [batch.column("track_id"), batch.column("audio_path"), pa.array(written, pa.int64())],
                ["track_id", "audio_path", "bytes"],
            )

    return tracks.select("track_id", "audio_path", "audio").mapInArrow(
        write, "track_id bigint, audio_path string, bytes bigint"
    )
