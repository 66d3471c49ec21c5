"""All knobs of a run in one immutable value."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults of the workload this library has to reproduce.
SAMPLING_RATE = 16_000
END_RESERVE_SAMPLES = 1_000
ROW_OVERHEAD_BYTES = 1_000
MIN_SPEAKER_SECONDS = 3.0
MAX_SPEAKER_SHARE = 0.4
NOISE_TYPES = ("white", "pink", "brown", "crowd", "cafe", "static", "hum")
PATTERN_WEIGHTS = (
    ("dialogue", 0.4),
    ("monologue", 0.2),
    ("group_discussion", 0.2),
    ("interview", 0.2),
)

_RANGES = (
    ("min_duration", "max_duration"),
    ("pause_min_ms", "pause_max_ms"),
    ("long_pause_min", "long_pause_max"),
    ("volume_min", "volume_max"),
    ("overlap_min", "overlap_max"),
    ("simultaneous_min", "simultaneous_max"),
    ("snr_min", "snr_max"),
)
_POSITIVE = (
    "sampling_rate", "min_duration", "pause_min_ms", "long_pause_min", "short_max_duration",
    "target_count", "volume_min", "simultaneous_min", "snr_max", "id_block",
)
_SHARES = (
    "long_pause_probability", "short_probability", "overlap_probability", "overlap_min",
    "overlap_max", "simultaneous_probability", "noise_probability",
)


@dataclass(frozen=True)
class TrackParams:
    """Parameters of track generation; checked on construction.

    ``null_speaker`` says what happens to utterances without a speaker: ``"any"`` pools them with the
    whole dataset, ``"drop"`` leaves them out. ``id_block`` is the width of the id ranges used for
    distributed numbering (no numbering task ever holds more than that many rows); it does not
    change any result.
    """

    seed: int = 42
    sampling_rate: int = SAMPLING_RATE
    min_duration: float = 30.0
    max_duration: float = 60.0
    pause_min_ms: float = 200.0
    pause_max_ms: float = 1200.0
    long_pause_probability: float = 0.1
    long_pause_min: float = 2.0
    long_pause_max: float = 5.0
    end_reserve: int = END_RESERVE_SAMPLES
    short_probability: float = 0.2
    short_max_duration: float = 1.0
    target_count: int = 30
    volume_min: float = 0.7
    volume_max: float = 1.3
    overlap_probability: float = 0.3
    overlap_min: float = 0.1
    overlap_max: float = 0.3
    simultaneous_probability: float = 0.25
    simultaneous_min: float = 0.5
    simultaneous_max: float = 3.0
    noise_probability: float = 0.55
    noise_types: tuple[str, ...] = NOISE_TYPES
    snr_min: float = 10.0
    snr_max: float = 30.0
    pattern_weights: tuple[tuple[str, float], ...] = PATTERN_WEIGHTS
    null_speaker: str = "any"
    id_block: int = 1_000_000

    def __post_init__(self) -> None:
        for name in _POSITIVE:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in _SHARES:
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        for low, high in _RANGES:
            if getattr(self, high) <= getattr(self, low):
                raise ValueError(f"{high} must be greater than {low}")
        if not probabilities_ok(p for _, p in self.pattern_weights):
            raise ValueError("pattern weights must sum to 1")
        if not self.noise_types:
            raise ValueError("noise_types must not be empty")
        if self.null_speaker not in ("any", "drop"):
            raise ValueError("null_speaker must be 'any' or 'drop'")
        if int(self.simultaneous_min * self.sampling_rate) < 1:
            raise ValueError("simultaneous_min is shorter than one sample")
        if int(self.pause_min_ms * self.sampling_rate / 1000) < 1:
            raise ValueError("pause_min_ms is shorter than one sample")

    @property
    def short_max_samples(self) -> int:
        """Longest utterance, in samples, that counts as short."""
        return int(self.short_max_duration * self.sampling_rate)


def probabilities_ok(values) -> bool:
    """A probability table must sum to 1 within one hundredth."""
    return 0.99 <= sum(values) <= 1.01
