"""Number expressions: durations, speeds, token counts, deltas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Samples a second, and seconds of the longest clip.
SAMPLE_RATE, MAX_CLIP_SECONDS = 16_000, 30.0


def duration(samples: Column, rate: Column | int = SAMPLE_RATE) -> Column:
    return samples.cast("double") / rate


def real_time_factor(seconds: Column, wall: Column) -> Column:
    """Seconds of audio per second of work, to three places; null without a positive time."""
    return F.when(wall > 0, F.round(seconds / wall, 3))


def halve(frames: Column) -> Column:
    return F.floor((frames - 1) / 2) + 1


def soft_tokens(frames: Column, cap: int) -> Column:
    """Tokens of a clip of so many frames: halved twice, at most ``cap``; none without frames."""
    return F.when(frames > 0, F.least(halve(halve(frames)), F.lit(cap).cast("long"))).otherwise(F.lit(0).cast("long"))


def delta(tuned: Column, base: Column, most: float = 0.02) -> Column:
    """(delta, ok): how far a rate rose, and whether that is within ``most``; a missing rate fails."""
    return F.struct((tuned - base).alias("delta"), F.coalesce(tuned - base <= most, F.lit(False)).alias("ok"))
