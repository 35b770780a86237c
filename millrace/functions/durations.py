"""Time text, granularities and window alignment."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

SECOND_MS = 1_000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS
WEEK_MS = 7 * DAY_MS

UNIT_MS = {
    "s": SECOND_MS, "second": SECOND_MS,
    "m": MINUTE_MS, "minute": MINUTE_MS,
    "h": HOUR_MS, "hour": HOUR_MS,
    "d": DAY_MS, "day": DAY_MS,
    "w": WEEK_MS,
}

_AGO = re.compile(r"([0-9]+)([smhdw])-ago")
_GRANULARITY = re.compile(r"([0-9]*)(second|minute|hour|day|[smhd])")


@dataclass(frozen=True)
class Granularity:
    """``count`` units of ``unit_ms`` milliseconds."""

    count: int
    unit_ms: int

    @property
    def ms(self) -> int:
        return self.count * self.unit_ms

    def align(self, start_ms: int) -> int:
        """Floor a start to one whole unit; windows are counted from there."""
        return start_ms // self.unit_ms * self.unit_ms

    def align_end(self, start_ms: int, end_ms: int) -> int:
        """Round an end up to a whole number of windows after the aligned start."""
        origin = self.align(start_ms)
        return origin + -(-(end_ms - origin) // self.ms) * self.ms

    def window(self, ts: Column, origin_ms: int) -> Column:
        """Start of the window holding ``ts``."""
        shifted = ts - F.lit(origin_ms)
        return ts - F.pmod(shifted, F.lit(self.ms))


def parse_granularity(text: str) -> Granularity:
    found = _GRANULARITY.fullmatch(text or "")
    if not found:
        raise ValueError(f"not a granularity: {text!r}")
    count = int(found.group(1) or 1)
    if count < 1:
        raise ValueError(f"granularity must be positive: {text!r}")
    return Granularity(count, UNIT_MS[found.group(2)])


def parse_duration(text: str) -> int:
    """Milliseconds of ``now``, ``N[smhdw]-ago`` or a granularity text."""
    if text == "now":
        return 0
    ago = _AGO.fullmatch(text or "")
    if ago:
        return int(ago.group(1)) * UNIT_MS[ago.group(2)]
    found = _GRANULARITY.fullmatch(text or "")
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    return int(found.group(1) or 1) * UNIT_MS[found.group(2)]


def resolve_time(value: int | str, now_ms: int | None = None) -> int:
    """Epoch milliseconds of a number, ``now`` or ``N[smhdw]-ago``."""
    if isinstance(value, str):
        if value != "now" and not _AGO.fullmatch(value):
            raise ValueError(f"not a point in time: {value!r}")
        now = int(time.time() * 1000) if now_ms is None else now_ms
        return now - parse_duration(value)
    return int(value)


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column, sub-millisecond part cut off."""
    return F.unix_millis(ts.cast("timestamp"))
