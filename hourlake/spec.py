"""What one hourly feed looks like: its metrics, window and naming rules."""

from __future__ import annotations

from dataclasses import dataclass

# The default feed. Results only match when these do.
DEFAULT_METRICS = ("european_aqi", "pm10", "pm2_5", "nitrogen_dioxide")
PAST_DAYS = 2
FORECAST_DAYS = 1
HOURS_PER_DAY = 24
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm"
TIMEZONE = "UTC"
MAX_ATTEMPTS = 3
# End of fixed values.


@dataclass(frozen=True)
class HourlySpec:
    """Parameters shared by every operator.

    ``peak_metric`` is the metric whose daily maximum gets a timestamp. With ``reject_nan``
    a NaN reading is invalid; by default it is valid, since NaN sorts above every number.
    """

    metrics: tuple[str, ...] = DEFAULT_METRICS
    peak_metric: str = DEFAULT_METRICS[0]
    past_days: int = PAST_DAYS
    forecast_days: int = FORECAST_DAYS
    hours_per_day: int = HOURS_PER_DAY
    timestamp_format: str = TIMESTAMP_FORMAT
    timezone: str = TIMEZONE
    max_attempts: int = MAX_ATTEMPTS
    reject_nan: bool = False

    def __post_init__(self):
        if not self.metrics:
            raise ValueError("a feed needs at least one metric")
        if self.peak_metric not in self.metrics:
            raise ValueError(f"peak metric {self.peak_metric!r} is not among {self.metrics}")

    @property
    def expected_length(self) -> int:
        """Elements every array of one document must have."""
        return (self.past_days + self.forecast_days) * self.hours_per_day

    @property
    def flags(self) -> tuple[str, ...]:
        """All validity flags, the timestamp's first."""
        return ("is_valid_measurement_timestamp", *map(flag, self.metrics))


def array_column(metric: str) -> str:
    return f"{metric}_array"


def flag(metric: str) -> str:
    return f"is_valid_{metric}"


DEFAULT_SPEC = HourlySpec()
