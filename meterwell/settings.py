"""Business thresholds and layout parameters, passed to operators as one value.

Fixed values: the defaults are the thresholds and the layout of the reports' contract.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Wide-table layout. Labels are in calendar order, so a month's predecessor
    # is its left neighbour.
    months: tuple[tuple[str, str], ...] = (
        ("_6", "2014-06"),
        ("_7", "2014-07"),
        ("_8", "2014-08"),
        ("_9", "2014-09"),
    )
    static_columns: tuple[str, ...] = ("mobile_number", "circle_id", "aon")
    skipped_metrics: frozenset[str] = frozenset({"last_date_of_month"})

    # Customer value bands and usage labels.
    arpu_high: float = 500.0
    arpu_medium: float = 200.0
    heavy_call_minutes: float = 500.0
    heavy_data_mb: float = 1024.0

    # Month-over-month decline.
    decline_alert: float = 0.5
    decline_critical: float = 0.8

    # Region score: weights of the three 0-100 scores, and the score given when
    # every region of a month has the same value.
    weight_arpu: float = 0.4
    weight_activity: float = 0.35
    weight_data: float = 0.25
    flat_score: float = 50.0

    # Windowed churn-risk rules.
    window_seconds: int = 300
    lateness_seconds: int = 10
    silent_critical: float = 0.3
    silent_warning: float = 0.15
    zero_call_warning: float = 0.2
    zero_data_warning: float = 0.3
    high_value_silent: float = 0.1
    high_value_min_count: int = 5
    window_arpu_drop: float = 0.5

    # Reports.
    extract_rows: int = 500
    chart_sample_rows: int = 5000
    chart_sample_seed: int = 42
    chart_max_calls: float = 2000.0
    chart_max_data: float = 5000.0
    chart_bubble_scale: float = 50.0

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.months)

    def previous(self) -> dict[str, str | None]:
        """Month label -> label of the month before it, None for the first."""
        return dict(zip(self.labels, (None, *self.labels[:-1])))

    def labels_for(self, suffixes: list[str] | str | None) -> tuple[str, ...]:
        """Labels of month suffixes given as ["_7", "_8"] or as the text "7,8"."""
        if suffixes is None:
            return self.labels
        if isinstance(suffixes, str):
            suffixes = ["_" + part.strip() for part in suffixes.split(",")]
        by_suffix = dict(self.months)
        return tuple(by_suffix[s] for s in suffixes)


DEFAULTS = Settings()
