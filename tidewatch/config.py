"""Parameters of the detector."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class Metric:
    """A metric of the wide source: its name and its pair of columns."""

    name: str
    date_col: str
    value_col: str


#: The source layout that detectors are configured for by default.
DEFAULT_METRICS = (
    Metric("ENVIOS", "fecha_envio_hora_dt", "envios_val"),
    Metric("OPENS", "fecha_open_hora_dt", "opens_val"),
    Metric("CLICKS", "fecha_click_hora_dt", "clicks_val"),
)
#: Output dimension, its source column and what stands for a missing value.
DEFAULT_DIMENSIONS = (
    ("canal_dsc", "canal_dsc", "SIN CANAL"),
    ("flujo_dsc", "flujo_dsc", "SIN FLUJO"),
    ("productos_dsc", "productos_dsc", "SIN PRODUCTO"),
    ("objetivo_dsc", "objetivos_dsc", "SIN OBJETIVO"),
)
#: Labels of the days of the week, Monday first.
WEEKDAYS = ("Lun", "Mar", "Mie", "Jue", "Vie", "Sab", "Dom")

BASE_WINDOWS = (6, 12, 18, 24)
CLUSTER_WINDOWS = (6,)


def previous_month(today: date) -> int:
    """The calendar month before ``today`` as yyyymm."""
    index = today.year * 12 + today.month - 2
    return index // 12 * 100 + index % 12 + 1


@dataclass(frozen=True)
class DetectorConfig:
    """One run: evaluation month, look-back windows, thresholds and the column mapping.

    The evaluation month itself is not scored; a window of W months is the W
    calendar months before it.
    """

    eval_month: int = 202606
    windows: tuple[int, ...] = BASE_WINDOWS
    log_scale: bool = True
    iqr_factor: float = 1.5
    mad_threshold: float = 3.5
    min_months: int = 4
    use_clustering: bool = True
    min_months_cluster: int = 6
    k_max: int = 5
    gap_factor: float = 1.0
    max_outlier_share: float = 0.40
    percentile_tolerance: float = 0.50
    floor: float = 1e-9
    #: "exact" (expressions), "grouped" (the whole decision in Python workers, a series at a time) or "iterative" (a solver of another kind, to check the first by).
    solver: str = "exact"
    #: Files of each stored partition are dealt by series into so many buckets; 0 deals them not at all.
    buckets: int = 16
    metrics: tuple[Metric, ...] = DEFAULT_METRICS
    dimensions: tuple[tuple[str, str, str], ...] = DEFAULT_DIMENSIONS

    def __post_init__(self) -> None:
        if not 1 <= self.eval_month % 100 <= 12 or self.eval_month < 190001:
            raise ValueError(f"eval_month must be yyyymm, not {self.eval_month}")
        if not self.windows or min(self.windows) < 1:
            raise ValueError("windows must be positive numbers of months")
        if self.solver not in ("exact", "grouped", "iterative"):
            raise ValueError(f"unknown solver {self.solver}")
        if self.k_max < 1 or self.min_months < 1 or not self.metrics:
            raise ValueError("k_max, min_months and metrics must not be empty or under one")

    @property
    def eval_index(self) -> int:
        """Months since year zero."""
        return self.eval_month // 100 * 12 + self.eval_month % 100

    @property
    def cell(self) -> tuple[str, ...]:
        """The key of a series."""
        return ("metrica", *(d for d, _, _ in self.dimensions), "dia_semana")

    @property
    def date_range(self) -> tuple[date, date]:
        """First day in the longest window, and the first day after it."""
        last = self.eval_index - 1
        first = last - max(self.windows)
        return date(first // 12, first % 12 + 1, 1), date(last // 12, last % 12 + 1, 1)

    def for_previous_month(self, today: date) -> DetectorConfig:
        """The same run, evaluated at the calendar month before ``today``."""
        return replace(self, eval_month=previous_month(today))
