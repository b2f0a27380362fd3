"""Run parameters, checked once on the driver before any job starts."""

from __future__ import annotations

from dataclasses import dataclass, field

GADM_LEVELS = (1, 2, 3)


@dataclass(frozen=True)
class ImageryParams:
    """Thresholds of the before/after imagery check."""

    buffer_distance_m: float = 1000.0
    days_around: int = 30
    max_cloudy_percentage: float = 10.0
    burnt_pixel_count_threshold: int = 10
    max_nbr_after: float = -0.10
    min_nbr_difference: float = 0.15
    min_building_confidence: float = 0.75
    pixel_half_size_deg: float = 0.000045
    block_deg: float = 0.002
    tile_blocks: int = 500  # blocks along the side of a tile of the stored pixel table
    scene_cell_deg: float = 1.0

    def __post_init__(self):
        if self.buffer_distance_m <= 0:
            raise ValueError("buffer_distance_m must be positive")
        if self.days_around <= 0:
            raise ValueError("days_around must be positive")
        if self.tile_blocks <= 0:
            raise ValueError("tile_blocks must be positive")


@dataclass(frozen=True)
class Config:
    """Project settings.

    The ``*_literal`` style switches of the single operators are not kept here:
    they are arguments of the operators, so that a run states its choice.
    """

    country_id: str
    gadm_level: int = 3
    validation_lookback_days: int = 60
    retry_ages_days: tuple[int, ...] = (11, 16, 21)
    cluster_max_date_gap: int = 2
    cluster_max_distance_m: float | None = None
    settlement_max_distance_m: float = 10_000.0
    path_include: str | None = None
    path_exclude: str | None = None
    path_output: str | None = None
    cell_deg: float = 0.1
    link_date_buffer_days: int = 3
    imagery: ImageryParams = field(default_factory=ImageryParams)

    def __post_init__(self):
        if not self.country_id:
            raise ValueError("country_id must be set")
        if self.gadm_level not in GADM_LEVELS:
            raise ValueError("gadm_level must be 1, 2 or 3")
        if list(self.retry_ages_days) != sorted(set(self.retry_ages_days)):
            raise ValueError("retry_ages_days must rise from try to try")
        if self.cell_deg <= 0:
            raise ValueError("cell_deg must be positive")
        if self.validation_lookback_days < 0:
            raise ValueError("validation_lookback_days must not be negative")

    @property
    def admin_columns(self) -> list[str]:
        return [f"gadm_{n}" for n in GADM_LEVELS[: self.gadm_level]]
