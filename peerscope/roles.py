"""Column-role binding and scoring parameters shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each role in a listing panel table."""

    entity: str = "listing_id"
    snapshot: str = "snapshot_date"
    city: str = "city_name"
    neighbourhood: str = "neighbourhood_name"
    period: str = "period_label"
    category: str = "room_type"
    price: str = "nightly_price"
    latitude: str = "latitude"
    longitude: str = "longitude"
    capacity: str = "accommodates_count"
    beds: str = "beds_count"
    bedrooms: str = "bedrooms_count"
    rating: str = "rating_score"

    @property
    def key(self) -> list[str]:
        return [self.entity, self.snapshot]

    @property
    def city_pool(self) -> list[str]:
        return [self.city, self.period, self.category]

    @property
    def local_pool(self) -> list[str]:
        return [self.city, self.period, self.category, self.neighbourhood]

    def with_period(self, period: str) -> "Roles":
        return Roles(**{**self.__dict__, "period": period})


@dataclass(frozen=True)
class SimilarityWeights:
    """Weights and tolerances of the comparable-listing similarity score.

    Fixed values that must equal the reference's scoring rule:
    base 2.0, local-pool bonus 3.0, capacity 2.0 (tolerance 2), beds 1.0
    (tolerance 2), bedrooms 1.0 (tolerance 2), rating 0.75 (tolerance 10),
    distance 1.25 with decay exp(-km / 3).
    """

    base: float = 2.0
    local_bonus: float = 3.0
    capacity: float = 2.0
    capacity_tolerance: float = 2.0
    beds: float = 1.0
    beds_tolerance: float = 2.0
    bedrooms: float = 1.0
    bedrooms_tolerance: float = 2.0
    rating: float = 0.75
    rating_tolerance: float = 10.0
    distance: float = 1.25
    distance_scale_km: float = 3.0


@dataclass(frozen=True)
class ComparableSearch:
    """Parameters of the comparable search (pool rule, top-N, grid tuning)."""

    top_n: int = 10
    min_local_pool: int = 5
    weights: SimilarityWeights = field(default_factory=SimilarityWeights)
    # Pools with at most this many scorable rows are searched as one; larger ones are cut into
    # spatial cells of about ``rows_per_shard`` rows, with edges of ``min_cell_km`` at least.
    # They change speed only, never the result.
    direct_pool_limit: int = 262_144
    rows_per_shard: int = 8192
    min_cell_km: float = 0.05
