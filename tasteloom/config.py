"""Settings shared by every job: one frozen object instead of module globals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # fixed values: defaults that must match the published evaluation protocol
    recent_from_year: int = 2019
    kcore_user: int = 5
    kcore_item: int = 5
    max_interactions: int = 5_000_000
    positive_rating: float = 4.0
    val_quantile: float = 0.85
    test_quantile: float = 0.90
    k_values: tuple[int, ...] = (10, 20, 50)
    candidates: int = 100
    retrieve: int = 200
    max_history: int = 20
    seed: int = 42
    # sizing knobs of this library
    broadcast_bytes: int = 128 * 1024 * 1024
    vector_block: int = 16_384             # vectors per block of the blocked top-N
    score_bytes: int = 64 * 1024 * 1024    # one score matrix inside a task


DEFAULTS = Settings()

# activity buckets (low, high) of the cold-start report; None is open-ended
BUCKET_EDGES: tuple[tuple[int, int | None], ...] = ((1, 4), (5, 19), (20, None))
