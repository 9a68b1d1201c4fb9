"""Import every query module so the registry is complete."""

from homesense.plans import (q_joins, q_legacy, q_recipes, q_resample, q_scalars, q_segments,  # noqa: F401
                             q_sequences, q_sources, q_stats)
from homesense.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
