"""All registered queries; importing this package fills the registry."""

from tidemark.plans.queries import accounting, enrichment, physical, replay, streams, valence
from tidemark.plans.registry import REGISTRY

__all__ = ["REGISTRY", "accounting", "enrichment", "physical", "replay", "streams", "valence"]
