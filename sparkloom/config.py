"""Typed configuration with defaults; unknown keys raise."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    # Scoring
    default_content_type: str = "default"
    sigmoid_k: float = 10.0
    sigmoid_center: float = 0.5
    wilson_z: float = 1.96
    min_quality: float = 0.3
    # De-duplication
    simhash_threshold: int = 3
    minhash_threshold: float = 0.5
    cosine_threshold: float = 0.95
    num_perm: int = 128
    seed: int = 42
    # Extraction
    min_text: int = 100
    max_text: int = 100_000
    # Monitoring
    gini_threshold: float = 0.6
    orphan_threshold: int = 100
    orphan_rate_threshold: float = 0.3
    # Exploration
    lonely_distance: float = 0.20
    max_gaps: int = 10

    def with_(self, **changes) -> Config:
        known = {f.name for f in fields(self)}
        if unknown := set(changes) - known:
            raise KeyError(f"unknown settings: {', '.join(sorted(unknown))}")
        return replace(self, **{k: v for k, v in changes.items() if v is not None})


DEFAULTS = Config()
