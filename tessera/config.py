"""Parameters of the relatedness pipeline, checked when they are made."""

from __future__ import annotations

import math
from dataclasses import dataclass, field


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class QualityControl:
    min_maf: float = 0.01
    max_variant_missingness: float = 0.0

    def __post_init__(self) -> None:
        _need(0 <= self.min_maf <= 0.5, "min_maf must be between 0 and 0.5")
        _need(0 <= self.max_variant_missingness <= 1, "max_variant_missingness must be between 0 and 1")


@dataclass(frozen=True)
class Detection:
    """min_seed, min_extend and min_output in centimorgans, max_gap in base pairs (-1: none)."""

    min_seed: float = 2.0
    min_extend: float = 1.0
    min_output: float = 2.0
    min_markers: int = 100
    min_mac: int = 2
    max_gap: int = 1000

    def __post_init__(self) -> None:
        _need(self.min_seed > 0, "min_seed must be positive")
        _need(0 < self.min_extend <= self.min_seed, "min_extend must be positive and at most min_seed")
        _need(self.min_output > 0, "min_output must be positive")
        _need(self.min_markers >= 1 and self.min_mac >= 1, "min_markers and min_mac must be at least 1")
        _need(self.max_gap >= -1, "max_gap must be at least -1")


@dataclass(frozen=True)
class Summary:
    threshold: float = 5.0
    compat_text: bool = False

    def __post_init__(self) -> None:
        _need(math.isfinite(self.threshold) and self.threshold >= 0, "threshold must be finite and not negative")


@dataclass(frozen=True)
class Clustering:
    methods: tuple[str, ...] = ("louvain", "leiden")
    depth: int = 3
    weight_column: str = "total_IBD_length_cM"
    min_cluster_size: int = 20
    resolution: float = 1.0
    #: Accepted from older configurations and checked; changes nothing.
    min_modularity_gain: float = 0.0

    def __post_init__(self) -> None:
        _need(set(self.methods) <= {"louvain", "leiden"}, "methods are louvain and leiden")
        _need(self.depth >= 1, "depth must be at least 1")
        _need(self.min_cluster_size >= 2, "min_cluster_size must be at least 2")
        _need(self.resolution > 0, "resolution must be positive")
        _need(self.min_modularity_gain >= 0, "min_modularity_gain must not be negative")


@dataclass(frozen=True)
class Clumping:
    enabled: bool = True
    min_maf: float = 0.05
    max_missingness: float = 0.02
    hwe: float = 1e-6
    window_kb: int = 1000
    step: int = 1
    r2: float = 0.1
    threshold: float = 0.0005
    min_cluster_size: int = 15

    def __post_init__(self) -> None:
        _need(0 <= self.min_maf <= 0.5 and 0 <= self.max_missingness <= 1, "frequencies must be in range")
        _need(0 < self.hwe <= 1, "hwe must be above 0 and at most 1")
        _need(self.step == 1, "step must be 1: windows are of kilobases, and every pair inside one is looked at")
        _need(self.window_kb >= 1 and 0 < self.r2 < 1, "window_kb must be at least 1 and r2 between 0 and 1")
        _need(self.threshold >= 0 and self.min_cluster_size >= 2, "threshold must not be negative, min_cluster_size at least 2")


@dataclass(frozen=True)
class Parameters:
    qc: QualityControl = field(default_factory=QualityControl)
    detection: Detection = field(default_factory=Detection)
    summary: Summary = field(default_factory=Summary)
    clustering: Clustering = field(default_factory=Clustering)
    clumping: Clumping = field(default_factory=Clumping)
    remove_gaps: bool = True


def parse_boolean(value: str) -> bool:
    """true or false in any case; anything else is an error."""
    if value.lower() not in ("true", "false"):
        raise ValueError(f"neither true nor false: {value!r}")
    return value.lower() == "true"
