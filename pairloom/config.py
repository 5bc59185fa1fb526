"""Settings of a run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PairConfig:
    """How the pair table is computed."""

    literature_only: bool = True
    excluded_tids: tuple[int, ...] = (22226,)  # fixed value: the target of unchecked records
    min_pairs_bf: int = 100
    min_pairs_b: int = 100
    descriptors: bool = False
    hot_values: int | None = None  # different values of a pair beyond which its median is selected over all tasks

    @property
    def source_label(self) -> str:
        return "literature_only" if self.literature_only else "all_sources"

    def min_pairs(self, suffix: str) -> int:
        return self.min_pairs_bf if suffix == "BF" else self.min_pairs_b


@dataclass(frozen=True)
class OutputConfig:
    """Which artifacts are written, and where."""

    path: str
    release: str = "snapshot"
    delimiter: str = ";"
    write_full: bool = True
    write_bf: bool = False
    write_b: bool = False
    write_sizes: bool = False
