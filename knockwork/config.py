"""Parameters of an analysis."""

from __future__ import annotations

from dataclasses import dataclass, field

#: What counts as true in the lenient reading, and as true or false in the strict one.
TRUE = ("true", "t", "1", "yes", "y")
FALSE = ("false", "f", "0", "no", "n")


def lenient_bool(value: object) -> bool:
    """True for the words of ``TRUE``, false for anything else."""
    return str(value).strip().lower() in TRUE


def strict_bool(value: object) -> bool:
    """As ``lenient_bool``, but what is neither true nor false is an error."""
    said = str(value).strip().lower()
    if said not in TRUE + FALSE:
        raise ValueError(f"not a boolean: {value!r}")
    return said in TRUE


@dataclass(frozen=True)
class ScreenConfig:
    """``targets`` None: every label but the control."""

    control: str = "ONE_INTERGENIC_SITE"
    targets: tuple[str, ...] | None = None
    target_col: str = "target"
    guide_col: str | None = None
    split_by: str | None = None
    max_features: int | None = 60609
    subset: bool = True
    ndims: int = 30
    num_neighbors: int = 20
    min_de_genes: int = 0
    max_de_genes: int = 100
    logfc_threshold: float = 0.0
    min_pct: float = 0.0
    min_cells_group: int = 10
    pseudocount: float = 1.0
    base: float = 2.0
    subsample: bool = False
    full_results: bool = False
    store_neighbors: bool = False
    exclude_self: bool = False
    max_control_cells: int | None = None
    bh_universe: int | None = None
    variable_features: int = 2000
    min_npcs: int = field(default=50, repr=False)

    def __post_init__(self) -> None:
        if not self.control:
            raise ValueError("a control label is needed")
        if self.num_neighbors < 1 or self.ndims < 1:
            raise ValueError("num_neighbors and ndims start at 1")
