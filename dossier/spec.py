"""What the operators need to know about a statement table."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the statement and label files users already have.
DEFAULT_ID = "customer_ID"
DEFAULT_DATE = "S_2"
DEFAULT_TARGET = "target"
DEFAULT_CATEGORICALS = (
    "B_30", "B_38", "D_114", "D_116", "D_117", "D_120",
    "D_126", "D_63", "D_64", "D_66", "D_68",
)
MISSING_LEVEL = "NaN"
DEFAULT_SEED = 42
FEATURE_VERSION = 2


@dataclass(frozen=True)
class EntitySpec:
    """Column roles of a statement table and the constants tied to it.

    ``date_unit`` says how fine ``date_col`` is: ``"day"`` for dates, ``"micro"``
    for full timestamps. ``seq_col`` is an integer that orders rows sharing a
    date; without one, such rows are ordered by a hash of their content, which
    is stable under reordering and retries.
    ``ratios`` are integer weights, in the order the splits are cut.
    """

    id_col: str = DEFAULT_ID
    date_col: str | None = DEFAULT_DATE
    seq_col: str | None = None
    target_col: str = DEFAULT_TARGET
    cat_cols: tuple[str, ...] = DEFAULT_CATEGORICALS
    missing_level: str = MISSING_LEVEL
    seed: int = DEFAULT_SEED
    date_unit: str = "day"
    ratios: dict[str, int] = field(
        default_factory=lambda: {"train": 7, "validation": 2, "test": 1})

    @property
    def order_cols(self) -> list[str]:
        return [c for c in (self.date_col, self.seq_col) if c]

    def numeric_cols(self, columns: list[str]) -> list[str]:
        """Everything that is not an id, an ordering column or a category."""
        taken = {self.id_col, *self.order_cols, *self.cat_cols}
        return [c for c in columns if c not in taken]

    def require(self, columns: list[str]) -> None:
        """Raise, naming the columns a statement table lacks."""
        wanted = [self.id_col, *self.order_cols, *self.cat_cols]
        absent = [c for c in wanted if c not in columns]
        if absent:
            raise KeyError(f"a statement table needs {wanted}; this one lacks {absent}")
