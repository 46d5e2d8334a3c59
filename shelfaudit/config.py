"""Thresholds and choices of a quality-control run."""

from __future__ import annotations

from dataclasses import dataclass, field

# The characters profiled by default and their code points. The
# last one keeps its customary name although 255 is a letter in Latin-1; the
# Unicode no-break space is the separate NBSP_160.
CHARACTERS = {
    "space": 32,
    "horizontal_tab": 9,
    "vertical_tab": 11,
    "backspace": 8,
    "carriage_return": 13,
    "newline": 10,
    "formfeed": 12,
    "nonbreakingspace": 255,
}
NBSP_160 = {"nbsp_160": 160}
LINE_BREAKS = "\n\r"

# The largest relative loss each coverage measure may show.
LOSS_THRESHOLDS = {
    "item_count": -0.15,
    "client_units": -0.25,
    "rom_units": -0.25,
    "client_dollars": -0.25,
    "rom_dollars": -0.25,
}


@dataclass(frozen=True)
class QcConfig:
    """Parameters shared by the checks.

    ``focus_markets`` limits the coverage check; ``None`` covers every market.
    ``waive`` names coverage measures whose FAIL is expected, such as
    ``item_count`` for clients that price by item group.
    ``on_zero`` is ``"raise"`` or ``"skip"``: division by zero ends the run, or
    gives NULL; a row with zero price-weighted volume then leaves both sides of
    the index, so that the mean stays unbiased.
    ``trend_tolerance`` adds the trend check to the suite; it has no default.
    """

    focus_markets: tuple[str, ...] | None = None
    min_units: float = 10
    min_market_units: float = 0
    loss_thresholds: dict[str, float] = field(default_factory=lambda: dict(LOSS_THRESHOLDS))
    stability_tolerance: float = 0.03
    trend_tolerance: float | None = None
    waive: frozenset[str] = frozenset()
    on_zero: str = "raise"
    date_formats: tuple[str, ...] = ("yyyy-MM-dd", "M/d/yyyy")
    on_bad_date: str = "raise"
    collapse_labels: bool = False

    def __post_init__(self):
        unknown = (set(self.waive) | set(self.loss_thresholds)) - set(LOSS_THRESHOLDS)
        if unknown:
            raise ValueError(f"unknown coverage measures: {sorted(unknown)}")
        if missing := set(LOSS_THRESHOLDS) - set(self.loss_thresholds):
            raise ValueError(f"no threshold for: {sorted(missing)}")
        if self.on_zero not in ("raise", "skip"):
            raise ValueError(f"on_zero must be 'raise' or 'skip', not {self.on_zero!r}")
        if self.on_bad_date not in ("raise", "null"):
            raise ValueError(f"on_bad_date must be 'raise' or 'null', not {self.on_bad_date!r}")


DEFAULT = QcConfig()
