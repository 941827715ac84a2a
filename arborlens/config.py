"""Names, code sets and thresholds of the forest census; all are configuration."""

from __future__ import annotations

from dataclasses import dataclass

# Tree status codes.
ALIVE = ("AI", "AB", "DAB", "AL", "ALM", "AU", "AC")
DEAD = ("DB", "DI", "DU", "SH", "DP", "NN", "NIC", "BLS")

# Which verified collision keyword excuses which rule.
EXCUSES = {"Species": "203", "Revive": "308", "Shrinking": "313", "Increase": "314"}

# Colours of crews on the map; trees without a diameter are grey.
CREW_COLOURS = {"Cerveny": "red", "Duhovy": "violet", "Modry": "blue3", "Zeleny": "green"}
UNMEASURED_COLOUR = "grey80"


@dataclass(frozen=True)
class Census:
    """Thresholds, names and layers of one site. Profiles: which optional groups of rules run.

    ``columns`` says what a site calls the columns that the library names in its own words, as pairs
    (the library's name, the site's); those not listed are called the same.
    """

    duplicate_distance: float = 0.01
    largest_growth: float = 150
    boundary_buffer: float = 5.0
    least_snag_height: float = 1.3
    rekey_base: int = 5000
    tag_ranges: tuple[tuple[int, int], ...] = ((1, 500), (501, 1000), (1001, 1500))
    profile: tuple[str, ...] = ("core",)
    columns: tuple[tuple[str, str], ...] = ()
    standing_layer: str = "standing"
    lying_layer: str = "lying"
    errors_layer: str = "ERRORS"

    def __post_init__(self) -> None:
        for side in zip(*self.columns, strict=True):
            if len({name.lower() for name in side}) < len(side):
                raise ValueError("a column has two names, or two columns have one")
