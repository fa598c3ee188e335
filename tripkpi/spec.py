"""What one run is about: taxi colour, year, month, limits and locations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

# The names, codes and bounds below must stay as they are for results to match.

COLUMN_PREFIX = {"yellow": "tpep", "green": "lpep"}

COLOR_NAMES = {"Amarillo": "yellow", "Verde": "green"}

MONTH_NAMES = {
    "Enero": "01",
    "Febrero": "02",
    "Marzo": "03",
    "Abril": "04",
    "Mayo": "05",
    "Junio": "06",
    "Julio": "07",
    "Agosto": "08",
    "Septiembre": "09",
    "Octubre": "10",
    "Noviembre": "11",
    "Diciembre": "12",
}

ENGLISH_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)

PAYMENT_LABELS = {
    "yellow": {
        1: "Credit card",
        2: "Cash",
        3: "No charge",
        4: "Dispute",
        5: "Unknown",
        6: "Voided trip",
    },
    "green": {
        1: "Credit card",
        2: "Cash",
        3: "No charge",
        4: "Dispute",
        5: "Unknown",
    },
}

OTHER_PAYMENT = "Other / null"

# The years that a request may name.
FIRST_YEAR, LAST_YEAR = 2024, 2030

MAX_MINUTES = 24 * 60
MAX_DISTANCE = 100
MIN_PASSENGERS, MAX_PASSENGERS = 1, 6

# End of fixed values.


@dataclass(frozen=True)
class TripSpec:
    """One colour and month. Drives column names, period bounds, labels and paths."""

    color: str
    year: int
    month: int

    def __post_init__(self) -> None:
        if self.color not in COLUMN_PREFIX:
            raise ValueError(f"color must be one of {sorted(COLUMN_PREFIX)}, got {self.color!r}")
        if not 1 <= self.month <= 12:
            raise ValueError(f"month must be in 1..12, got {self.month!r}")

    @classmethod
    def from_request(cls, request: Mapping[str, object]) -> TripSpec:
        """Build a spec from ``{"mes": .., "anio": .., "color_taxi": ..}``.

        Month and colour may be the codes or the names a picker shows.
        """
        month, color = str(request["mes"]), str(request["color_taxi"])
        year = int(str(request["anio"]))
        if not FIRST_YEAR <= year <= LAST_YEAR:
            raise ValueError(f"year must be in {FIRST_YEAR}..{LAST_YEAR}, got {year!r}")
        return cls(
            color=COLOR_NAMES.get(color, color),
            year=year,
            month=int(MONTH_NAMES.get(month, month)),
        )

    @property
    def pickup_column(self) -> str:
        return f"{COLUMN_PREFIX[self.color]}_pickup_datetime"

    @property
    def dropoff_column(self) -> str:
        return f"{COLUMN_PREFIX[self.color]}_dropoff_datetime"

    @property
    def start(self) -> datetime:
        return datetime(self.year, self.month, 1)

    @property
    def end(self) -> datetime:
        """First instant after the month."""
        return datetime(self.year + self.month // 12, self.month % 12 + 1, 1)

    @property
    def payment_labels(self) -> dict[int, str]:
        return PAYMENT_LABELS[self.color]

    @property
    def outside_rule(self) -> str:
        return f"pickup_outside_{self.year}_{self.month:02d}"

    @property
    def dataset(self) -> str:
        return f"NYC TLC {self.color.title()} Taxi - {ENGLISH_MONTHS[self.month - 1]} {self.year}"

    @property
    def file_stem(self) -> str:
        return f"{self.color}_tripdata_{self.year}-{self.month:02d}"

    def source_uri(self, root: str) -> str:
        folder = f"raw/taxis/{self.color}/{self.year}/{self.month:02d}"
        return f"{root.rstrip('/')}/{folder}/{self.file_stem}.parquet"

    def clean_uri(self, root: str) -> str:
        return f"{root.rstrip('/')}/clean/{self.file_stem.replace('-', '_')}_clean"

    def report_uri(self, root: str) -> str:
        return f"{root.rstrip('/')}/kpis/{self.file_stem.replace('-', '_')}_kpis.json"
