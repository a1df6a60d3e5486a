"""Column roles of the flight table and the feature layout built from them.

The column lists are fixed values: they must equal the ones the original
application uses, because they decide which columns are dropped, cast,
imputed and encoded, and in which order features enter the vector.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must match the original application) -------------------
# Columns removed before anything else (leak the label or are unused).
DROPPED = (
    "ArrTime", "ActualElapsedTime", "AirTime", "TaxiIn", "Diverted",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay", "Cancelled", "CancellationCode",
)
# Categorical columns, in feature order.
CATEGORICAL = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "UniqueCarrier",
    "FlightNum", "TailNum", "Origin", "Dest",
)
# Continuous columns, in feature order.
CONTINUOUS = ("DepDelay", "Distance", "TaxiOut")
# Clock columns written as HHMM text.
CLOCK = ("DepTime", "CRSDepTime", "CRSArrTime", "CRSElapsedTime")
# Label and its sign-preserving cube-root variant.
LABEL = "ArrDelay"
LABEL_CUBE_ROOT = "ArrDelayCubeRoot"
# Day-part names and their inclusive upper bounds in HHMM units.
DAY_PARTS = (("Morning", 1.0, 1125.0), ("Afternoon", 1125.0, 1750.0))
DAY_PART_OTHER = "Evening"
# Prefix of the constant that replaces a null category.
MISSING_CATEGORY_PREFIX = "No_"
# Sample cap of the original application and its seed.
SAMPLE_CAP = 1_500_000
SAMPLE_SEED = 1234
# --------------------------------------------------------------------------

TIME_MODES = ("numeric", "categorical")


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which role, and how clock columns become features.

    ``time_mode="numeric"`` turns every clock column into minutes since
    midnight (``<c>Min``, continuous); ``"categorical"`` turns it into a
    day part (``<c>Disc``, indexed like any other category).
    """

    categorical: tuple[str, ...] = CATEGORICAL
    continuous: tuple[str, ...] = CONTINUOUS
    clock: tuple[str, ...] = CLOCK
    label: str = LABEL
    time_mode: str = "numeric"
    drop: tuple[str, ...] = DROPPED
    na_tokens: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.time_mode not in TIME_MODES:
            raise ValueError(f"time_mode must be one of {TIME_MODES}, got {self.time_mode!r}")

    @property
    def raw_label(self) -> str:
        """The label column present before the cube-root transform."""
        return LABEL if self.label == LABEL_CUBE_ROOT else self.label

    @property
    def derived_clock(self) -> tuple[str, ...]:
        suffix = "Min" if self.time_mode == "numeric" else "Disc"
        return tuple(f"{c}{suffix}" for c in self.clock)

    @property
    def index_inputs(self) -> tuple[str, ...]:
        """String columns that get a ``<c>Index`` feature."""
        extra = self.derived_clock if self.time_mode == "categorical" else ()
        return self.categorical + extra

    @property
    def numeric_inputs(self) -> tuple[str, ...]:
        """Double columns that enter the vector as they are."""
        extra = self.derived_clock if self.time_mode == "numeric" else ()
        return self.continuous + extra

    @property
    def index_outputs(self) -> tuple[str, ...]:
        return tuple(f"{c}Index" for c in self.index_inputs)

    @property
    def feature_names(self) -> tuple[str, ...]:
        """Vector slot names, in order: indexed categories, then numbers."""
        return self.index_outputs + self.numeric_inputs

    @property
    def tag(self) -> str:
        """Short name ``<label>-<mode>`` used in model paths and reports."""
        return f"{self.label}-{self.time_mode}"
