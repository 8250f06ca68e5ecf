"""Declarative description of a priced table; every operator takes one of these."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

STRING = "string"
TIME = "timestamp_ntz"
DOUBLE = "double"
LONG = "bigint"


@dataclass(frozen=True)
class TableSpec:
    """What a table must look like and how its defects are treated."""

    rename: Mapping[str, str] = field(default_factory=dict)
    #: column -> (Spark type name, description)
    contract: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    #: column -> closed interval of valid values, checked in this order
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    #: column -> allowed labels; None means anything goes
    allowed: Mapping[str, tuple[str, ...] | None] = field(default_factory=dict)
    #: column -> {wrong label: right label}
    label_fixes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    #: column -> median | mean | mode | drop | <literal fill value>
    imputation: Mapping[str, str] = field(default_factory=dict)
    event_time: str = "Date"
    #: layouts of times besides ISO, tried in order
    time_layouts: tuple[str, ...] = ()
    #: a table is refused if more than this share of its event times has no known layout
    unparsed_share: float = 0.5
    #: label column that tells direct journeys, and the label that means direct
    stops: str = "Stop_Raw"
    direct: str = "direct"
    origin: str = "Source"
    destination: str = "Destination"
    #: columns whose groups the exploratory tables compare
    season: str = "Season"
    carrier: str = "Airline"
    base: str = "Base_Fare"
    surcharge: str = "Tax_Surcharge"
    target: str = "Total_Fare"
    min_base: float = 0.0
    #: learn log1p of the target, report in currency
    log_target: bool = True
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    raw_required: tuple[str, ...] = ()
    test_share: float = 0.20
    folds: int = 5
    seed: int = 42

    @property
    def model_columns(self) -> tuple[str, ...]:
        return self.categorical + self.numeric + (self.target,)


# The published contract of the airfare table (names, types,
# ranges, labels and fill strategies have to match for results to match).
AIRFARES = TableSpec(
    rename={
        "Base Fare (BDT)": "Base_Fare",
        "Tax & Surcharge (BDT)": "Tax_Surcharge",
        "Total Fare (BDT)": "Total_Fare",
        "Departure Date & Time": "Date",
        "Arrival Date & Time": "Arrival_Date",
        "Duration (hrs)": "Duration_hrs",
        "Stopovers": "Stop_Raw",
        "Seasonality": "Season",
        "Days Before Departure": "Days_Before_Departure",
        "Source Name": "Source_Name",
        "Destination Name": "Destination_Name",
        "Aircraft Type": "Aircraft_Type",
        "Booking Source": "Booking_Source",
    },
    contract={
        "Airline": (STRING, "carrier"),
        "Source": (STRING, "origin code"),
        "Destination": (STRING, "destination code"),
        "Date": (TIME, "departure time"),
        "Base_Fare": (DOUBLE, "ticket price before tax"),
        "Tax_Surcharge": (DOUBLE, "taxes and surcharges"),
        "Total_Fare": (DOUBLE, "price paid"),
        "Duration_hrs": (DOUBLE, "flight hours"),
        "Stop_Raw": (STRING, "stopover label"),
        "Season": (STRING, "travel season"),
        "Days_Before_Departure": (LONG, "booking lead time in days"),
        "Aircraft_Type": (STRING, "aircraft model"),
        "Class": (STRING, "cabin class"),
        "Booking_Source": (STRING, "sales channel"),
    },
    bounds={
        "Base_Fare": (500, 500_000),
        "Tax_Surcharge": (0, 100_000),
        "Total_Fare": (500, 600_000),
        "Duration_hrs": (0.25, 20.0),
        "Days_Before_Departure": (0, 365),
    },
    allowed={
        "Stop_Raw": ("Direct", "1 Stop", "2 Stops"),
        "Class": ("Economy", "Business", "First"),
        "Season": None,
        "Airline": None,
    },
    label_fixes={"Class": {"First Class": "First"}},
    imputation={
        "Tax_Surcharge": "median",
        "Base_Fare": "median",
        "Duration_hrs": "median",
        "Days_Before_Departure": "median",
        "Airline": "mode",
        "Source": "mode",
        "Destination": "mode",
        "Season": "mode",
        "Stop_Raw": "mode",
        "Aircraft_Type": "Unknown",
        "Class": "mode",
        "Booking_Source": "mode",
    },
    time_layouts=(
        "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm",
        "MM/dd/yyyy", "MMM d yyyy HH:mm", "MMM d yyyy", "d MMM yyyy HH:mm", "d MMM yyyy",
    ),
    min_base=500,
    categorical=(
        "Airline", "Source", "Destination", "Season", "Stop_Type",
        "Aircraft_Type", "Class", "Booking_Source",
    ),
    numeric=("Duration_hrs", "Days_Before_Departure", "Month", "Weekday"),
    raw_required=(
        "Airline", "Source", "Destination", "Class", "Base Fare (BDT)", "Tax & Surcharge (BDT)",
        "Total Fare (BDT)", "Departure Date & Time", "Duration (hrs)", "Stopovers",
        "Seasonality", "Days Before Departure", "Aircraft Type", "Booking Source",
    ),
)
