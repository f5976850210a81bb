"""Raw and target contracts.

Raw files carry every column as text and are read by header name. Target
tables have a fixed column order, names and types (the warehouse DDL); the
conform step (``arrivals.sources.sinks.conform``) maps a DataFrame onto them by
name, never by position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def field_type(schema: T.StructType, name: str) -> T.DataType:
    """Type of a column, resolved case-insensitively like Spark resolves names."""
    for f in schema.fields:
        if f.name.lower() == name.lower():
            return f.dataType
    raise ValueError(f"column {name!r} not found in {[f.name for f in schema.fields]}")


def sql_string(value: str) -> str:
    """A Spark SQL string literal for arbitrary text (used for column names in stack())."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


S, I, D, DT = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()

# --- raw inputs (all text) -------------------------------------------------
# The header names of the raw files (their public data format)
# and, below, the target table and column names of the warehouse contract.

RAW_ARRIVALS_COLUMNS = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode",
    "i94addr", "depdate", "i94bir", "i94visa", "count", "dtadfile", "visapost", "occup",
    "entdepa", "entdepd", "entdepu", "matflag", "biryear", "dtaddto", "gender", "insnum",
    "airline", "admnum", "fltno", "visatype",
]

# Columns of the raw arrivals file the fact table never uses.
UNUSED_ARRIVALS_COLUMNS = [
    "count", "entdepa", "entdepd", "matflag", "fltno", "dtaddto", "admnum",
    "dtadfile", "visapost", "occup", "entdepu", "insnum",
]

# Raw arrivals columns the fact needs; a file may lack any other.
REQUIRED_ARRIVALS_COLUMNS = [
    c for c in RAW_ARRIVALS_COLUMNS if c not in (*UNUSED_ARRIVALS_COLUMNS, "visapost")
]
OPTIONAL_ARRIVALS_COLUMNS = [c for c in RAW_ARRIVALS_COLUMNS if c not in REQUIRED_ARRIVALS_COLUMNS]

RAW_DEMOGRAPHICS_COLUMNS = [
    "City", "State", "Median Age", "Male Population", "Female Population",
    "Total Population", "Number of Veterans", "Foreign-born", "Average Household Size",
    "State Code", "Race", "Count",
]

RAW_TEMPERATURE_COLUMNS = ["Country", "AverageTemperature", "Latitude", "Longitude"]

RAW_AIRPORTS_COLUMNS = [
    "ident", "type", "name", "elevation_ft", "continent", "iso_country", "iso_region",
    "municipality", "gps_code", "iata_code", "local_code", "coordinates",
]

# Airport columns that may be null throughout (a JSON file then has no such field).
OPTIONAL_AIRPORTS_COLUMNS = ["elevation_ft", "continent", "municipality", "gps_code", "iata_code", "local_code", "coordinates"]

# --- target tables ----------------------------------------------------------

ARRIVALS = Contract(
    "immigration",
    _struct(
        ("ID", I), ("year", I), ("month", I), ("native_country", S), ("residence_country", S),
        ("port_of_admission", S), ("arrival_state", S), ("arrival_date", DT),
        ("departure_date", DT), ("visa", S), ("age", I), ("birth_year", I), ("gender", S),
        ("airline", S), ("Mode", S), ("visatype", S),
    ),
    key=("ID",),
)

DEMOGRAPHICS = Contract(
    "demographics",
    _struct(
        ("City", S), ("State", S), ("Median_age", S), ("Male_population", I),
        ("Female_population", I), ("Total_population", I), ("Number_veterans", I),
        ("Foreign_born", I), ("Average_household_size", S), ("State_code", S), ("Race", S),
        ("Count", I),
    ),
    key=("City", "State_code", "Race"),
)

TEMPERATURE = Contract(
    "temperature",
    _struct(("Country", S), ("Temperature", D), ("Latitude", S), ("Longitude", S)),
    key=("Country",),
)

AIRPORTS = Contract(
    "airports",
    _struct(*[(c, S) for c in [
        "ident", "type", "name", "elevation_ft", "continent", "iso_country", "state",
        "municipality", "gps_code", "iata_code", "local_code", "coordinates",
    ]]),
    key=("ident",),
)

# The state's name, which a fact built with the state book holds beside the code.
STATE_NAME = "arrival_state_name"

# Lookup tables: always (code, label) after reading, whatever the header says.
LOOKUP_SCHEMA = _struct(("code", S), ("label", S))
