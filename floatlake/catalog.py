"""Schemas, column rules and fixed values shared by the whole library."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Month names and their three-letter codes, in calendar order.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
MONTH_CODES = [
    "JAN", "FEB", "MAR", "APR", "MAY", "JUN",
    "JUL", "AUG", "SEP", "OCT", "NOV", "DEC",
]

# Text tokens that a pandas CSV read turns into null.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Tokens that mean "no value" after trimming, when loading readings.
READING_NULL_TOKENS = ["nan", "NaN", "", "None"]

# Fill codes and limits of the float data.
PRESSURE_FILL = 99999.0
PRESSURE_FLOOR = -10.0
MAX_DEPTH = 12000.0
JULD_FILL = 999999.0
JULD_MAX_DAYS = 106752
SURFACE_PRESSURE = 20.0
REFERENCE_PRESSURE = 10.0
MIXED_LAYER_THRESHOLD = 0.2

# Float types and the measured quantities, in matching order.
FLOAT_TYPES = ["BCG", "NON-BCG"]
MEASURED_TERMS = ["PRES", "TEMP", "PSAL", "DOXY", "CHLA", "BBP"]

# Indian Ocean regions as (name, min_lat, max_lat, min_lon, max_lon).
# The position in the list is the priority: the first matching box wins.
REGION_BOXES = [
    ("Red Sea", 12, 30, 32, 44),
    ("Gulf of Aqaba", 28, 30, 34, 36),
    ("Gulf of Suez", 27, 30, 32, 34),
    ("Persian Gulf", 24, 30, 48, 57),
    ("Gulf of Oman", 23, 27, 56, 60),
    ("Strait of Hormuz", 25, 27, 56, 58),
    ("Arabian Sea", 5, 30, 50, 75),
    ("Bay of Bengal", 5, 23, 80, 100),
    ("Andaman Sea", 5, 20, 92, 100),
    ("Gulf of Aden", 10, 18, 42, 52),
    ("Mozambique Channel", -25, -10, 35, 45),
    ("Great Australian Bight", -38, -28, 125, 140),
    ("Gulf of Carpentaria", -17, -10, 135, 142),
    ("Arafura Sea", -12, -8, 130, 140),
    ("Timor Sea", -15, -8, 125, 135),
    ("Joseph Bonaparte Gulf", -15, -13, 128, 130),
    ("Gulf of Mannar", 8, 10, 78, 80),
    ("Palk Strait and Palk Bay", 9, 10, 79, 80),
    ("Lakshadweep Sea", 8, 15, 70, 77),
    ("Somali Basin", -5, 15, 45, 60),
    ("Mascarene Basin", -25, -10, 50, 70),
    ("Central Indian Basin", -20, 5, 75, 90),
    ("Wharton Basin", -20, 5, 90, 110),
    ("Perth Basin", -35, -25, 110, 120),
    ("Ninety East Ridge", -30, 10, 88, 92),
    ("Chagos Archipelago", -8, -4, 70, 75),
    ("Maldives Ridge", -2, 8, 72, 75),
    ("Seychelles Plateau", -10, 0, 50, 60),
    ("Madagascar Ridge", -25, -12, 43, 52),
    ("Crozet Basin", -50, -40, 45, 65),
    ("Kerguelen Plateau", -55, -45, 65, 85),
    ("Java Trench", -15, -5, 105, 115),
    ("Banda Sea", -8, -2, 125, 135),
    ("Celebes Sea", -2, 8, 115, 125),
    ("Coral Sea", -25, -10, 145, 160),
    ("Tasman Sea", -45, -25, 150, 170),
    ("Bass Strait", -42, -38, 140, 150),
    ("Spencer Gulf", -35, -32, 136, 138),
    ("Gulf of Thailand", 5, 15, 100, 106),
    ("South China Sea (Southern)", 5, 15, 106, 120),
    ("Arabian Gulf", 24, 30, 48, 57),
    ("Oman Sea", 23, 27, 56, 63),
    ("Hormuz Strait", 25, 27, 56, 58),
    ("Makran Coast", 20, 28, 57, 67),
    ("Indus Delta", 23, 25, 66, 68),
    ("Kutch Gulf", 22, 24, 68, 70),
    ("Cambay Gulf", 21, 23, 71, 73),
    ("Konkan Coast", 15, 21, 72, 74),
    ("Malabar Coast", 8, 15, 74, 76),
    ("Coromandel Coast", 8, 20, 79, 82),
    ("Bengal Shelf", 16, 23, 87, 92),
    ("Myanmar Coast", 10, 21, 92, 95),
    ("Irrawaddy Delta", 15, 18, 94, 96),
    ("Ten Degree Channel", 9, 11, 92, 93),
    ("Preparis Channel", 14, 16, 93, 95),
    ("Malacca Strait", 1, 6, 99, 104),
    ("Sunda Strait", -7, -5, 105, 107),
    ("Lombok Strait", -9, -8, 115, 116),
    ("Makassar Strait", -6, 2, 116, 119),
    ("Flores Sea", -9, -7, 118, 125),
    ("Sawu Sea", -11, -9, 119, 123),
    ("Christmas Island Waters", -11, -10, 105, 106),
    ("Cocos Islands Waters", -12, -11, 96, 97),
    ("Exmouth Plateau", -22, -19, 112, 116),
    ("Carnarvon Basin", -26, -21, 112, 116),
    ("Naturaliste Plateau", -35, -32, 108, 112),
    ("Wallaby Plateau", -28, -25, 112, 115),
    ("Broken Ridge", -32, -29, 95, 98),
    ("Amsterdam-St Paul Plateau", -39, -37, 76, 78),
    ("Rodrigues Ridge", -20, -18, 62, 64),
    ("Saya de Malha Bank", -11, -9, 59, 62),
    ("Nazareth Bank", -15, -13, 56, 58),
    ("Agulhas Bank", -37, -34, 18, 26),
    ("Agulhas Plateau", -41, -39, 23, 27),
    ("Prince Edward Islands", -47, -46, 37, 38),
    ("Marion Plateau", -47, -46, 37, 38),
    ("Del Cano Rise", -42, -40, 51, 53),
    ("Madagascar Plateau", -26, -11, 46, 52),
    ("Comoros Basin", -13, -11, 43, 46),
    ("Aldabra Group", -10, -9, 46, 47),
    ("Farquhar Group", -11, -10, 50, 52),
    ("Amirante Islands", -6, -5, 52, 54),
    ("Socotra Island", 12, 13, 53, 54),
    ("Abd al Kuri", 12, 13, 52, 53),
    ("Hanish Islands", 13, 14, 42, 43),
]

# Oceans in the same form. Where min_lon > max_lon the box crosses
# the 180 degree meridian.
OCEAN_BOXES = [
    ("Indian Ocean", -60, 30, 20, 147),
    ("Pacific Ocean", -60, 70, 120, -70),
    ("Atlantic Ocean", -70, 80, -70, 20),
    ("Arctic Ocean", 65, 90, -180, 180),
    ("Southern Ocean", -90, -60, -180, 180),
]

BOX_SCHEMA = T.StructType([
    T.StructField("prio", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("min_lat", T.DoubleType(), False),
    T.StructField("max_lat", T.DoubleType(), False),
    T.StructField("min_lon", T.DoubleType(), False),
    T.StructField("max_lon", T.DoubleType(), False),
])

# The ten comma-separated fields of a profile index line.
INDEX_FIELDS = [
    "file", "date", "latitude", "longitude", "ocean", "profiler_type",
    "institution", "parameters", "parameter_data_mode", "date_update",
]

METADATA_SCHEMA = T.StructType([
    T.StructField("float_id", T.StringType()),
    T.StructField("float_type", T.StringType()),
    T.StructField("profiler_type", T.StringType()),
    T.StructField("institution", T.StringType()),
    T.StructField("project_name", T.StringType()),
    T.StructField("wmo_inst_type", T.StringType()),
    T.StructField("platform_type", T.StringType()),
    T.StructField("all_columns", T.ArrayType(T.StringType())),
    T.StructField("csv_filename", T.StringType()),
    T.StructField("last_reading_date", T.DateType()),
])

READINGS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("float_id", T.StringType()),
    T.StructField("parameter_name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("JULD_DATE", T.DateType()),
    T.StructField("JULD_TIME", T.StringType()),
])

# Columns of the core summary that are never aggregated.
CORE_SKIPPED = {
    "PLATFORM_NUMBER", "N_LEVELS", "DATE", "ROW_COUNT", "JULD", "JULD_LOCATION",
    "PRES_ADJUSTED",
}

# Identifiers, codes and date codes: a mean of these would be meaningless, so a
# summary keeps the first value even when every value looks numeric.
FIRST_VALUE_COLUMNS = {
    "PLATFORM_NUMBER", "FLOAT_SERIAL_NO", "WMO_INST_TYPE", "CONFIG_MISSION_NUMBER",
    "DATA_CENTRE", "DC_REFERENCE", "FIRMWARE_VERSION", "FORMAT_VERSION",
    "HANDBOOK_VERSION", "DATE_CREATION", "DATE_UPDATE", "REFERENCE_DATE_TIME",
    "JULD_LOCATION",
}

_MEASUREMENT = re.compile(
    r"^(PRES|TEMP|PSAL|DOXY|CHLA|BBP\d*)(_ADJUSTED)?(_ERROR)?$"
)
_DOUBLE_COLUMNS = {
    "LATITUDE", "LONGITUDE", "JULD_LOCATION_MIN", "JULD_LOCATION_MAX",
    "HISTORY_START_PRES", "HISTORY_STOP_PRES", "HISTORY_PREVIOUS_VALUE",
}
_LONG_COLUMNS = {"CYCLE_NUMBER", "CONFIG_MISSION_NUMBER"}
_TIMESTAMP_COLUMNS = {"JULD", "JULD_LOCATION"}


def column_type(name: str) -> str:
    """Type of a level column by name; unknown columns stay strings."""
    upper = name.upper()
    if upper in _TIMESTAMP_COLUMNS:
        return "timestamp"
    if upper in _LONG_COLUMNS:
        return "bigint"
    if upper in _DOUBLE_COLUMNS or _MEASUREMENT.match(upper) or upper.endswith("_ERROR"):
        return "double"
    if upper.startswith("HISTORY_") and "PRES" in upper:
        return "double"
    return "string"


def find_column(columns: list[str], name: str) -> str | None:
    """The column of this name in its own spelling, ignoring case."""
    for column in columns:
        if column.upper() == name.upper():
            return column
    return None


def box_rows(boxes) -> list[tuple]:
    """Rows for BOX_SCHEMA, numbered by list position."""
    return [
        (prio, name, float(lat0), float(lat1), float(lon0), float(lon1))
        for prio, (name, lat0, lat1, lon0, lon1) in enumerate(boxes)
    ]
