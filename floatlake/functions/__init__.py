"""Column expressions: no Python runs per row."""

from floatlake.functions.dates import (
    compact_date, filename_date, juld_to_timestamp, month_code, month_name, month_number,
    parse_months, reading_date, reading_time, split_datetime, time_of_day, to_date_or_null,
    ymd_parts,
)
from floatlake.functions.geo import assign_ocean, assign_region
from floatlake.functions.measures import pressure_to_depth, valid_pair, valid_pressure
from floatlake.functions.paths import (
    basename, float_id_from_filename, float_type, platform_from_path, relative_dir,
    year_month_parts,
)
from floatlake.functions.text import (
    clean_bytes, decode_text, is_finite, join_chars, nan_to_null, null_tokens,
    parses_as_float, reading_value, strip, to_number,
)

__all__ = [name for name in dir() if not name.startswith("_")]
