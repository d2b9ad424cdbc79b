"""Column-level helpers: null-faithful aggregates, labels, time arithmetic."""

from pelagic.functions.nulls import (  # noqa: F401
    first_word, matches, mean_na, nan_to_null, not_in, not_in_frame, not_matches,
    safe_div, strict_max, strict_sum, sum0,
)
from pelagic.functions.labels import (  # noqa: F401
    code_map, depth_bin, genus_species, pad_left, sample_code, whole_number_text,
)
from pelagic.functions.timeops import (  # noqa: F401
    days_since, decimal_year, eight_day_composite, epoch_micros, from_days_since, harmonic,
    hours_between, kelvin_to_celsius, local_to_utc, month_composite, month_sequence,
    parse_ts, trip_code, utc_to_local, whole_months_between, ymd_parts,
)
