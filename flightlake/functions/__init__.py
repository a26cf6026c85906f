"""Column-expression builders (all native Spark SQL functions)."""

from flightlake.functions.geo import (grid_cell, haversine_km, path_points, round_half_even,
                                      segment_count)
from flightlake.functions.risk import percentile_of_score, risk_band
from flightlake.functions.text import (legacy_board_times, legacy_origin_name, normalize_strings,
                                       normalize_text)
from flightlake.functions.timefn import (day_start, epoch_to_date, epoch_to_text, hour_offset,
                                         iso_to_epoch, ordered_leg, trailing_start)

__all__ = [
    "grid_cell", "haversine_km", "path_points", "round_half_even", "segment_count",
    "percentile_of_score", "risk_band",
    "legacy_board_times", "legacy_origin_name", "normalize_strings", "normalize_text",
    "day_start", "epoch_to_date", "epoch_to_text", "hour_offset", "iso_to_epoch",
    "ordered_leg", "trailing_start",
]
