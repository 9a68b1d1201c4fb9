"""Column builders (no DataFrame in, Column out)."""

from homesense.functions.scalars import (array_text, bool_words, center_angle, clip, device_type_text,
                                         map_replace, map_strict, not_blank_keep_null, np_round, not_in_keep_null,
                                         round_half, round_quarter, row_total, safe_ratio)
from homesense.functions.time import (angle_to_hms_text, between_time, bin_start, day_start,
                                      duration_hours, duration_seconds, dst_shift_hours,
                                      epoch_micros, epoch_to_local, from_epoch_micros, hms_text_to_seconds,
                                      iso_from_text, iso_text, last_sunday, localize,
                                      micros_of_day, minute_bin, noon_day_bin, quarter_hour_bin,
                                      second_of_day, time_angle, time_text, utc_to_local, week_label)

__all__ = [n for n in dir() if not n.startswith("_")]
