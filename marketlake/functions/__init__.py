"""Column-level helpers; each takes and returns a Column unless noted."""

from marketlake.functions.text import (
    flag_to_int,
    normalise_name,
    pair_symbol,
    split_list,
    strip_suffix,
)
from marketlake.functions.time import (
    add_periods,
    end_of_previous_period,
    epoch_to_ts,
    epoch_to_ts_nonzero,
    interval_unit,
    parse_datetime,
    period_start,
    periods_between,
    to_utc_ntz,
    ts_to_epoch,
    ts_to_iso,
    ts_to_iso_full,
    zero_date_to_null,
)
from marketlake.functions.similarity import (
    enough_grams,
    gram_buckets,
    gram_counts,
    gram_masks,
    gram_size,
    grams_are_even,
    may_have_partner,
    may_reach,
    name_mask,
    name_signatures,
    similarity_ratio,
)
from marketlake.functions.change import change, change_percentage

__all__ = [name for name in dir() if not name.startswith("_")]
