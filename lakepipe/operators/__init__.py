from lakepipe.operators.asof import asof_join
from lakepipe.operators.dedup import dedup_latest, dedup_rows
from lakepipe.operators.interval_join import interval_join
from lakepipe.operators.merge import scd2_df, upsert_df
from lakepipe.operators.ordering import exact_quantiles, global_rank, global_row_number
from lakepipe.operators.quality import assert_unique, duplicate_keys, require_not_null
from lakepipe.operators.rollups import merge_sketches, pivoted, sketch_estimates, sketch_groups, totals
from lakepipe.operators.scalar import append_scalar_row
from lakepipe.operators.sessions import rolling_sum, sessionize, with_previous
from lakepipe.operators.sizing import broadcast_if_small, has_at_most

__all__ = ["append_scalar_row", "asof_join", "assert_unique", "broadcast_if_small", "dedup_latest", "dedup_rows", "duplicate_keys",
           "exact_quantiles", "global_rank", "global_row_number", "has_at_most", "interval_join", "merge_sketches", "pivoted",
           "require_not_null", "rolling_sum", "scd2_df", "sessionize", "sketch_estimates", "sketch_groups", "totals", "upsert_df",
           "with_previous"]
