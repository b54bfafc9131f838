"""DataFrame -> DataFrame operators."""

from gridlake.operators.aggregate import (  # noqa: F401
    count_true,
    exact_avg,
    exact_sum,
    feeder_rollup,
)
from gridlake.operators.cleanse import (  # noqa: F401
    add_global_id,
    apply_column_map,
    derive_type,
    latest_per_key,
    normalize_nulls,
)
from gridlake.operators.incremental import LatestState  # noqa: F401
from gridlake.operators.quality import (  # noqa: F401
    apply_expectations,
    check_contract,
    dq_alerts,
    expectation_metrics,
    split_by_expectations,
    stale_datasets,
)
