from tradegrain.functions.columns import (  # noqa: F401
    AVERAGE,
    MONEY,
    PERCENT,
    canonical,
    contains_ignoring_case,
    is_one_of,
    line_revenue,
    margin_pct,
    month_of,
    passes,
    per_unit_of,
    rolling_start,
    slug,
)
