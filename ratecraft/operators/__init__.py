"""Operators: conform, quality, upsert, mart, audit, dashboard."""

from .audit import (
    audit_counts,
    content_fingerprint,
    dropped_months,
    frame_gaps,
    grain_check,
    table_counts,
    window_coverage,
)
from .conform import conform, dedup_latest, newest_first, typed_series
from .dashboard import dash_latest, dash_monthly, in_order, latest, metric_count
from .mart import (
    join_monthly,
    monthly_mart,
    monthly_rates,
    monthly_reference,
    rolling_accumulation,
    rolling_window,
    with_real_rate,
)
from .quality import (
    dq_report,
    duplicate_keys,
    enforce,
    failures,
    null_rows,
    range_violations,
    validate,
)
from .upsert import TargetBusy, exclusive, merged_content, not_older, recover, staged, stamp, take_over, upsert, writer_mark

__all__ = [
    "audit_counts",
    "conform",
    "content_fingerprint",
    "dash_latest",
    "dash_monthly",
    "dedup_latest",
    "dq_report",
    "dropped_months",
    "duplicate_keys",
    "enforce",
    "failures",
    "frame_gaps",
    "grain_check",
    "in_order",
    "join_monthly",
    "latest",
    "merged_content",
    "metric_count",
    "monthly_mart",
    "monthly_rates",
    "monthly_reference",
    "newest_first",
    "null_rows",
    "range_violations",
    "TargetBusy",
    "exclusive",
    "not_older",
    "recover",
    "take_over",
    "writer_mark",
    "rolling_accumulation",
    "rolling_window",
    "staged",
    "stamp",
    "table_counts",
    "typed_series",
    "upsert",
    "validate",
    "window_coverage",
    "with_real_rate",
]
