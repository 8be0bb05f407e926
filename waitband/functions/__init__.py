"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from .calendar import (calendar_attrs, financial_year, month_code, month_label,  # noqa: F401
                       month_name, parse_period, raw_path)
from .keys import surrogate_key  # noqa: F401
from .metrics import (band_sum, breach_severity, meets_standard, pct_within,  # noqa: F401
                      rag_status, ratio_status, rounded_ratio_pct, safe_ratio)
