"""Column-expression builders.  All return JVM-side ``Column`` expressions."""

from arrivo.functions.text import title_case, strip_ws, clean_text
from arrivo.functions.numeric import rint_round, safe_number, number_or_zero, num_of, pct
from arrivo.functions.stats import correlation, first_max_by, first_min_by, exact_median, mean_of, significant, std_of
from arrivo.functions.dates import month_key, month_start, parse_ts, ts_of, normalise_month_key

__all__ = [
    "title_case", "strip_ws", "clean_text",
    "rint_round", "safe_number", "number_or_zero", "num_of", "pct",
    "correlation", "first_max_by", "first_min_by", "exact_median", "mean_of", "significant", "std_of",
    "month_key", "month_start", "parse_ts", "ts_of", "normalise_month_key",
]
