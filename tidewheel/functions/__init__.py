"""Column helpers: blank semantics, dates, text and number formats, the fiscal calendar."""

from tidewheel.functions.semantics import blank0, ci_eq, divide, greatest0, is_zero, least0, minus, plus, times
from tidewheel.functions.text import first_filled, fmt, proper, proper_names, strip_prefix_word, trim_all, try_value
from tidewheel.functions.dates import fiscal_month, fiscal_quarter, fiscal_year, ledger_month_end, month_diff, month_end, shift_month_end, week_number

__all__ = [
    "blank0", "ci_eq", "divide", "first_filled", "fiscal_month", "fiscal_quarter", "fiscal_year", "fmt", "greatest0", "is_zero", "least0", "ledger_month_end", "minus",
    "month_diff", "month_end", "plus", "proper", "proper_names", "shift_month_end", "strip_prefix_word", "times", "trim_all", "try_value", "week_number",
]
