"""Column-expression helpers: everything here returns a ``Column`` and stays
inside whole-stage code generation (no Python UDFs)."""

from ledgerspark.functions.text import (  # noqa: F401
    concat_lenient, concat_strict, date_text, extract_response, inference_prompt,
    normalise_error_text, python_strip, training_text,
)
from ledgerspark.functions.numeric import (  # noqa: F401
    is_numeric_text, nonfinite_to_null, round_money, text_to_double, to_int_code,
)
from ledgerspark.functions.dates import (  # noqa: F401
    bin_start, closed_window, lookback, month_start, parse_timestamp,
)
from ledgerspark.functions.codes import warehouse_name  # noqa: F401
