from livetables.functions.expressions import (  # noqa: F401
    decimal_text,
    digest,
    exact_avg,
    exact_sum,
    exact_sum_double,
    hash_window,
    hour_of_text,
    pick,
    symbol_name,
    time_text,
    uniform,
)
