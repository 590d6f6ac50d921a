"""Reusable column expressions (built-in Spark functions only, no UDFs)."""

from sparkmart.functions.calendar import (  # noqa: F401
    date_id, day_type, is_first_half, season, weekday_name,
    year_of_date_id,
)
from sparkmart.functions.measures import (  # noqa: F401
    cents, growth_pct, revenue, safe_ratio,
)
from sparkmart.functions.parsing import (  # noqa: F401
    parse_date, parse_flag, parse_price, text_or_null, to_int, to_long_key,
)
