from skyroute.functions.parse import (  # noqa: F401
    flag, hhmm_minutes, lenient_double, null_if_lone_quote, parse_date, parse_long,
)
from skyroute.functions.timefmt import (  # noqa: F401
    at_minutes, trip_key, weekday_name, year_bounds, in_year,
)
