from tarmac.functions.cleaning import (  # noqa: F401
    clean_value,
    clean_values,
    drop_header_rows,
    is_bad,
    parse_delay,
    parse_int,
    project_clean,
    typed_flights,
    valid_delay,
)
from tarmac.functions.flight import (  # noqa: F401
    airport_endpoints,
    dep_hour,
    flight_date,
    padded_dep_time,
    route_key,
    with_flight_date,
    with_morning,
)
