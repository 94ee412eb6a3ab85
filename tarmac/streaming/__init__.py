from tarmac.streaming.jobs import (  # noqa: F401
    JOBS,
    StreamJob,
    stream_best_flights,
    stream_carrier_delay,
    stream_popularity,
    stream_route_delay,
    stream_top_carriers,
    stream_top_destinations,
    stream_top_n,
)
from tarmac.streaming.progress import observe_bad_delays, progress  # noqa: F401
from tarmac.streaming.source import parse_lines, stream_clean  # noqa: F401
