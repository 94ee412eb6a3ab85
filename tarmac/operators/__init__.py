from tarmac.operators.best import best_events, best_flights, best_row  # noqa: F401
from tarmac.operators.metrics import (  # noqa: F401
    airport_delay_by,
    airport_popularity,
    bad_delay_count,
    carrier_arrival_delay,
    route_arrival_delay,
)
from tarmac.operators.quality import quality_report  # noqa: F401
from tarmac.operators.ranking import (  # noqa: F401
    global_row_number,
    popularity_rank_frequency,
    popularity_ranked,
    rank_frequency_loglog,
    top_carriers,
    top_destinations,
    top_n_per_airport,
)
