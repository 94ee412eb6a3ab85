from tarmac.sources.archives import read_archives, stage_archives  # noqa: F401
from tarmac.sources.files import MissingColumnError, file_headers, read_clean, read_raw  # noqa: F401
from tarmac.sources.fixture import clean_flights, events, flights, raw_flights, table  # noqa: F401
