from tarmac.plans.catalog import QUERIES  # noqa: F401
from tarmac.plans.oracle import SQL  # noqa: F401
