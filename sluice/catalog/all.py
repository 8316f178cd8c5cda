"""Import every query module so the registry is complete."""

from sluice.catalog import batch_queries, flagship  # noqa: F401
from sluice.catalog import clean_queries  # noqa: F401,E402
from sluice.catalog import rule_queries  # noqa: F401,E402
from sluice.catalog import merge_queries  # noqa: F401,E402
from sluice.catalog import join_queries, state_queries  # noqa: F401,E402
from sluice.catalog import quality_queries  # noqa: F401,E402
from sluice.catalog import stream_queries  # noqa: F401,E402
