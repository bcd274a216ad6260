from tidemark.sources.payloads import (  # noqa: F401
    read_observations_payload,
    read_records_payload,
    read_timeseries_payload,
)
from tidemark.sources.tables import read_seed, within_days  # noqa: F401
