from tidemark.operators.asof import asof_join  # noqa: F401
from tidemark.operators.quality import (  # noqa: F401
    AcceptedValues,
    Expectation,
    NotNull,
    Relationship,
    Unique,
    check_table,
    duplicate_keys,
    freshness,
    not_in_future,
    orphan_count,
    orphans,
    out_of_range,
    positive,
    require_not_null,
    violations,
)
from tidemark.operators.relational import (  # noqa: F401
    conform_union,
    enrich,
    select_renamed,
    topk,
    topk_per_key,
)
from tidemark.operators.scd2 import empty_history, read_history, scd2_merge, scd2_snapshot  # noqa: F401
from tidemark.operators.sinks import (  # noqa: F401
    add_missing_columns,
    dedupe_by_key,
    high_water_mark,
    incremental_candidates,
    incremental_merge,
    incremental_window_merge,
    incremental_window_rows,
    merge_partitions,
    read_current,
    replace_partitions_from,
    upsert,
    write_table,
    write_version,
)
from tidemark.operators.timeseries import (  # noqa: F401
    forward_fill,
    pivot_wide,
    rank_by_value,
    rolling_std,
    row_index,
)
