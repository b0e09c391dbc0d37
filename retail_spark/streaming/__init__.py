from retail_spark.streaming.dedup import (  # noqa: F401
    deduplicate,
    deduplicate_stream,
    drop_duplicates_on,
    duplicate_report,
    earliest_per_key,
)
from retail_spark.streaming.sinks import (  # noqa: F401
    StreamTarget,
    clear_targets,
    create_schema,
    preview,
    write_routed_jsonl,
    write_snapshot_jsonl,
)
from retail_spark.streaming.windows import session_gaps, session_windows, sessionize, windowed_kpis  # noqa: F401
