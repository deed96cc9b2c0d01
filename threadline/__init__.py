"""threadline: Spark-first curation and analysis of conversation tables.

Public API (all functions take and return DataFrames unless noted)::

    from threadline import (local_session, scan_jsonl, curate, build_hybrid, write_hybrid,
                            prepare_splits, chunk_overlap, quality_gate, dedup_prefix, ...)
"""

__version__ = "0.1.0"

from threadline.functions.roles import map_role_drop, map_role_else  # noqa: F401
from threadline.functions.text import (  # noqa: F401
    embedded_json, extract_all, fingerprint, is_nonblank, join_nonempty, token_count, trim_ws, truncate_long,
)
from threadline.operators.augment import (  # noqa: F401
    aug_prefix, aug_reverse, aug_shorten, augment_records, hybrid,
)
from threadline.operators.chunk import chunk_overlap  # noqa: F401
from threadline.operators.dedup import dedup_prefix, dedup_text_prefix, keep_first  # noqa: F401
from threadline.operators.filters import (  # noqa: F401
    conversation_quality, drop_empty, filter_roles, first_n, min_event_gate, nonblank_turns,
    quality_gate, role_set_check, session_block_gate, valid_structure,
)
from threadline.operators.nested import assemble, block_counts, explode_turns, to_interchange, to_messages  # noqa: F401
from threadline.operators.positions import global_positions, turn_positions  # noqa: F401
from threadline.operators.render import render_text  # noqa: F401
from threadline.operators.runs import max_role_run, record_max_run, run_violations  # noqa: F401
from threadline.operators.sample import exact_sample, first_of_shuffle  # noqa: F401
from threadline.operators.split import split_grouped, split_prefix  # noqa: F401
from threadline.operators.stats import (  # noqa: F401
    dataset_stats, distinct_names, gate_report, name_overlap, quality_report, record_stats, split_sizes,
)
from threadline.plans.curate import clean_turns, curate  # noqa: F401
from threadline.plans.hybrid import build_hybrid, hybrid_records, hybrid_splits, write_hybrid  # noqa: F401
from threadline.plans.prepare import prepare_splits  # noqa: F401
from threadline.session import local_session  # noqa: F401
from threadline.sinks.export import export, write_metadata, write_records, write_text_document  # noqa: F401
from threadline.sources.jsonl import (  # noqa: F401
    concat, flatten_records, number_records, scan_jsonl, scan_jsonl_strict, scan_recursive,
)
from threadline.sources.logs import scan_session_logs, tool_use_counts  # noqa: F401
from threadline.streaming.ingest import ingest_incremental, read_ingested  # noqa: F401
