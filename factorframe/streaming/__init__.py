from .envelopes import (
    breaks_result_rules,
    decode_jobs,
    decode_results,
    encode_jobs,
    encode_results,
    validate_requests,
)
from .status import latest_status, live_jobs, lookup_status, prune_results, read_results, result_table
from .status_table import Run, StatusTable
from .worker import (
    LatestFactors,
    answer_jobs,
    answer_stream,
    file_messages,
    kafka_messages,
    kafka_results,
    kafka_sink,
    publish,
    submit_jobs,
    table_sink,
    write_result_batch,
)

__all__ = [n for n in dir() if not n.startswith("_")]
