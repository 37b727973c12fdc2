"""Ingestion of network-security telemetry with Spark."""

from telemill.operators.classify import account, accepted, classify, normalize, quarantined, rejected
from telemill.operators.envelope import decode_segments, encode_segments, null_lines, pack_segments
from telemill.operators.lines import explode_lines, split_fields, tokenize_quoted
from telemill.operators.report import batch_report, observe_batch
from telemill.plans.batch import classify_messages, ingest_batch
from telemill.plans.builtin import BUILTIN, dns_log, flow_log, ids_event_log, ids_packet_log, proxy_log
from telemill.plans.logtype import LogType, Output, register, registered, resolve
from telemill.plans.replay import pending_rejects, replay_quarantine
from telemill.sinks.archive import archive_lines, archive_segments, read_archive
from telemill.sinks.compact import compact_days, finish_compaction
from telemill.sinks.evolve import Changes, evolve_landing, evolve_table, reconcile
from telemill.sinks.landing import read_accepted, read_rejected, write_landing
from telemill.sinks.rows import read_rows
from telemill.sinks.tables import create_quarantine, create_table, write_quarantine, write_table
from telemill.sinks.topic import to_topic, topic_widths, write_segment_files, write_segments_batch, write_segments_stream
from telemill.sources.offsets import (
    covered_offsets,
    merge_ranges,
    missing_offsets,
    offset_options,
    offset_ranges,
    plan_offsets,
    uncovered,
)
from telemill.sources.segments import (
    assigned,
    read_segment_files,
    read_segments_assigned,
    read_segments_batch,
    read_segments_stream,
)
from telemill.streaming.jobs import archive_stream, ingest_stream, read_reports
from telemill.streaming.progress import BatchLogger
from telemill.streaming.stop import request_stop

__all__ = [
    "BUILTIN", "BatchLogger", "Changes", "LogType", "Output", "accepted", "account", "archive_lines", "archive_segments",
    "archive_stream", "assigned", "batch_report", "classify", "classify_messages", "compact_days", "covered_offsets",
    "create_quarantine", "create_table", "decode_segments", "dns_log", "encode_segments", "explode_lines",
    "evolve_landing", "evolve_table", "finish_compaction", "flow_log", "ids_event_log", "ids_packet_log", "ingest_batch", "ingest_stream",
    "merge_ranges", "missing_offsets", "normalize", "null_lines", "observe_batch", "offset_options", "offset_ranges",
    "pack_segments", "pending_rejects", "plan_offsets", "proxy_log", "quarantined", "read_accepted", "read_archive",
    "read_rejected", "read_reports", "read_rows", "read_segment_files", "read_segments_assigned",
    "read_segments_batch", "read_segments_stream", "reconcile", "register", "registered", "rejected", "replay_quarantine",
    "request_stop", "resolve", "split_fields", "to_topic", "tokenize_quoted", "topic_widths", "uncovered", "write_landing",
    "write_quarantine", "write_segment_files", "write_segments_batch", "write_segments_stream", "write_table",
]
