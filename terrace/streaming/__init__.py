from terrace.streaming.bounded import bounded, moved, watermark
from terrace.streaming.cdc import cdc_delta, cdc_envelope, cdc_select, parse_marked, parse_or_dirty, split_log
from terrace.streaming.joins import (cancel_stream, enrich_chain, interval_join, interval_merge, lookup, order_detail_stream,
                                     refund_paid_stream, refund_stream, refreshed)
from terrace.streaming.runs import late_rows, run_to_end, start_job, watch_late_rows
from terrace.streaming.sinks import DimRouter, KeyedTable, LateSide, additive_log, batch_log, dated_sink, json_batches, kafka_sink, read_additive, read_log, route_dims, to_snake_json
from terrace.streaming.state import buckets_for, drop_repeats, emit_last, first_of_day, hand_over, login_marks, newest_only, repair_is_new, retract_dedup, settled
from terrace.streaming.windows import (amount_window, distinct_window, keyword_counts, login_window, page_view_parts,
                                       page_view_window, unique_window, window_columns)
from terrace.streaming.words import flag_words

__all__ = [n for n in dir() if not n.startswith("_")]
