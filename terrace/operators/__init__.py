from terrace.operators.combine import (in_flight_balance, metrics_full_outer, missing_rows, split_attribution,
                                       union_history)
from terrace.operators.dims import (date_spine, dict_decode, hierarchy_resolve, latest_partition, scd2_init, scd2_merge,
                                    star_flatten)
from terrace.operators.facts import (accumulating_snapshot, avg_interval_seconds, detail_enrich, first_per_group,
                                     lifecycle_facts, parse_event_json, register_enrich, snapshot_filter)
from terrace.operators.ranking import first_rows, topk_with_ties
from terrace.operators.rollups import (daily_rollup, dedup_then_sum, nday_wide, recent_days_rollup, stats_by_dim,
                                       to_date_merge_outer, to_date_merge_union, to_date_rebuild)
from terrace.operators.users import (churn_and_return, consecutive_days, funnel, new_active_users, new_order_users,
                                     page_path, repeat_purchase_rate, retention_cohorts, session_traffic_stats)

__all__ = [n for n in dir() if not n.startswith("_")]
