from terrace.functions.measures import money, sum_money, truncated_avg, weighted_avg
from terrace.functions.text import initial_mask, md5_bucket, pii_hash, pii_mask, rule_text, snake_case
from terrace.functions.time import (day_text, epoch_day, epoch_normalise, in_last_days, iso_text, second_text)

__all__ = ["money", "sum_money", "truncated_avg", "weighted_avg", "initial_mask", "md5_bucket", "pii_hash", "pii_mask",
           "rule_text", "snake_case", "day_text", "epoch_day", "epoch_normalise", "in_last_days", "iso_text", "second_text"]
