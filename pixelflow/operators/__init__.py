"""Relational operators: semi-join filters, size-checked lookup joins,
aggregations and the per-cookie sequence window."""

from pixelflow.operators.aggregates import count_by, ctr_by, pixel_lists, sum_by, tag_pivot
from pixelflow.operators.filters import (filter_adgroups, filter_known_campaigns, filter_known_pixels,
                                         require_cookie, require_ctr_ids, require_timestamp)
from pixelflow.operators.joins import fan_out, with_category
from pixelflow.operators.keyfilter import key_filter, may_match
from pixelflow.operators.sequence import (dedup_last_wins, label_next, seq_events,
                                          timeline_conversions, timeline_impressions)

__all__ = ["count_by", "ctr_by", "pixel_lists", "sum_by", "tag_pivot", "filter_adgroups",
           "filter_known_campaigns", "filter_known_pixels", "require_cookie", "require_ctr_ids",
           "require_timestamp", "fan_out", "with_category", "key_filter", "may_match", "dedup_last_wins",
           "label_next", "seq_events", "timeline_conversions", "timeline_impressions"]
