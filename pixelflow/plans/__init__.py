"""End-to-end jobs (each one lazy DataFrame plan)."""

from pixelflow.plans.impressions import collect_impressions, impression_dims
from pixelflow.plans.conversions import collect_conversions, raw_dims
from pixelflow.plans.rate import agg_rate, agg_rate_bucketed, agg_rate_from_folders, agg_rate_from_lines
from pixelflow.plans.sequence import sequence_labels, sequence_labels_mixed, sequence_labels_split
from pixelflow.plans.ctr import ctr_leaves, ctr_dims

__all__ = ["collect_impressions", "impression_dims", "collect_conversions", "raw_dims",
           "agg_rate", "agg_rate_bucketed", "agg_rate_from_folders", "agg_rate_from_lines", "sequence_labels", "sequence_labels_mixed", "sequence_labels_split", "ctr_leaves", "ctr_dims"]
