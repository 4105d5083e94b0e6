"""Sources and sinks: hourly log scans, log parsers, configuration tables,
the test-table adapter and the partitioned / flat writers."""

from pixelflow.sources.logs import (scan_hour_range, scan_manifest, hour_manifest, hour_paths, hour_keys, split_once,
                                    parse_impressions_tokens, parse_impressions_fields,
                                    parse_ctr_log, parse_retarg_first, parse_retarg_all,
                                    route_mixed, to_lines)
from pixelflow.sources.config import (pixel_map, adgroup_table, pixel_lookups, lookups_from_entries,
                                      local_table, spec_entries)
from pixelflow.sources.intermediate import (to_intermediate_lines, parse_intermediate,
                                            write_intermediate, write_bucketed)
from pixelflow.sources.sinks import write_partitioned, write_flat, read_flat

__all__ = [
    "scan_hour_range", "scan_manifest", "hour_manifest", "hour_paths", "hour_keys", "split_once", "parse_impressions_tokens",
    "parse_impressions_fields", "parse_ctr_log", "parse_retarg_first", "parse_retarg_all",
    "route_mixed", "to_lines", "pixel_map", "adgroup_table", "pixel_lookups", "lookups_from_entries",
    "local_table", "spec_entries", "to_intermediate_lines", "parse_intermediate",
    "write_intermediate", "write_bucketed", "write_partitioned", "write_flat", "read_flat",
]
