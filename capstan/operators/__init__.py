from capstan.operators.joins import left_join_fanout
from capstan.operators.latest import latest_per_key, ranked
from capstan.operators.merge import GroupedMerge, MergeCounts, grouped_merge, null_safe_merge
from capstan.operators.rollup import rollup_flags
from capstan.operators.sinks import read_report, report_location, write_report
from capstan.operators.snapshot import align, append_snapshot, read_snapshot, snapshot_append, stored_columns
from capstan.operators.tags import latest_enabled_tags, named_tag_members, named_tags, tag_flags
from capstan.operators.units import with_unit_divisor
from capstan.operators.users import buyer_users, with_user

__all__ = ["left_join_fanout", "latest_per_key", "ranked", "null_safe_merge", "grouped_merge", "GroupedMerge",
           "MergeCounts", "rollup_flags", "read_report", "report_location", "stored_columns",
           "write_report", "align", "append_snapshot", "read_snapshot", "snapshot_append", "latest_enabled_tags",
           "named_tag_members", "named_tags", "tag_flags", "with_unit_divisor", "buyer_users", "with_user"]
