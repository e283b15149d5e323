from retailgold.sinks.archive import archive_feed, archive_summary, archived_settlement_files, carry_over_dimensions, read_archive, read_rejects
from retailgold.sinks.audit import read_audit, write_audit
from retailgold.sinks.bucketed import attach_bucketed, stage_bucketed
from retailgold.sinks.gold_files import (
    commit_gold, gold_manifest, publish, published_files, read_manifest, stage_gold, store, write_gold,
)

__all__ = [
    "archive_feed", "archived_settlement_files", "carry_over_dimensions", "read_audit", "write_audit", "gold_manifest", "publish",
    "published_files", "read_manifest", "stage_gold", "store", "write_gold", "commit_gold", "read_archive",
    "archive_summary", "attach_bucketed", "read_rejects", "stage_bucketed",
]
