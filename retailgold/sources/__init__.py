from retailgold.sources.catalog import create_external_table, sync_partitions
from retailgold.sources.files import list_files, read_feed, read_gold, read_settlement, settlement_files
from retailgold.sources.views import register_feeds, run_sql

__all__ = [
    "create_external_table", "sync_partitions", "list_files", "read_feed", "read_gold", "read_settlement", "register_feeds", "run_sql",
    "settlement_files",
]
