from lakepipe.sinks.tables import BucketedTable, VersionedTable, open_table
from lakepipe.sinks.writers import WriteReport, append_bronze, read_bronze, scd2_apply, upsert, write_gold

__all__ = ["BucketedTable", "VersionedTable", "WriteReport", "append_bronze", "open_table", "read_bronze",
           "scd2_apply", "upsert", "write_gold"]
