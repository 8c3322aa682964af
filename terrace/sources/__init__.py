from terrace.sources.readers import SCHEMAS, load, read_partition, read_text_table, stream
from terrace.sources.writers import (append_missing, append_text_rows, insert_partitions, observed, register_table, replace_partitions, save_table,
                                     write_partitions, write_text_table)

__all__ = ["SCHEMAS", "load", "read_partition", "read_text_table", "stream", "append_missing", "insert_partitions", "observed", "register_table",
           "replace_partitions", "write_partitions", "write_text_table"]
