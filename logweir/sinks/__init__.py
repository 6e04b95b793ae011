from logweir.sinks.files import write_day_hour, write_parquet, write_partitioned, write_text
from logweir.sinks.tables import save_bucketed, write_external, write_jdbc

__all__ = [
    "save_bucketed",
    "write_day_hour",
    "write_external",
    "write_jdbc",
    "write_parquet",
    "write_partitioned",
    "write_text",
]
