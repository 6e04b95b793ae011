from logweir.operators.aggregates import (
    collect_by,
    count_by,
    custom_aggregate,
    explode_tokens,
    hits_and_sum,
    min_max_by,
    observed,
    pv_by_domain,
    totals,
    word_count,
)
from logweir.operators.catalog import (
    assert_schema,
    conform,
    create_table,
    drop_table,
    global_sql,
    list_catalog,
    rename_table,
    row_map,
    sql_over,
)
from logweir.operators.joins import (
    allowlist,
    blocklist,
    broadcast_if_small,
    flag_join,
    is_small,
    join_on,
    local_copy,
    lookup_join,
)
from logweir.operators.layout import map_batches, partitions_for, persisted, relayout, sized
from logweir.operators.parts import PartTable
from logweir.operators.projection import (
    format_row,
    pick_fields,
    project,
    rename,
    where,
    where_arity,
    with_expr,
)
from logweir.operators.ranking import first_value, last_value, ranked, top_n
from logweir.operators.sketches import bloom_join, frequent_items, pruned_top_n
from logweir.operators.snapshots import append_rows, delete_where, swap_snapshot, update_where, upsert

__all__ = [
    "PartTable",
    "allowlist",
    "append_rows",
    "assert_schema",
    "blocklist",
    "bloom_join",
    "broadcast_if_small",
    "collect_by",
    "conform",
    "count_by",
    "create_table",
    "custom_aggregate",
    "delete_where",
    "drop_table",
    "explode_tokens",
    "first_value",
    "flag_join",
    "format_row",
    "frequent_items",
    "global_sql",
    "hits_and_sum",
    "is_small",
    "join_on",
    "last_value",
    "list_catalog",
    "local_copy",
    "lookup_join",
    "map_batches",
    "min_max_by",
    "observed",
    "partitions_for",
    "persisted",
    "pick_fields",
    "project",
    "pruned_top_n",
    "pv_by_domain",
    "ranked",
    "relayout",
    "rename",
    "rename_table",
    "row_map",
    "sized",
    "sql_over",
    "swap_snapshot",
    "top_n",
    "totals",
    "update_where",
    "upsert",
    "where",
    "where_arity",
    "with_expr",
    "word_count",
]
