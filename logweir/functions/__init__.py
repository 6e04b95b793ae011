from logweir.functions.codes import decode, gender_label, json_status
from logweir.functions.numbers import average, int_mean, safe_double, safe_int, safe_long, strict
from logweir.functions.text import item_count, resource_path, split_java, url_host
from logweir.functions.times import (
    bracket_time,
    compact_millis,
    compact_time,
    day_of,
    epoch_millis,
    hour_bucket,
    hour_of,
)
from logweir.functions.udfs import Aggregator, ArrowAggregator, MeanAggregator, like_count, register_average, register_udfs

__all__ = [
    "Aggregator",
    "ArrowAggregator",
    "MeanAggregator",
    "average",
    "bracket_time",
    "compact_millis",
    "compact_time",
    "day_of",
    "decode",
    "epoch_millis",
    "gender_label",
    "hour_bucket",
    "hour_of",
    "int_mean",
    "item_count",
    "json_status",
    "like_count",
    "register_average",
    "register_udfs",
    "resource_path",
    "safe_double",
    "safe_int",
    "safe_long",
    "split_java",
    "strict",
    "url_host",
]
