"""Code tables and the JSON status field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Labels of the gender codes.
GENDER_LABELS = {"0": "男", "1": "女"}
UNKNOWN_GENDER = "未知"

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def decode(col: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Label for each code, ``default`` for any other value and NULL."""
    out = F
    for code, label in mapping.items():
        out = out.when(col == code, F.lit(label))
    return out.otherwise(F.lit(default))


def gender_label(col: Column) -> Column:
    return decode(col, GENDER_LABELS, UNKNOWN_GENDER)


def json_status(col: Column, field: str = "product_status", default: int = -1) -> Column:
    """Whole part of a numeric field of a JSON object.

    ``default`` for NULL, malformed or non-object text, an absent field and a non-number; an
    explicit JSON null gives 0, and numbers beyond INT stop at its limits.
    """
    has_null = F.array_contains(F.json_object_keys(col), field) & F.get_json_object(col, f"$['{field}']").isNull()

    def whole(number: Column) -> Column:
        beyond = F.when(number > _INT_MAX, F.lit(_INT_MAX)).when(number < _INT_MIN, F.lit(_INT_MIN))
        return F.coalesce(number.try_cast("int"), beyond, F.when(has_null, F.lit(0)), F.lit(default))

    # The one-element array holds the parsed number, so that the text is parsed once.
    return F.transform(F.array(F.from_json(col, f"`{field}` DOUBLE")[field]), whole)[0]
