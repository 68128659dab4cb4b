"""Rules over ``k=v|k=v`` text: a request's parameters against the fields of a record.

The parameters of a request are one text, read once on the driver; each rule becomes one expression
over the column with the record's fields.  A parameter that is missing passes every record; a
record without the field passes no rule that is set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionloom.functions.text import ID_SEPARATOR, get_field


def parameter(text: str, name: str, separator: str = ID_SEPARATOR) -> str | None:
    """Value of the first ``name=value`` field of a request's text, by the rules of ``get_field``."""
    for field in text.split(separator):
        parts = field.rstrip("=").split("=")
        if len(parts) == 2 and parts[0] == name and parts[1]:
            return parts[1]
    return None


def _passes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def field_between(data: Column | str, field: str, parameters: str, start: str, end: str) -> Column:
    """Whether the field, a whole number, lies in the bounds, both included.

    Both parameters must be set, or all pass.  Bounds and fields that are no numbers are errors.
    """
    low, high = parameter(parameters, start), parameter(parameters, end)
    if low is None or high is None:
        return F.lit(True)
    return _passes(get_field(data, field).cast("int").between(int(low), int(high)))


def field_in(data: Column | str, field: str, parameters: str, name: str) -> Column:
    """Whether the field's comma list and the parameter's have an item in common."""
    wanted = parameter(parameters, name)
    if wanted is None:
        return F.lit(True)
    items = _items(wanted)
    value = get_field(data, field)
    held = F.split(F.regexp_replace(value, ",+$", ""), ",")
    # Items at the end that are empty do not count, on either side.
    return _passes(F.arrays_overlap(held, F.array(*[F.lit(item) for item in items])) & ~value.rlike("^,+$")) if items else F.lit(False)


def _items(text: str) -> list[str]:
    stripped = text.rstrip(",")
    return stripped.split(",") if stripped else []


def field_equals(data: Column | str, field: str, parameters: str, name: str) -> Column:
    """Whether the field's text is the parameter's."""
    wanted = parameter(parameters, name)
    return F.lit(True) if wanted is None else _passes(get_field(data, field) == wanted)


def compile_rules(data: Column | str, parameters: str, rules: Sequence[tuple]) -> Column:
    """All rules of a request as one expression: ``("between", field, start, end)``, ``("in", field,
    parameter)`` and ``("equal", field, parameter)``.  Rules whose parameter is missing leave nothing behind."""
    forms = {"between": field_between, "in": field_in, "equal": field_equals}
    set_rules = [(kind, field, names) for kind, field, *names in rules if all(parameter(parameters, n) is not None for n in names)]
    tests = [forms[kind](data, field, parameters, *names) for kind, field, names in set_rules]
    return reduce(Column.__and__, tests) if tests else F.lit(True)
