"""JSON flow decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.functions.scalars import zero_fill
from fluxwatch.schemas import FLOW, FLOW_DEFAULTS

_BAD = "_corrupt_record"


def decode_flows(
    messages: DataFrame,
    mode: str = "strict",
    value: str = "value",
    keep: list[str] | None = None,
) -> DataFrame:
    """Flow columns of a JSON message column (text or bytes).

    ``strict`` drops what does not decode and fills missing fields with their
    defaults; numbers given as text, and fractions in integer fields, are
    converted. ``permissive`` keeps every message: a broken one becomes a row of
    zeros whose texts and flags are null. Unknown keys are ignored in both.
    ``keep`` names message columns to carry along.
    """
    text = F.col(value).cast("string")
    carried = list(keep or [])
    if mode == "permissive":
        flow = F.from_json(text, FLOW, {"mode": "PERMISSIVE"})
        return zero_fill(messages.select(*carried, F.inline(F.array(flow))), FLOW_NUMBERS)
    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
        "allowNonNumericNumbers": "false",
    }
    bad = T.StructField(_BAD, T.StringType())
    flow = F.from_json(text, T.StructType([*FLOW.fields, bad]), options)
    # unpacked by a generator, so that later filters are not pushed below it and
    # each message is parsed once, however often its fields are used
    rows = messages.select(*carried, F.inline(F.array_compact(F.array(flow))))
    # a record with a number of another type is parsed again with its numbers as
    # text, so that the wrong type costs the value and not the record
    texts = [T.StructField(f.name, T.StringType()) if f.name in FLOW_NUMBERS else f for f in FLOW.fields]
    again = F.when(F.col(_BAD).isNotNull(), F.from_json(F.col(_BAD), T.StructType([*texts, bad]), options))
    given = {f.name: f"__{f.name}" for f in FLOW.fields}
    rows = rows.select("*", F.inline(F.array(again)).alias(*given.values(), f"_{_BAD}"))
    types = {f.name: f.dataType for f in FLOW.fields}

    def converted(name: str) -> Column:
        raw = F.col(given[name])
        if name not in FLOW_NUMBERS:
            return raw
        plain = raw.try_cast(types[name])
        return plain if types[name] == T.DoubleType() else F.coalesce(plain, raw.try_cast("double").try_cast(types[name]))

    whole = F.col(f"_{_BAD}").isNull()
    for name in FLOW_NUMBERS:
        whole = whole & (F.col(given[name]).isNull() | converted(name).isNotNull())
    sound = F.when(F.col(_BAD).isNull(), F.lit(True)).otherwise(whole)
    filled = [
        F.coalesce(F.when(F.col(_BAD).isNull(), F.col(name)).otherwise(converted(name)), F.lit(default)).alias(name)
        for name, default in FLOW_DEFAULTS.items()
    ]
    return rows.filter(sound).select(*carried, *filled)


FLOW_NUMBERS = [f.name for f in FLOW.fields if isinstance(f.dataType, T.NumericType)]


def to_training_names(flows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the stream's columns to those the model was trained on."""
    return flows.withColumnsRenamed(names)
