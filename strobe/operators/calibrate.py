"""Calibration of captured columns (raw -> engineering units) and field rules.

Wide form: one projection per record layout, with scale/offset folded in as
literals (Catalyst constant-folds and codegens it). Long form: samples as
(acquisition, column, value) joined to the field table, for work across
acquisitions whose layouts differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.functions.columns import c, np_divide, q
from strobe.sources.capture_format import GATE_DURATION_FIELD, SAMPLES_FIELD, FieldSpec


def gate_column(columns: list[str]) -> str:
    """Gate used for gated means: ``PCAP.GATE_DURATION.Value`` if captured, else
    ``PCAP.SAMPLES.Value``; neither is an error."""
    if GATE_DURATION_FIELD in columns:
        return GATE_DURATION_FIELD
    if SAMPLES_FIELD in columns:
        return SAMPLES_FIELD
    raise ValueError("gated mean needs PCAP.GATE_DURATION.Value or PCAP.SAMPLES.Value")


def calibration_expr(field: FieldSpec, raw: bool, columns: list[str], of: Callable[[str], Column] = c) -> Column:
    """Expression producing the stored value of ``field``; ``of`` finds the
    column of a captured field.

    Raw ``Mean`` captures are sums over the gate: ``x * scale / gate + offset``
    (this wins even for scale 1 / offset 0; a zero gate gives +-inf or NaN as
    float division does). Other raw fields with a non-trivial scale or offset:
    ``x * scale + offset``. Everything else passes through; in raw mode a field
    with scale and offset is still stored as double.
    """
    x = of(field.column)
    if raw and field.capture == "Mean":
        gate = of(gate_column(columns))
        return np_divide(x.cast("double") * F.lit(field.scale), gate) + F.lit(field.offset)
    if not raw or field.linear is None:
        return x
    scale, offset = field.linear
    value = x.cast("double")
    return value if (scale, offset) == (1, 0) else value * F.lit(scale) + F.lit(offset)


def calibrate(
    samples: DataFrame,
    fields: list[FieldSpec],
    process: str,
    rename: dict[str, dict[str, str]] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Calibrate one layout's wide sample frame; optionally rename columns
    (``{name: {capture: new_name}}``, default ``<name>.<capture>``)."""
    raw = process == "Raw"
    columns = [f.column for f in fields]
    keep = keep if keep is not None else [x for x in samples.columns if x not in columns]
    rename = rename or {}
    exprs = [F.col(q(k)) for k in keep]
    for f in fields:
        target = rename.get(f.name, {}).get(f.capture, f.column)
        exprs.append(calibration_expr(f, raw, columns).alias(target))
    return samples.select(*exprs)


def calibrate_layouts(samples: DataFrame, layouts: dict[str, tuple[list[FieldSpec], str]]) -> DataFrame:
    """Calibrate samples that hold each layout in a struct column of its own
    (``sources.datasource``); layouts: struct column -> (fields, process). Each
    layout keeps the types of its own process, whatever the others have."""
    made = []
    for name in samples.columns:
        if name not in layouts:
            made.append(F.col(q(name)))
            continue
        fields, process = layouts[name]
        have = samples.schema[name].dataType.names
        fields = [f for f in fields if f.column in have]
        values = [calibration_expr(f, process == "Raw", have, F.col(q(name)).getField).alias(f.column) for f in fields]
        made.append(F.when(F.col(q(name)).isNotNull(), F.struct(*values)).alias(name))
    return samples.select(*made)


# --------------------------------------------------------------------------- field table rules


def with_field_rules(fields: DataFrame) -> DataFrame:
    """Add the per-field predicates to a field table with columns
    (name, capture, type, scale, offset, units)."""
    n_null = (
        F.col("scale").isNull().cast("int")
        + F.col("offset").isNull().cast("int")
        + F.col("units").isNull().cast("int")
    )
    has_both = F.col("scale").isNotNull() & F.col("offset").isNotNull()
    return fields.withColumns(
        {
            "metadata_valid": n_null.isin(0, 3),
            "needs_calibration": has_both & ((F.col("scale") != 1) | (F.col("offset") != 0)),
            "raw_type": F.when(has_both, F.lit("float64")).otherwise(F.col("type")),
            "column": F.concat_ws(".", "name", "capture"),
        }
    )


def choose_gate(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Per acquisition: the gate column a gated mean divides by (NULL: none)."""
    col = F.concat_ws(".", "name", "capture")
    return fields.groupBy(*keys).agg(
        F.coalesce(
            F.max(F.when(col == GATE_DURATION_FIELD, F.lit(GATE_DURATION_FIELD))),
            F.max(F.when(col == SAMPLES_FIELD, F.lit(SAMPLES_FIELD))),
        ).alias("gate_column")
    )


def renamed(fields: DataFrame, renames: DataFrame) -> DataFrame:
    """Stored column name: a (name, capture) -> new_name lookup, default
    ``<name>.<capture>``. The mapping's size is not bounded up front, so the
    join is left to AQE, which broadcasts it only if its measured size is
    under the broadcast threshold."""
    joined = fields.join(renames, ["name", "capture"], "left")
    return joined.withColumn(
        "stored_name", F.coalesce(F.col("new_name"), F.concat_ws(".", "name", "capture"))
    ).drop("new_name")


def calibrate_long(samples_long: DataFrame, fields: DataFrame, keys: list[str]) -> DataFrame:
    """Long-form calibration: samples (keys, column, sample_idx, value, gate)
    joined to the field table (keys, column, capture, scale, offset, process)."""
    f = fields.select(*keys, "column", "capture", "scale", "offset", "process")
    j = samples_long.join(f, [*keys, "column"])
    raw = F.col("process") == "Raw"
    has_both = F.col("scale").isNotNull() & F.col("offset").isNotNull()
    needs = has_both & ((F.col("scale") != 1) | (F.col("offset") != 0))
    x = F.col("value").cast("double")
    value = (
        F.when(raw & (F.col("capture") == "Mean"), np_divide(x * F.col("scale"), F.col("gate")) + F.col("offset"))
        .when(raw & needs, x * F.col("scale") + F.col("offset"))
        .otherwise(x)
    )
    return j.withColumn("calibrated", value)
