"""Check queries for the typed metadata of all field shapes,
with DuckDB oracles.

Stand-in: every part is a field of its brand's block (as in ``control_queries``);
the replies about it are derived from the part by the shape of its type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.catalogue import field_names, ordered_labels, typed_fields
from strobe.plans.control_queries import _FIELDS_SQL, _LABELS_BY_SHAPE, _fields, field_lines
from strobe.plans.registry import register

#: Reply that lists the labels of a shape.
LABEL_REPLY = {
    "enum": "LABELS", "bit_mux": "LABELS", "pos_mux": "LABELS", "time": "UNIT_LABELS", "subtype_time": "UNIT_LABELS",
    "pos_out": "CAPTURE_LABELS", "ext_out": "CAPTURE_LABELS", "ext_out_bits": "CAPTURE_LABELS",
}


def replies(fields: DataFrame) -> DataFrame:
    """(block, field, attr, part, pos, value): what a device says of its fields."""
    size = F.col("p_size").cast("string")

    def reply(attr: str, value: Column, pos: int | None = None, part: str | None = None) -> Column:
        return F.struct(F.lit(attr).alias("attr"), F.lit(part).cast("string").alias("part"), F.lit(pos).cast("int").alias("pos"), value.alias("value"))

    def listed(attr: str, values: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(F.lit(attr).alias("attr"), F.lit(None).cast("string").alias("part"), i.alias("pos"), v.alias("value")))

    by_shape = {
        "uint": F.array(reply("MAX", (F.col("p_size") * 1000).cast("string"))),
        "scalar": F.array(reply("UNITS", F.lit("mm")), reply("SCALE", (F.col("p_retailprice") / 1000).cast("string")), reply("OFFSET", size)),
        "bit_out": F.array(reply("CAPTURE_WORD", F.concat(F.lit("PCAP.BITS"), (F.col("p_size") % 4).cast("string"))), reply("OFFSET", (F.col("p_partkey") % 32).cast("string"))),
        "bit_mux": F.array(reply("MAX_DELAY", (F.col("p_size") * 8).cast("string"))),
        "table": F.array(
            reply("MAX_LENGTH", (F.col("p_size") * 16).cast("string")),
            # the lines come in another order than their positions
            reply("FIELDS", F.format_string("%d:32 POSITION int", 32 + F.col("p_size") % 32), 2),
            reply("FIELDS", F.lit("15:0 REPEATS uint"), 0),
            reply("FIELDS", F.lit("19:16 TRIGGER enum"), 1),
            reply("COLUMN_LABELS", F.concat(F.lit("BIT"), size), 1, "TRIGGER"),
            reply("COLUMN_LABELS", F.lit("Immediate"), 0, "TRIGGER"),
            reply("COLUMN_DESC", F.lit("Times to repeat"), None, "REPEATS"),
        ),
        "ext_out_bits": listed("BITS", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat(F.lit("B"), i.cast("string"), F.lit("_"), size))),
    }
    labels = {name: F.array(*[F.lit(x) for x in xs]) for name, xs in _LABELS_BY_SHAPE.items()}
    labels |= {"enum": F.split("p_name", " "), "pos_mux": F.array(F.lit("ZERO"), F.upper("p_name"))}
    none = F.array().cast("array<struct<attr:string,part:string,pos:int,value:string>>")
    shape = F.col("shape")
    said, lists = none, none
    for name, made in by_shape.items():
        said = F.when(shape == name, made).otherwise(said)
    for name, made in labels.items():
        lists = F.when(shape == name, listed(LABEL_REPLY[name], made)).otherwise(lists)
    desc = F.when(F.col("p_partkey") % 4 != 0, F.array(reply("DESC", F.concat(F.lit("Field "), F.col("p_name"))))).otherwise(none)
    return fields.select("block", "field", F.explode(F.concat(said, lists, desc)).alias("a")).select("block", "field", "a.*")


_LABELS_SQL = "CASE shape WHEN 'enum' THEN replace(p_name, ' ', ',') WHEN 'pos_mux' THEN 'ZERO,' || upper(p_name) " + " ".join(
    f"WHEN '{name}' THEN '{','.join(xs)}'" for name, xs in _LABELS_BY_SHAPE.items()
) + " END"


@register("typed_fields_full", f"""
WITH {_FIELDS_SQL}
SELECT block, field, shape, CASE WHEN p_partkey % 4 <> 0 THEN 'Field ' || p_name END AS description,
  CASE WHEN shape = 'uint' THEN CAST(p_size * 1000 AS BIGINT) END AS max_val,
  CASE WHEN shape = 'scalar' THEN 'mm' END AS units,
  CASE WHEN shape = 'scalar' THEN round(p_retailprice / 1000, 6) END AS scale,
  CASE WHEN shape = 'scalar' THEN CAST(p_size AS BIGINT) WHEN shape = 'bit_out' THEN CAST(p_partkey % 32 AS BIGINT) END AS "offset",
  CASE WHEN shape = 'bit_out' THEN 'PCAP.BITS' || (p_size % 4) END AS capture_word,
  CASE WHEN shape = 'bit_mux' THEN CAST(p_size * 8 AS BIGINT) END AS max_delay,
  {_LABELS_SQL} AS labels,
  CASE WHEN shape = 'table' THEN CAST(p_size * 16 AS BIGINT) END AS max_length,
  CASE WHEN shape = 'table' THEN 'REPEATS/uint/0/15/Times to repeat/|TRIGGER/enum/16/19//Immediate+BIT' || p_size
    || '|POSITION/int/32/' || (32 + p_size % 32) || '//' END AS columns,
  CASE WHEN shape = 'table' THEN 2 END AS row_words,
  CASE WHEN shape = 'table' THEN CAST(substr(block, 7, 1) AS INTEGER) >= 4 END AS has_mode,
  CASE WHEN shape = 'ext_out_bits' THEN 'B0_' || p_size || ',B1_' || p_size || ',B2_' || p_size || ',B3_' || p_size END AS bits
FROM fl""")
def typed_fields_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All attributes of every shape; a block's device has the API version of
    the first digit of its brand."""
    fields = _fields(spark, sf_dir).withColumn("api_major", F.substring("block", 7, 1).cast("int")).withColumn("api_minor", F.lit(0))
    typed = typed_fields(fields, replies(fields), ["block"])
    labels = F.coalesce("enum.labels", "bit_mux.labels", "pos_mux.labels", "time.units_labels", "subtype_time.units_labels", "pos_out.capture_labels", "ext_out.capture_labels", "ext_out_bits.capture_labels")
    text = F.transform(
        "table.fields",
        lambda x: F.concat_ws("/", x["name"], x["subtype"], x["bit_low"].cast("string"), x["bit_high"].cast("string"), F.coalesce(x["description"], F.lit("")), F.coalesce(F.array_join(x["labels"], "+"), F.lit(""))),
    )
    return typed.select(
        "block", "field", "shape", "description", F.col("uint.max_val").alias("max_val"), F.col("scalar.units").alias("units"),
        F.round("scalar.scale", 6).alias("scale"), F.coalesce("scalar.offset", "bit_out.offset").alias("offset"),
        F.col("bit_out.capture_word").alias("capture_word"), F.col("bit_mux.max_delay").alias("max_delay"), F.array_join(labels, ",").alias("labels"),
        F.col("table.max_length").alias("max_length"), F.array_join(text, "|").alias("columns"), F.col("table.row_words").alias("row_words"),
        F.col("table.has_mode").alias("has_mode"), F.array_join("ext_out_bits.bits", ",").alias("bits"),
    )


@register("label_lists_full", f"""
WITH {_FIELDS_SQL}, ll AS (SELECT block, field, {_LABELS_SQL} AS labels FROM fl)
SELECT block, field, labels FROM ll WHERE labels IS NOT NULL""")
def label_lists_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered label lists of all shapes that have some."""
    lists = replies(_fields(spark, sf_dir)).where(F.col("attr").isin(*set(LABEL_REPLY.values())))
    return ordered_labels(lists, ["block", "field"], "pos", "value").select("block", "field", F.array_join("labels", ",").alias("labels"))


@register("field_names", f"""
WITH {_FIELDS_SQL}
SELECT block, field, type, subtype, row_number() OVER (PARTITION BY block ORDER BY field_index, field) - 1 AS position FROM fl""")
def field_names_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_names(field_lines(spark, sf_dir), ["block"])
