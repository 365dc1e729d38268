"""Device catalogue (introspection replies) as tables: blocks, instances,
fields and their typed metadata, table layouts, bit words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.ordering import position_within

# ---------------------------------------------------------------------------
# The (type, subtype) pairs of the field-type protocol, in the
# order of the server's field-type documentation, with the metadata shape
# each one carries. A subtype of None means the type has no subtype.
FIELD_TYPES = [
    ("time", None, "time"),
    ("bit_out", None, "bit_out"),
    ("pos_out", None, "pos_out"),
    ("ext_out", "timestamp", "ext_out"),
    ("ext_out", "samples", "ext_out"),
    ("ext_out", "bits", "ext_out_bits"),
    ("bit_mux", None, "bit_mux"),
    ("pos_mux", None, "pos_mux"),
    ("table", None, "table"),
    ("param", "uint", "uint"),
    ("read", "uint", "uint"),
    ("write", "uint", "uint"),
    ("param", "int", "none"),
    ("read", "int", "none"),
    ("write", "int", "none"),
    ("param", "scalar", "scalar"),
    ("read", "scalar", "scalar"),
    ("write", "scalar", "scalar"),
    ("param", "bit", "none"),
    ("read", "bit", "none"),
    ("write", "bit", "none"),
    ("param", "action", "none"),
    ("read", "action", "none"),
    ("write", "action", "none"),
    ("param", "lut", "none"),
    ("read", "lut", "none"),
    ("write", "lut", "none"),
    ("param", "enum", "enum"),
    ("read", "enum", "enum"),
    ("write", "enum", "enum"),
    ("param", "time", "subtype_time"),
    ("read", "time", "subtype_time"),
    ("write", "time", "subtype_time"),
]
# ---------------------------------------------------------------------------


def dispatch_table(spark: SparkSession) -> DataFrame:
    """The 33-row (type, subtype) -> shape table; small and fixed, so broadcast."""
    return F.broadcast(
        spark.createDataFrame(FIELD_TYPES, "type string, subtype string, shape string")
    )


def parse_block_lines(lines: DataFrame) -> DataFrame:
    """``*BLOCKS?`` reply lines ``NAME COUNT`` -> (block, number)."""
    parts = F.split(F.trim(F.col("line")), r"\s+")
    return lines.select("*", parts[0].alias("block"), parts[1].cast("int").alias("number"))


def expand_instances(blocks: DataFrame) -> DataFrame:
    """Count n > 1 -> NAME1..NAMEn; count 1 -> NAME."""
    i = F.explode(F.sequence(F.lit(1), F.col("number"))).alias("i")
    e = blocks.select("*", i)
    return e.withColumn(
        "instance", F.when(F.col("number") > 1, F.concat(F.col("block"), F.col("i").cast("string"))).otherwise(F.col("block"))
    ).drop("i")


def instance_block(instance):
    """Instance name -> block name: strip trailing digits."""
    return F.regexp_replace(instance, r"[0-9]+$", "")


def parse_field_lines(lines: DataFrame) -> DataFrame:
    """``<BLOCK>.*?`` reply lines ``NAME INDEX TYPE [SUBTYPE...]``: split in
    three on whitespace, then the type part once more; a missing subtype is
    NULL."""
    parts = F.split(F.trim(F.col("line")), r"\s+", 3)
    rest = F.split(parts[2], r"\s+", 2)
    return lines.select(
        "*",
        parts[0].alias("field"),
        parts[1].cast("long").alias("field_index"),
        rest[0].alias("type"),
        F.get(rest, 1).alias("subtype"),
    )


def field_names(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Names-only mode: (keys, field, type, subtype, position) of field lines,
    in definition order, without asking for metadata."""
    parsed = parse_field_lines(lines)
    return position_within(parsed, keys, ["field_index", "field"], out="position").select(*keys, "field", "type", "subtype", "position")


def with_shape(fields: DataFrame, spark: SparkSession) -> DataFrame:
    """Attach the metadata shape of each field's (type, subtype); unknown pairs
    keep the field with shape ``unknown`` (description only)."""
    d = dispatch_table(spark).select(
        F.col("type").alias("__t"), F.col("subtype").alias("__s"), "shape"
    )
    j = fields.join(d, (fields["type"] == d["__t"]) & fields["subtype"].eqNullSafe(d["__s"]), "left")
    return j.drop("__t", "__s").withColumn("shape", F.coalesce("shape", F.lit("unknown")))


def ordered_labels(labels: DataFrame, keys: list[str], pos: str = "pos", label: str = "label") -> DataFrame:
    """Collect labels per key in position order (label lists are bounded by
    the protocol, e.g. 32 bits per word)."""
    return labels.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(label).alias("l")))), lambda x: x["l"]
        ).alias("labels")
    )


def bit_word_fields(lines: DataFrame) -> DataFrame:
    """``PCAP.*?`` lines with exactly four tokens, type ``ext_out`` and subtype
    ``bits`` -> ``PCAP.<name>``."""
    tokens = F.split(F.trim(F.col("line")), r"\s+")
    keep = (F.size(tokens) == 4) & (tokens[2] == "ext_out") & (tokens[3] == "bits")
    return lines.where(keep).select("*", F.concat(F.lit("PCAP."), tokens[0]).alias("word"))


# --------------------------------------------------------------------------- typed metadata

#: Version from which a table's writes can say how they continue.
MODE_VERSION = (4, 0)
ATTRIBUTES = "attr string, part string, pos int, value string"
COLUMN_LINE = r"^(\d+):(\d+)\s+(\S+)\s+(\S+)$"


def typed_fields(fields: DataFrame, attributes: DataFrame, keys: list[str]) -> DataFrame:
    """Typed metadata of every field, one nullable struct for each of the
    shapes that have attributes.

    ``fields``: (keys, field, type, subtype, shape, api_major, api_minor);
    ``attributes``: (keys, field, attr, part, pos, value), the replies about a
    field: DESC, MAX, UNITS, SCALE, OFFSET, CAPTURE_WORD, MAX_DELAY and
    MAX_LENGTH are single values; LABELS, UNIT_LABELS, CAPTURE_LABELS, BITS and
    FIELDS (the lines of a table's columns) are lists ordered by ``pos``;
    COLUMN_LABELS (a list) and COLUMN_DESC belong to the column ``part``.

    Both are brought together by one grouped aggregation, without a pivot or a
    join; the rows of a field are bounded by the protocol. A field without
    replies keeps its type; a value that is no number is null and its attribute
    is listed in ``unreadable``; of repeated single values the one with the
    largest ``pos`` counts; replies about unknown fields give no row.
    """
    own = [*keys, "field"]
    about = ["type", "subtype", "shape", "api_major", "api_minor"]
    given = ["attr", "part", "pos", "value"]
    rows = fields.select(*own, F.lit(True).alias("known"), *about, *[F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in ATTRIBUTES.split(", "))])
    rows = rows.unionByName(
        attributes.select(*own, F.lit(False).alias("known"), *[F.lit(None).cast(fields.schema[c].dataType).alias(c) for c in about], *given)
    )
    single = {
        a: F.max_by("value", F.when(F.col("attr") == a, F.coalesce("pos", F.lit(0)))).alias(f"__{a}")
        for a in ("DESC", "MAX", "UNITS", "SCALE", "OFFSET", "CAPTURE_WORD", "MAX_DELAY", "MAX_LENGTH")
    }
    listed = {
        a: F.array_sort(F.collect_list(F.when(F.col("attr") == a, F.struct("pos", "value", "part")))).alias(f"__{a}")
        for a in ("LABELS", "UNIT_LABELS", "CAPTURE_LABELS", "BITS", "FIELDS", "COLUMN_LABELS", "COLUMN_DESC")
    }
    found = rows.groupBy(*own).agg(
        F.max("known").alias("__known"), *[F.max(F.when(F.col("known"), F.col(c))).alias(c) for c in about], *single.values(), *listed.values()
    ).where("__known")

    def values(attr: str) -> Column:
        return F.transform(f"__{attr}", lambda x: x["value"])

    def number(attr: str, kind: str = "long") -> Column:
        return F.col(f"__{attr}").try_cast(kind)

    def of_column(attr: str, name: Column) -> Column:
        return F.transform(F.filter(f"__{attr}", lambda x: x["part"] == name), lambda x: x["value"])

    def column(line: Column) -> Column:
        name = F.regexp_extract(line["value"], COLUMN_LINE, 3)
        subtype = F.regexp_extract(line["value"], COLUMN_LINE, 4)
        return F.struct(
            name.alias("name"), subtype.alias("subtype"),
            F.regexp_extract(line["value"], COLUMN_LINE, 2).cast("int").alias("bit_low"),
            F.regexp_extract(line["value"], COLUMN_LINE, 1).cast("int").alias("bit_high"),
            F.get(of_column("COLUMN_DESC", name), F.lit(0)).alias("description"),
            F.when(subtype == "enum", of_column("COLUMN_LABELS", name)).alias("labels"),
        )

    readable = F.filter("__FIELDS", lambda x: x["value"].rlike(COLUMN_LINE))
    columns = F.transform(readable, column)
    highest = F.aggregate(columns, F.lit(0), lambda a, x: F.greatest(a, x["bit_high"]))
    major, minor = F.col("api_major"), F.col("api_minor")
    has_mode = (major > MODE_VERSION[0]) | ((major == MODE_VERSION[0]) & (minor >= MODE_VERSION[1]))
    shapes = {
        "uint": [number("MAX").alias("max_val")],
        "scalar": [F.col("__UNITS").alias("units"), number("SCALE", "double").alias("scale"), number("OFFSET").alias("offset")],
        "subtype_time": [values("UNIT_LABELS").alias("units_labels")],
        "enum": [values("LABELS").alias("labels")],
        "time": [values("UNIT_LABELS").alias("units_labels")],
        "bit_out": [F.col("__CAPTURE_WORD").alias("capture_word"), number("OFFSET").alias("offset")],
        "bit_mux": [number("MAX_DELAY").alias("max_delay"), values("LABELS").alias("labels")],
        "pos_mux": [values("LABELS").alias("labels")],
        "table": [
            number("MAX_LENGTH").alias("max_length"), columns.alias("fields"), (F.floor(highest / 32) + 1).cast("int").alias("row_words"),
            F.coalesce(has_mode, F.lit(False)).alias("has_mode"),
        ],
        "pos_out": [values("CAPTURE_LABELS").alias("capture_labels")],
        "ext_out": [values("CAPTURE_LABELS").alias("capture_labels")],
        "ext_out_bits": [values("BITS").alias("bits"), values("CAPTURE_LABELS").alias("capture_labels")],
    }
    numbers = {"uint": [("MAX", "long")], "scalar": [("SCALE", "double"), ("OFFSET", "long")], "bit_out": [("OFFSET", "long")], "bit_mux": [("MAX_DELAY", "long")], "table": [("MAX_LENGTH", "long")]}
    wrong = [
        F.when((F.col("shape") == shape) & F.col(f"__{a}").isNotNull() & number(a, kind).isNull(), F.lit(a))
        for shape, attrs in numbers.items() for a, kind in attrs
    ]
    wrong.append(F.when((F.col("shape") == "table") & (F.size(readable) < F.size("__FIELDS")), F.lit("FIELDS")))
    return found.select(
        *own, "type", "subtype", "shape", F.col("__DESC").alias("description"),
        *[F.when(F.col("shape") == name, F.struct(*attrs)).alias(name) for name, attrs in shapes.items()],
        F.array_compact(F.array(*wrong)).alias("unreadable"),
    )
