"""Bit-packed tables and bit words.

A packed table is a flat list of uint32 words, ``row_words`` per row; each
column occupies bits ``bit_low..bit_high`` of one word (a column that crosses
a word boundary only gets the bits of its first word). Words are BIGINT here
(Spark has no uint32); all work is Column expressions with the layout folded
in as literals, so no UDF is involved.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_MASK = 0xFFFFFFFF


@dataclass(frozen=True)
class TableColumn:
    name: str
    subtype: str  # uint | int | enum
    bit_low: int
    bit_high: int
    labels: tuple[str, ...] = field(default_factory=tuple)

    @property
    def width(self) -> int:
        return self.bit_high - self.bit_low + 1

    @property
    def word(self) -> int:
        return self.bit_low // 32

    @property
    def shift(self) -> int:
        return self.bit_low & 31

    @property
    def mask(self) -> int:
        return (1 << self.width) - 1


def row_words(columns: list[TableColumn]) -> int:
    return max(c.bit_high for c in columns) // 32 + 1


def extract(words: Column, col: TableColumn, enum_labels: bool = False) -> Column:
    """Value of ``col`` from an ARRAY<BIGINT> of one row's words."""
    word = F.get(words, col.word)
    raw = F.shiftright(word, col.shift).bitwiseAND(F.lit(col.mask))
    if col.subtype == "int":
        top = 1 << (col.width - 1)
        return (raw.bitwiseXOR(F.lit(top)) - F.lit(top)).cast("int")
    if col.subtype == "enum" and enum_labels:
        if not col.labels:
            raise ValueError(f"enum column {col.name} has no labels")
        labels = F.array(*[F.lit(x) for x in col.labels])
        return F.get(labels, raw.cast("int"))
    if col.width <= 8:
        return raw.cast("short")
    if col.width <= 16:
        return raw.cast("int")
    return raw.cast("long")


def unpack_rows(
    tables: DataFrame, words_col: str, columns: list[TableColumn], keys: list[str], enum_labels: bool = False
) -> DataFrame:
    """Packed tables (one ARRAY<BIGINT> of words per row of ``tables``) to one
    row per table row with a typed column per field, in layout order.

    Rows whose word count is not a multiple of ``row_words`` are rejected by
    ``valid_word_count`` first; here they would be truncated.
    """
    rw = row_words(columns)
    n_rows = F.floor(F.size(words_col) / rw).cast("int")
    rows = tables.select(
        *keys,
        F.posexplode(
            F.transform(F.sequence(F.lit(0), n_rows - 1), lambda i: F.slice(F.col(words_col), i * rw + 1, rw))
        ).alias("row", "__w"),
    ).where(n_rows > 0)
    return rows.select(*keys, "row", *[extract(F.col("__w"), c, enum_labels).alias(c.name) for c in columns])


def valid_word_count(words_col: str, columns: list[TableColumn]) -> Column:
    return F.size(words_col) % row_words(columns) == 0


def table_rejects(tables: DataFrame, words_col: str, columns: list[TableColumn], keys: list[str]) -> DataFrame:
    """Why packed tables cannot be unpacked as they stand: (keys, row, column,
    message), one row for each table without words or with a word count that
    is no multiple of the row's, and for each enum index without a label."""
    none = F.lit(None)
    rw = row_words(columns)
    count = tables.where(F.col(words_col).isNull() | ~valid_word_count(words_col, columns)).select(
        *keys, none.cast("int").alias("row"), none.cast("string").alias("column"),
        F.when(F.col(words_col).isNull(), F.lit("no whole words")).otherwise(
            F.format_string(f"%d words are no rows of {rw}", F.size(words_col))).alias("message"),
    )
    out = count
    enums = [c for c in columns if c.subtype == "enum"]
    if enums:
        rows = unpack_rows(tables.where(valid_word_count(words_col, columns)), words_col, columns, keys)
        for col in enums:
            bad = rows.where(F.col(col.name) >= len(col.labels))
            out = out.unionByName(bad.select(
                *keys, "row", F.lit(col.name).alias("column"),
                F.format_string(f"index %d of {len(col.labels)} labels", F.col(col.name).cast("int")).alias("message")))
    return out


def label_rejects(rows: DataFrame, columns: list[TableColumn], keys: list[str]) -> DataFrame:
    """Labels of rows to be packed that their enum column does not have:
    (keys, column, message)."""
    out = None
    for col in (c for c in columns if c.subtype == "enum" and c.name in rows.columns):
        bad = rows.where(F.col(col.name).isNotNull() & enum_index(F.col(col.name), col).isNull())
        part = bad.select(*keys, F.lit(col.name).alias("column"), F.concat(F.lit("unknown label "), F.col(col.name)).alias("message"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else rows.select(*keys, F.lit("").alias("column"), F.lit("").alias("message")).limit(0)


def length_rejects(columns_df: DataFrame, keys: list[str], column: str, length: str) -> DataFrame:
    """Tables whose columns differ in length: (keys, shortest, longest, columns
    of another length than the longest)."""
    per = columns_df.groupBy(*keys).agg(
        F.min(length).alias("shortest"), F.max(length).alias("longest"), F.collect_list(F.struct(F.col(length).alias("n"), F.col(column).alias("c"))).alias("all"))
    return per.where("shortest < longest").select(
        *keys, "shortest", "longest", F.array_sort(F.transform(F.filter("all", lambda x: x["n"] < F.col("longest")), lambda x: x["c"])).alias("short_columns"))


def enum_index(value: Column, col: TableColumn) -> Column:
    """Label -> 0-based index; an unknown label gives NULL (reject)."""
    labels = F.array(*[F.lit(x) for x in col.labels])
    pos = F.array_position(labels, value)
    return F.when(pos > 0, pos - 1)


def pack_row(columns: list[TableColumn], values: dict[str, Column]) -> Column:
    """ARRAY<BIGINT> of one row's words: each value masked to its width and OR-ed
    into its word at its shift; negative values wrap to two's complement and
    columns not given stay 0. (Masking deviates from the unmasked original,
    where an over-wide value spills into its neighbours.)"""
    if not any(c.name in values for c in columns):
        raise ValueError("a packed table needs at least one column")
    words = []
    for w in range(row_words(columns)):
        acc = F.lit(0).cast("long")
        for col in columns:
            if col.word != w or col.name not in values:
                continue
            v = values[col.name].cast("long").bitwiseAND(F.lit(col.mask))
            acc = acc.bitwiseOR(F.shiftleft(v, col.shift))
        words.append(acc.bitwiseAND(F.lit(WORD_MASK)))
    return F.array(*words)


def over_wide(columns: list[TableColumn], values: dict[str, Column]) -> Column:
    """True where any given value does not fit its bit range (reported, not spilled)."""
    checks = []
    for col in columns:
        if col.name not in values:
            continue
        v = values[col.name].cast("long")
        if col.subtype == "int":
            lo, hi = -(1 << (col.width - 1)), (1 << (col.width - 1)) - 1
        else:
            lo, hi = 0, col.mask
        checks.append((v < lo) | (v > hi))
    out = F.lit(False)
    for ch in checks:
        out = out | ch
    return out


def _le_hex(word: Column) -> Column:
    """Hex text of a uint32's four little-endian bytes."""
    h = F.lpad(F.hex(word.cast("long")), 8, "0")
    return F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))


def words_to_base64(words: Column) -> Column:
    """ARRAY<BIGINT> uint32 words -> base64 of their little-endian bytes."""
    encoded = F.base64(F.unhex(F.array_join(F.transform(words, _le_hex), "")))
    # one line per table value: drop MIME line breaks if the session chunks base64
    return F.regexp_replace(encoded, "[\r\n]", "")


def base64_to_words(text: Column) -> Column:
    """base64 text -> ARRAY<BIGINT> of little-endian uint32 words; an empty
    text gives an empty array, bytes that are no whole words give NULL (see
    ``table_rejects``)."""
    hexed = F.hex(F.unbase64(text))
    n = F.floor(F.length(hexed) / 8).cast("int")

    def word(i):
        h = F.substring(hexed, i * 8 + 1, 8)
        le = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
        return F.conv(le, 16, 10).cast("long")

    whole = F.length(hexed) % 8 == 0
    empty = F.array().cast("array<bigint>")
    return F.when(whole & (n > 0), F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), word)).when(whole, empty)


def bits_to_rows(df: DataFrame, word_col: str, labels: DataFrame) -> DataFrame:
    """Bit word -> one row per labelled bit with ``is_set``.

    ``labels`` (bit, label) is one row per bit of one word (at most 32 rows),
    so broadcasting it is bounded.
    """
    bits = df.withColumn("bit", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(31).cast("long"))))
    j = bits.join(F.broadcast(labels), "bit")
    shifted = F.expr(f"shiftright(`{word_col}`, CAST(bit AS INT))")
    return j.withColumn("is_set", shifted.bitwiseAND(1) == 1)


def named_bit_columns(df: DataFrame, word_col: str, labels: list[str]) -> DataFrame:
    """Wide form: one Boolean column per label, bit i <-> i-th label."""
    return df.select(
        "*", *[(F.shiftright(F.col(word_col), i).bitwiseAND(1) == 1).alias(lbl) for i, lbl in enumerate(labels)]
    )
