"""Byte layouts of keys and values, as built-in expressions.

A layout is a list of ``(name, kind)``:

* ``int``: 4 bytes, big-endian, signed;
* ``string``: 4-byte length, then UTF-8 bytes;
* ``string_or_null``: as ``string``; null is stored as the empty string and read back as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

Layout = list[tuple[str, str]]


def int_to_bytes(n: Column) -> Column:
    return F.unhex(F.right(F.concat(F.lit("0000000"), F.hex(n.cast("long"))), F.lit(8)))


def _unsigned(data: Column) -> Column:
    return F.conv(F.hex(data), 16, 10).cast("long")


def bytes_to_int(data: Column) -> Column:
    """Signed value of 4 big-endian bytes; null unless there are exactly 4."""
    half = 1 << 31
    signed = F.pmod(_unsigned(data) + half, F.lit(1 << 32)) - half
    return F.when(F.octet_length(data) == 4, signed).cast("int")


def text_to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def bytes_to_text(data: Column) -> Column:
    """UTF-8 text; invalid sequences become replacement characters."""
    return F.make_valid_utf8(data.cast("string"))


def encode_layout(values: dict[str, Column], layout: Layout) -> Column:
    """The bytes of one record. A null in a field that cannot be null makes the result null."""
    parts = []
    for name, kind in layout:
        value = values[name]
        if kind == "int":
            parts.append(int_to_bytes(value))
            continue
        if kind == "string_or_null":
            value = F.coalesce(value, F.lit(""))
        data = text_to_bytes(value)
        parts += [int_to_bytes(F.octet_length(data)), data]
    return F.concat(*parts)


def split_layout(value: Column, layout: Layout) -> Column:
    """The bytes of each field as an array; null if the value ends before the last field does.

    A fold over the fields, because each one starts where the one before it ended. A length is
    read without sign: a negative one is then too long for any value.
    """
    total = F.octet_length(value)

    def step(state: Column, prefixed: Column) -> Column:
        at = state["at"]
        start = F.when(prefixed, at + 4).otherwise(at)
        size = F.when(prefixed, _unsigned(F.substring(value, at, F.lit(4)))).otherwise(F.lit(4).cast("long"))
        part = F.substring(value, start, size.cast("int"))
        end = start + size
        fits = state["fits"] & F.coalesce(end <= total + 1, F.lit(False))
        return F.struct(
            F.when(fits, end).otherwise(at).cast("int").alias("at"),
            fits.alias("fits"),
            F.when(fits, F.concat(state["parts"], F.array(part))).otherwise(state["parts"]).alias("parts"),
        )

    begin = F.struct(
        F.lit(1).alias("at"), value.isNotNull().alias("fits"), F.array().cast("array<binary>").alias("parts")
    )
    kinds = F.array(*[F.lit(kind != "int") for _, kind in layout])
    return F.aggregate(kinds, begin, step, lambda state: F.when(state["fits"], state["parts"]))


def decode_layout(df: DataFrame, value: str, layout: Layout, ok: str = "decoded_ok") -> DataFrame:
    """``df`` plus the fields of ``layout`` and a flag; the fields of a broken value are null.
    Bytes after the last field are ignored."""
    fields = {}
    for i, (name, kind) in enumerate(layout):
        part = F.get(F.col("__parts"), F.lit(i))
        field = bytes_to_int(part) if kind == "int" else bytes_to_text(part)
        fields[name] = F.nullif(field, F.lit("")) if kind == "string_or_null" else field
    split = df.withColumn("__parts", split_layout(F.col(value), layout))
    return split.withColumns(fields | {ok: F.col("__parts").isNotNull()}).drop("__parts")


def decode_json(df: DataFrame, value: str, schema: str | StructType, ok: str = "decoded_ok") -> DataFrame:
    """``df`` plus the fields of a JSON value by a user's schema, and whether it could be read; works
    on streams too. A value is readable if it is an object whose fields have the types of the schema;
    absent and null fields are null. The fields of an unreadable value are null. Any other format is an expression or a ``pandas_udf`` on the value column."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # what the parser cannot read goes to a field of its own, so a value whose fields are all null is not lost
    broken = "__broken" + "_" * max((len(f.name) for f in fields), default=0)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    whole = StructType([*fields.fields, StructField(broken, StringType())])
    parsed = df.withColumn("__json", F.from_json(bytes_to_text(F.col(value)), whole, options))
    found = {f.name: F.when(F.col("__json")[broken].isNull(), F.col("__json")[f.name]) for f in fields}
    readable = F.col("__json").isNotNull() & F.col("__json")[broken].isNull()
    return parsed.withColumns(found | {ok: readable}).drop("__json")
