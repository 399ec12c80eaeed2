"""Document schema: default, JSON form, and merging with what new files contain."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalmill.functions.expr import ICMS_VARIANTS, MONEY, SUBSTITUTION_VARIANTS

CORRUPT = "_corrupt_record"
TEXT_FIELD = "_VALUE"
"""Field that holds the text of a tag that also has attributes."""


def _ddl(name: str, variant_fields: str) -> str:
    return f"{name}: struct<{variant_fields}>"


def _variant(name: str) -> str:
    fields = "orig: string"
    if name == "ICMS00":
        fields += f", vICMS: {MONEY}"
    if name in SUBSTITUTION_VARIANTS:
        fields += f", vICMSST: {MONEY}, vFCPST: {MONEY}"
    return _ddl(name, fields)


def item_ddl() -> str:
    """Type of one item. Unit price and quantity keep the decimals that the layout allows."""
    icms = ", ".join(_variant(v) for v in ICMS_VARIANTS)
    return (
        "struct<_nItem: string, "
        "prod: struct<CFOP: string, NCM: string, uCom: string, qCom: decimal(18,6), vUnCom: decimal(21,10), "
        f"vProd: {MONEY}, vDesc: {MONEY}, vOutro: {MONEY}, vFrete: {MONEY}, vSeg: {MONEY}>, "
        f"imposto: struct<IPI: struct<IPITrib: struct<vIPI: {MONEY}>>, ICMS: struct<{icms}>>>"
    )


def body_fields() -> list[str]:
    """Fields of the document body, without the items."""
    address = ", ".join(f"{f}: string" for f in "xLgr nro xBairro xMun cMun UF CEP cPais".split())
    party = "struct<CNPJ: string>"
    return [
        "ide: struct<nNF: string, nCT: string, serie: string, mod: string, dhEmi: string, CFOP: string, "
        "UFIni: string, UFFim: string, cMunIni: string, cMunFim: string, "
        "NFref: array<struct<refNFe: string, refNF: struct<serie: string>>>, "
        "toma3: struct<toma: string>, toma4: struct<toma: string, CNPJ: string>>",
        f"emit: struct<CNPJ: string, CPF: string, IE: string, xNome: string, enderEmit: struct<{address}>>",
        *[f"{role}: {party}" for role in "dest rem exped receb toma".split()],
        "vPrest: struct<vTPrest: string>",
        f"imp: struct<ICMS: struct<ICMS00: struct<vICMS: {MONEY}>>>",
        f"total: struct<ICMSTot: struct<vProd: {MONEY}, vNF: {MONEY}, vDesc: {MONEY}>>",
    ]


def document_schema() -> T.StructType:
    """Schema of one document as the rest of the library reads it."""
    body = ", ".join([*body_fields(), f"det: array<{item_ddl()}>"])
    return T.StructType.fromDDL(
        f"protNFe struct<infProt: struct<chNFe: string>>, NFe struct<infNFe: struct<{body}>>"
    )


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def load_schema(path: str) -> T.StructType:
    """Schema from a JSON document."""
    with open(path, encoding="utf-8") as f:
        return T.StructType.fromJson(json.load(f))


def save_schema(schema: T.StructType, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(schema.jsonValue(), f, indent=2)


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type that holds values of both: structs and arrays merge, numbers widen, the rest becomes string."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        # A tag seen once is inferred as a plain value, a repeated tag as an array.
        left = a.elementType if isinstance(a, T.ArrayType) else a
        right = b.elementType if isinstance(b, T.ArrayType) else b
        return T.ArrayType(widest(left, right), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.StructType) or isinstance(b, T.StructType):
        # An empty tag is inferred as a string next to a filled one as a struct.
        return a if isinstance(a, T.StructType) else b
    return _widest_number(a, b)


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Integer and fraction digits of an exact numeric type."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    exact = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    return (exact[type(t)], 0) if type(t) in exact else None


def _widest_number(a: T.DataType, b: T.DataType) -> T.DataType:
    left, right = _digits(a), _digits(b)
    if left and right:
        whole, fraction = max(left[0], right[0]), max(left[1], right[1])
        if fraction == 0 and not (isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType)):
            return a if left[0] >= right[0] else b
        return T.DecimalType(min(whole + fraction, 38), fraction) if whole + fraction <= 38 else T.StringType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DoubleType):
        return a  # a known exact amount stays exact
    if isinstance(a, T.DoubleType) and isinstance(b, T.DecimalType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def merge_schemas(known: T.StructType, found: T.StructType) -> T.StructType:
    """Known schema extended by the found one, field by field and at every depth.

    Names match without regard to case and keep the known spelling; nothing known is lost.
    """
    by_name = {f.name.lower(): f for f in found.fields}
    merged = []
    for f in known.fields:
        other = by_name.pop(f.name.lower(), None)
        merged.append(f if other is None else T.StructField(f.name, widest(f.dataType, other.dataType), True))
    return T.StructType(merged + [f for f in found.fields if f.name.lower() in by_name])


def _exact_number(text: Column, kind: T.DataType) -> Column:
    """Text as a number, without what stands before its digits, such as a currency sign.

    A decimal comma counts as a point; points before it separate thousands.
    """
    digits = F.trim(F.regexp_replace(text, r"^[^0-9+-]+", ""))
    plain = F.when(digits.contains(","), F.replace(F.replace(digits, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return plain.otherwise(digits).try_cast(kind)


def fitted(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """A value of a merged schema as the type that the library reads.

    Known fields keep their place at every depth, unknown ones are left out. A tag known once and found several times
    gives its first value, one known as a list and found once a list of one. Text that is no number is null.
    """
    if found == wanted:
        return value
    if isinstance(wanted, T.ArrayType):
        if isinstance(found, T.ArrayType):
            return F.transform(value, lambda x: fitted(x, found.elementType, wanted.elementType))
        return F.when(value.isNotNull(), F.array(fitted(value, found, wanted.elementType)))
    if isinstance(found, T.ArrayType):
        return fitted(F.get(value, F.lit(0)), found.elementType, wanted)
    if isinstance(wanted, T.StructType):
        if not isinstance(found, T.StructType):
            return F.lit(None).cast(wanted)
        names = {f.name.lower(): f for f in found.fields}
        missing = lambda f: F.lit(None).cast(f.dataType)
        here = lambda f: fitted(value[names[f.name.lower()].name], names[f.name.lower()].dataType, f.dataType)
        fields = [(here(f) if f.name.lower() in names else missing(f)).alias(f.name) for f in wanted.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(found, T.StructType):
        # A tag with attributes holds its text in a field of its own.
        inner = next((f for f in found.fields if f.name == TEXT_FIELD), None)
        return F.lit(None).cast(wanted) if inner is None else fitted(value[TEXT_FIELD], inner.dataType, wanted)
    if isinstance(found, T.StringType) and isinstance(wanted, T.NumericType):
        return _exact_number(value, wanted)
    return value.try_cast(wanted)


def conformed(docs: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Documents of a merged schema with the fields and types of `schema`, all other columns kept."""
    schema = schema or document_schema()
    types = {f.name: f.dataType for f in docs.schema.fields}
    known = {f.name: f.dataType for f in schema.fields}
    fields = [fitted(F.col(c), types[c], known[c]).alias(c) if c in known else F.col(c) for c in docs.columns]
    return docs.select(*fields, *[F.lit(None).cast(k).alias(n) for n, k in known.items() if n not in types])


def schema_paths(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Leaf paths and types of a schema as rows, for comparing two schemas."""
    rows: list[tuple[str, str]] = []

    def walk(t: T.DataType, path: str) -> None:
        if isinstance(t, T.ArrayType):
            walk(t.elementType, path + "[]")
        elif isinstance(t, T.StructType):
            for f in t.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            rows.append((path, t.simpleString()))

    walk(schema, "")
    return spark.createDataFrame(rows, "path string, type string")
