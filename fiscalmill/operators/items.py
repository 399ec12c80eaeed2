"""Item table: goods lines and one line per freight document."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E
from fiscalmill.operators.dims import Dimensions
from fiscalmill.operators.lookup import left_lookup
from fiscalmill.settings import ITEM_LAYOUT, Settings

BASE = "_base_amount"
"""Tax base as a number, kept beside the encoded columns so that sums never read digit strings."""

CENT = Decimal("0.01")


def explode_items(docs: DataFrame, array: str = f"{E.DOC}.det", name: str = "item") -> DataFrame:
    """One row per item with all document columns; documents without items drop out."""
    return docs.select("*", F.explode(array).alias(name))


def lines_of(docs: DataFrame, passed: list[str]) -> DataFrame:
    """Resolved documents cut down to what item rows need, so that wide documents are not repeated per item."""
    reference = F.get(E.doc("ide.NFref"), 0)["refNFe"]
    return docs.select(
        *passed,
        "COD_EMPRESA",
        "COD_ESTAB",
        "COD_FIS_JUR",
        "_override",
        "_x04_kind",
        E.document_number(E.doc("ide.nNF"), F.lit(None)).alias("NUM_DOCFIS"),
        E.doc("ide.serie").alias("SERIE_DOCFIS"),
        E.key_number(reference).alias("NUM_DOCFIS_REF"),
        E.key_series(reference).alias("SERIE_DOCFIS_REF"),
        E.is_avulsa(E.doc("emit.CPF"), E.doc("emit.IE")).alias("_avulsa"),
    )


def _finish(df: DataFrame, constants: dict[str, str], settings: Settings, passed: list[str]) -> DataFrame:
    fixed = {name: F.lit(value) for name, value in constants.items()}
    dates = {name: F.lit(settings.run_date) for name in ("DATA_FISCAL", "DAT_LANC_PIS_COFINS")}
    return df.withColumns(fixed | dates).select(*ITEM_LAYOUT, BASE, *passed)


def _mapped(settings: Settings) -> dict[str, Column]:
    """Mapped codes with the sentinel where a mapping has no entry."""

    def known(name: str) -> Column:
        return E.or_sentinel(F.col(name), settings.sentinel)

    return {
        "COD_PRODUTO": known("_material"),
        "COD_MEDIDA": known("_unit"),
        "COD_UND_PADRAO": known("_unit"),
        "COD_CFO": known("_cfo"),
        "COD_NATUREZA_OP": known("_natop"),
    }


CFOP_COLUMNS = {"_cfo": "novo_cfo", "_natop": "novo_natop"}
PRODUCT_COLUMNS = {"_material": "material", "_unit": "cod_und_padrao", "_ncm": "cod_ncm"}


AMOUNTS = ["_price", "_value", "_discount", BASE]


def _zero() -> Column:
    return F.lit(0).cast("decimal(1,0)")


def item_numbers(lines: DataFrame, passed: list[str]) -> DataFrame:
    """What item rows take of the `item` struct, amounts as numbers and not as digits: all that goes through joins."""
    item = F.col("item")
    prod, icms = item["prod"], item["imposto"]["ICMS"]
    return lines.select(
        *passed,
        item["_nItem"].alias("NUM_ITEM"),
        prod["CFOP"].alias("_cfop_key"),
        prod["NCM"].alias("_product_key"),
        prod["qCom"].alias("_quantity"),
        F.coalesce(prod["vUnCom"], _zero()).alias("_price"),
        F.coalesce(prod["vProd"], _zero()).alias("_value"),
        F.coalesce(prod["vDesc"], _zero()).alias("_discount"),
        F.coalesce(E.tax_base(item), _zero()).cast(E.MONEY).alias(BASE),
        E.tax_origin(icms).alias("COD_SITUACAO_A"),
        E.situation_code(icms["ICMS00"]["vICMS"]).alias("COD_SITUACAO_B"),
        E.tribute_code(icms["ICMS00"]["vICMS"]).alias("TRIB_ICMS"),
    )


def goods_items(lines: DataFrame, dims: Dimensions, settings: Settings, passed: list[str]) -> DataFrame:
    """Item rows of goods invoices from `lines_of` columns and one `item` struct per row, or its `item_numbers`."""
    if "item" in lines.columns:
        lines = item_numbers(lines, [c for c in lines.columns if c != "item"])
    own = lines.withColumns({c: F.when(F.col("_avulsa"), _zero()).otherwise(F.col(c)) for c in AMOUNTS})
    own = own.withColumn(BASE, F.col(BASE).cast(E.MONEY))
    spread = [*passed, "NUM_ITEM", "_product_key", BASE]
    kind = {"_param_kind": "IND_FIS_JUR"}
    code = {"COD_FIS_JUR": F.col("_override")}
    out = left_lookup(own, dims.partners_by_code, code, kind, spread, nulls_apart=True)
    # The largest table first, so that its rows carry one code and not the two that it stands for.
    key = {"ncm_key": E.product_key(F.col("_product_key"))}
    out = left_lookup(out, dims.products, key, PRODUCT_COLUMNS, spread, base=own)
    out = left_lookup(out, dims.cfop, {"cod_cfo": F.col("_cfop_key")}, CFOP_COLUMNS, spread, base=own)
    base = E.fixed_point(F.col(BASE), 2, 17)
    values = {
        "IND_FIS_JUR": F.coalesce("_param_kind", "_x04_kind", F.lit("1")),
        "QUANTIDADE": E.fixed_point(F.col("_quantity"), 6, 17),
        "COD_NBM": F.lpad("_product_key", 8, "0"),
        "VLR_UNIT": E.fixed_point(F.col("_price"), 4, 19),
        "VLR_ITEM": E.fixed_point(F.col("_value"), 2, 17),
        "BASE_ICMS": base,
        "BASE_IPI": base,
        "VLR_CONTAB_ITEM": base,
        "VLR_DESCONTO": E.fixed_point(F.col("_discount"), 2, 17),
    }
    return _finish(out.withColumns(values | _mapped(settings)), settings.constants["goods"], settings, passed)


def freight_product_key(model: Column, settings: Settings) -> Column:
    return F.when(model == settings.freight_model, settings.freight_product_key).otherwise(
        settings.other_freight_product_key
    )


def freight_items(docs: DataFrame, dims: Dimensions, settings: Settings, passed: list[str]) -> DataFrame:
    """One item row per resolved freight document."""
    model, total = E.doc("ide.mod"), E.doc("vPrest.vTPrest")
    tax = E.doc("imp.ICMS.ICMS00.vICMS")
    freight = docs.where(E.doc("ide.nCT").isNotNull()).select(
        *passed,
        "COD_EMPRESA",
        "COD_ESTAB",
        "COD_FIS_JUR",
        F.coalesce("_x04_kind", F.lit("1")).alias("IND_FIS_JUR"),
        E.freight_class(model, settings.freight_model).alias("COD_DOCTO"),
        E.document_number(E.doc("ide.nCT"), F.lit(None)).alias("NUM_DOCFIS"),
        E.doc("ide.serie").alias("SERIE_DOCFIS"),
        E.situation_code(tax).alias("COD_SITUACAO_B"),
        E.tribute_code(tax).alias("TRIB_ICMS"),
        E.raw_digits(total, 19).alias("VLR_UNIT"),
        *[E.raw_digits(total, 17).alias(c) for c in ("VLR_ITEM", "BASE_ICMS", "BASE_IPI", "VLR_CONTAB_ITEM")],
        (E.raw_digits(total, 17).try_cast("decimal(17,0)") * F.lit(CENT)).cast(E.MONEY).alias(BASE),
        E.doc("ide.CFOP").alias("_cfop_key"),
        E.product_key(freight_product_key(model, settings)).alias("_product_key"),
    )
    spread = [*passed, "NUM_DOCFIS", "COD_FIS_JUR"]
    out = left_lookup(freight, dims.cfop, {"cod_cfo": F.col("_cfop_key")}, CFOP_COLUMNS, spread)
    out = left_lookup(out, dims.products, {"ncm_key": F.col("_product_key")}, PRODUCT_COLUMNS, spread, base=freight)
    out = out.withColumns(_mapped(settings) | {"COD_NBM": F.col("_ncm")})
    return _finish(out, settings.constants["freight"], settings, passed)


def item_table(
    resolved: DataFrame, lines: DataFrame, dims: Dimensions, settings: Settings, passed: list[str]
) -> DataFrame:
    """Goods and freight items by name. `resolved` are documents, `lines` exploded goods lines."""
    goods = goods_items(lines, dims, settings, passed)
    return goods.unionByName(freight_items(resolved, dims, settings, passed))


SUM_KEYS = ["COD_EMPRESA", "COD_ESTAB", "NUM_DOCFIS", "COD_FIS_JUR"]
SERIES = "SERIE_DOCFIS"


def _sums() -> list[Column]:
    def of(tribute: str) -> Column:
        return F.sum(F.when(F.col("TRIB_ICMS") == tribute, F.col(BASE)).otherwise(0)).cast("decimal(28,2)")

    return [
        F.sum(BASE).cast("decimal(28,2)").alias("BASE_IPI"),
        of("3").alias("BASE_OUTR_ICMS"),
        of("2").alias("BASE_ISEN_ICMS"),
    ]


def item_sums(items: DataFrame, by_series: bool = False) -> DataFrame:
    """Tax bases per company, establishment, number, partner and partner kind.

    `by_series` keeps documents apart that differ in their series only; headers then join on the series, too.
    """
    keys = [*SUM_KEYS, SERIES] if by_series else SUM_KEYS
    return items.groupBy(*keys, F.col("IND_FIS_JUR").alias("IDENT_FIS_JUR")).agg(*_sums())


def item_sums_by_number(items: DataFrame) -> DataFrame:
    """Tax bases of the superseded grouping, without the partner."""
    return items.groupBy("COD_EMPRESA", "COD_ESTAB", "NUM_DOCFIS").agg(*_sums())


def item_tax_by_series(lines: DataFrame) -> DataFrame:
    """Tax amount per number, series and partner, from exploded goods lines."""
    tax = F.col("item.imposto.ICMS.ICMS00.vICMS")
    return lines.groupBy("NUM_DOCFIS", "SERIE_DOCFIS", "COD_FIS_JUR").agg(
        F.sum(tax).cast("decimal(28,2)").alias("BASE_ICMS")
    )
