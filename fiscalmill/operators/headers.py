"""Header table: one row per document with the sums of its items and a control number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E
from fiscalmill.operators.dims import Dimensions
from fiscalmill.operators.items import CFOP_COLUMNS, SERIES, SUM_KEYS
from fiscalmill.operators.lookup import HOT_ROWS, left_lookup, salted_join
from fiscalmill.operators.numbering import number_rows
from fiscalmill.settings import HEADER_LAYOUT, Settings

NUMBER = "NUM_CONTROLE_DOCTO"
SUMS = ["BASE_IPI", "BASE_OUTR_ICMS", "BASE_ISEN_ICMS"]


def _amount(goods_value: Column) -> Column:
    """Header amount: the goods total, or the freight price as written."""
    goods = E.fixed_point(E.issuer_amount(goods_value), 2, 17)
    return F.when(E.doc("ide.nCT").isNull(), goods).otherwise(E.raw_digits(E.doc("vPrest.vTPrest"), 17))


def header_cfop(first_item: Column, document: Column) -> Column:
    return F.coalesce(first_item, document)


def document_columns(docs: DataFrame, settings: Settings, passed: list[str]) -> DataFrame:
    """Header columns that depend on the resolved document alone, plus the keys of the later joins."""
    nnf, nct, model = E.doc("ide.nNF"), E.doc("ide.nCT"), E.doc("ide.mod")
    reference = F.get(E.doc("ide.NFref"), 0)["refNFe"]
    discount = E.doc("total.ICMSTot.vDesc")
    avulsa = E.is_avulsa(E.doc("emit.CPF"), E.doc("emit.IE"))
    return docs.select(
        *passed,
        *[F.col(k).alias(f"_doc_{k}") for k in ("COD_EMPRESA", "COD_ESTAB", "COD_FIS_JUR")],
        E.header_class(nnf, model, settings.freight_model).alias("COD_DOCTO"),
        E.document_number(nnf, nct).alias("NUM_DOCFIS"),
        E.doc("ide.serie").alias("SERIE_DOCFIS"),
        E.issue_date(E.doc("ide.dhEmi")).alias("DATA_EMISSAO"),
        model.alias("COD_MODELO"),
        E.key_number(reference).alias("NUM_DOCFIS_REF"),
        E.key_series(reference).alias("SERIE_DOCFIS_REF"),
        _amount(E.doc("total.ICMSTot.vProd")).alias("VLR_PRODUTO"),
        _amount(E.doc("total.ICMSTot.vNF")).alias("VLR_TOT_NOTA"),
        F.col("protNFe.infProt.chNFe").alias("NUM_AUTENTIC_NFE"),
        model.alias("COD_MODELO_COTEPE"),
        F.when(avulsa, "S").alias("IND_NF_REG_ESPECIAL"),
        E.fixed_point(E.issuer_amount(discount), 2, 17).alias("VLR_DESCONTO"),
        E.raw_digits(discount, 17).alias("VLR_ABAT_NTRIBUTADO"),
        F.coalesce(E.doc("ide.UFFim"), F.col("_dest_uf")).alias("UF_DESTINO"),
        F.coalesce(E.municipality(E.doc("ide.cMunFim")), F.col("_dest_mun")).alias("COD_MUNICIPIO_DEST"),
        E.doc("ide.UFIni").alias("_uf_ini"),
        E.municipality(E.doc("ide.cMunIni")).alias("_mun_ini"),
        "_x04_uf",
        "_x04_mun",
        avulsa.alias("_avulsa"),
        header_cfop(F.get(E.doc("det"), 0)["prod"]["CFOP"], E.doc("ide.CFOP")).alias("_cfop_key"),
        F.coalesce(nnf, nct).try_cast("bigint").alias("_number"),
    )


def constants(settings: Settings) -> dict[str, Column]:
    """Header columns that are the same in all rows."""
    fixed = {n: F.lit(v) for n, v in settings.constants["header"].items()}
    return fixed | {n: F.lit(settings.run_date) for n in ("DATA_SAIDA_REC", "DAT_LANC_PIS_COFINS")}


def unnumbered_headers(
    docs: DataFrame,
    sums: DataFrame,
    dims: Dimensions,
    settings: Settings,
    passed: list[str],
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Headers joined to item sums and to the partner of the summed items. `rows` is the number of documents."""
    spread = [*passed, "NUM_AUTENTIC_NFE", "SERIE_DOCFIS"]
    base = out = document_columns(docs, settings, passed)

    # Company, establishment and partner come from the sums, so a header without matching items has none.
    keys = [f"_doc_{k}" for k in SUM_KEYS if k != "NUM_DOCFIS"] + ["NUM_DOCFIS"]
    keys += [SERIES] if SERIES in sums.columns else []
    named = sums.select(
        "*",
        *[F.col(k).alias(f"_doc_{k}") for k in SUM_KEYS if k != "NUM_DOCFIS"],
    )
    # Their partner is looked up before the join: sums are narrower rows than headers.
    coded = base.withColumnRenamed("_doc_COD_FIS_JUR", "COD_FIS_JUR")
    partner = {"_param_uf": "UF", "_param_mun": "COD_MUNICIPIO"}
    named = left_lookup(
        named, dims.partners_by_code, {"COD_FIS_JUR": F.col("COD_FIS_JUR")}, partner, ["NUM_DOCFIS"], base=coded
    )
    out = salted_join(out, named, keys, spread, hot_rows, left_rows=rows, counted=base)
    out = left_lookup(out, dims.cfop, {"cod_cfo": F.col("_cfop_key")}, CFOP_COLUMNS, spread, base=base)

    def sum_digits(name: str) -> Column:
        zero = F.lit(0).cast("decimal(1,0)")
        return E.fixed_point(F.when(F.col("_avulsa"), zero).otherwise(F.coalesce(F.col(name), zero)), 2, 17)

    values = {
        "COD_CFO": E.or_sentinel(F.col("_cfo"), settings.sentinel),
        "COD_NATUREZA_OP": E.or_sentinel(F.col("_natop"), settings.sentinel),
        "UF_ORIG_DEST": F.coalesce("_uf_ini", "_param_uf", "_x04_uf"),
        "COD_MUNICIPIO_ORIG": F.coalesce("_mun_ini", "_param_mun", "_x04_mun"),
        "BASE_ISEN_ICMS": sum_digits("BASE_ISEN_ICMS"),
        "BASE_OUTR_ICMS": sum_digits("BASE_OUTR_ICMS"),
        "BASE_OUTR_IPI": sum_digits("BASE_IPI"),
    }
    out = out.withColumns(constants(settings) | values)
    return out.select(*[c for c in HEADER_LAYOUT if c != NUMBER], "_number", *passed)


def number_order() -> list[Column]:
    """Document number first; the rest makes the order of equal numbers repeatable."""
    ties = ["NUM_AUTENTIC_NFE", "SERIE_DOCFIS", "COD_FIS_JUR", "IDENT_FIS_JUR", "COD_ESTAB", "VLR_TOT_NOTA"]
    return [F.col("_number").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]]


def header_table(
    docs: DataFrame,
    sums: DataFrame,
    dims: Dimensions,
    settings: Settings,
    counter: int | Column,
    passed: list[str],
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Header table of resolved documents, numbered from `counter` on."""
    rows = unnumbered_headers(docs, sums, dims, settings, passed, hot_rows, rows)
    order = number_order() + [F.col(c).asc_nulls_first() for c in passed]
    same = constants(settings)
    numbered = number_rows(rows.drop(*same), order, counter, NUMBER)
    return numbered.withColumns(same).select(*HEADER_LAYOUT, *passed)
