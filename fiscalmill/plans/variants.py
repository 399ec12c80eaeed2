"""Superseded revisions of the tables, kept for comparison with old results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E
from fiscalmill.operators import dims as D
from fiscalmill.operators import items as I
from fiscalmill.operators.headers import NUMBER
from fiscalmill.operators.lookup import HOT_ROWS, Lookup, left_lookup, salted_join
from fiscalmill.operators.numbering import number_rows
from fiscalmill.operators.partners import without_master
from fiscalmill.settings import HEADER_LAYOUT, ITEM_LAYOUT, PARTNER_LAYOUT, Settings

# Columns and widths of the first layout.
FIRST_HEADER_LAYOUT = HEADER_LAYOUT[:30]
FIRST_ITEM_LAYOUT = [c for c in ITEM_LAYOUT if c not in ("NUM_DOCFIS_REF", "SERIE_DOCFIS_REF")]
AMOUNT_WIDTH, QUANTITY_WIDTH = 15, 11
FIRST_MODEL = "55"

NUMBER_KEYS = ["COD_EMPRESA", "COD_ESTAB", "NUM_DOCFIS"]


def headers_with_sums(
    docs: DataFrame, sums: DataFrame, passed: list[str], hot_rows: int = HOT_ROWS, rows: int | None = None
) -> DataFrame:
    """Inner join of headers to item sums by company, establishment and number; others drop out."""
    heads = docs.select(
        *passed,
        "COD_EMPRESA",
        "COD_ESTAB",
        E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT")).alias("NUM_DOCFIS"),
        E.doc("emit.CPF").alias("_cpf"),
        E.doc("emit.IE").alias("_ie"),
    )
    joined = salted_join(heads, sums, NUMBER_KEYS, passed, hot_rows, "inner", rows)
    amounts = {
        name: E.fixed_point(E.avulsa_amount(F.col("_cpf"), F.col("_ie"), F.col(name)), 2, 15)
        for name in ("BASE_IPI", "BASE_OUTR_ICMS", "BASE_ISEN_ICMS")
    }
    return joined.withColumns(amounts).drop("_cpf", "_ie")


# The first layout: goods invoices only, one way to an establishment, narrower columns.


def first_partner_code(cnpj: Column, cpf: Column) -> Column:
    """M, first three and last four digits of the tax id."""
    tax_id = F.coalesce(cnpj, cpf)
    return F.concat(F.lit("M"), F.substring(tax_id, 1, 3), F.substring(tax_id, -4, 4))


def first_date(ts: Column) -> Column:
    """yyyyMMdd of the moment in UTC: late evening hours of western zones fall on the next day."""
    return F.date_format(F.to_utc_timestamp(F.try_to_timestamp(ts), F.current_timezone()), "yyyyMMdd")


def first_product_map(details: DataFrame, heads: DataFrame, products: DataFrame, units: DataFrame, settings: Settings) -> DataFrame:
    """Product key to internal product with the unit of every product version, not only the newest."""
    mapped = D.parameters(details, heads, settings.product_param, settings)
    unit = {"cod_und_padrao": "COD_UND_PADRAO"}
    versions = products.select("COD_PRODUTO", "IDENT_UND_PADRAO")
    named = left_lookup(versions, Lookup(units), {"IDENT_UND_PADRAO": F.col("IDENT_UND_PADRAO")}, unit, ["COD_PRODUTO"])
    take = {"cod_und_padrao": "cod_und_padrao"}
    joined = left_lookup(mapped, Lookup(named), {"COD_PRODUTO": F.col("VALOR")}, take, ["CONTEUDO", "VALOR"])
    return joined.select(F.col("CONTEUDO").alias("cod_ncm"), F.col("VALOR").alias("material"), "cod_und_padrao").distinct()


def goods_invoices(docs: DataFrame) -> DataFrame:
    return docs.where(E.doc("ide.nNF").isNotNull())


def first_resolved(docs: DataFrame, dims: D.Dimensions, settings: Settings, spread: list[str]) -> DataFrame:
    """Goods invoices with the establishment that their recipient names, and their issuer without overrides."""
    goods = goods_invoices(docs)
    own = dims.establishments.where(F.col("COD_ESTAB").startswith(settings.estab_prefix))
    place = {"COD_EMPRESA": "COD_EMPRESA", "COD_ESTAB": "COD_ESTAB"}
    out = left_lookup(goods, own, {"CGC": E.doc("dest.CNPJ")}, place, spread, base=goods)
    cnpj, cpf = E.doc("emit.CNPJ"), E.doc("emit.CPF")
    known = {"_code": "COD_FIS_JUR", "_kind": "IND_FIS_JUR"}
    out = left_lookup(out, dims.partners_by_tax_id, {"tax_key": E.tax_key(cnpj, cpf)}, known, spread, base=goods)
    return out.withColumns(
        {"COD_FIS_JUR": F.coalesce("_code", first_partner_code(cnpj, cpf)), "_kind": F.coalesce("_kind", F.lit("1"))}
    )


def _first_amount(value: Column, decimals: int = 2) -> Column:
    return E.fixed_point(E.issuer_amount(value), decimals, AMOUNT_WIDTH)


def _avulsa_value(amount: Column) -> Column:
    """`E.issuer_amount` where the document is told by `_avulsa` alone."""
    zero = F.lit(0).cast("decimal(1,0)")
    return F.when(F.col("_avulsa"), zero).otherwise(F.coalesce(amount, zero))


def _avulsa_digits(amount: Column, decimals: int) -> Column:
    return E.fixed_point(_avulsa_value(amount), decimals, AMOUNT_WIDTH)


def first_items(
    resolved: DataFrame, dims: D.Dimensions, products: Lookup, settings: Settings, passed: list[str]
) -> DataFrame:
    """Items of the first layout: the document's unit, no default origin, a base of value, discount and IPI only.

    Product keys are compared as they are written.
    """
    item = F.col("item")
    prod, taxes = item["prod"], item["imposto"]
    zero = F.lit(0).cast(E.MONEY)
    base = prod["vProd"] - F.coalesce(prod["vDesc"], zero) + F.coalesce(taxes["IPI"]["IPITrib"]["vIPI"], zero)
    # Numbers go through the joins, their digits are made afterwards.
    numbers = {"_quantity": prod["qCom"], "_price": prod["vUnCom"], "_value": prod["vProd"], "_discount": prod["vDesc"], "_base": base}
    own = I.explode_items(resolved).select(
        *passed,
        "COD_EMPRESA",
        "COD_ESTAB",
        F.col("_kind").alias("IND_FIS_JUR"),
        "COD_FIS_JUR",
        E.doc("ide.nNF").alias("_nnf"),
        E.doc("ide.serie").alias("SERIE_DOCFIS"),
        item["_nItem"].alias("NUM_ITEM"),
        prod["uCom"].alias("COD_MEDIDA"),
        F.coalesce(*[taxes["ICMS"][v]["orig"] for v in E.ICMS_VARIANTS]).alias("COD_SITUACAO_A"),
        E.situation_code(taxes["ICMS"]["ICMS00"]["vICMS"]).alias("COD_SITUACAO_B"),
        E.tribute_code(taxes["ICMS"]["ICMS00"]["vICMS"]).alias("TRIB_ICMS"),
        E.is_avulsa(E.doc("emit.CPF"), E.doc("emit.IE")).alias("_avulsa"),
        *[n.alias(name) for name, n in numbers.items()],
        prod["CFOP"].alias("_cfop_key"),
        prod["NCM"].alias("_ncm_key"),
    )
    spread = [*passed, "NUM_ITEM"]
    # The largest table first, so that its rows carry one operation code and not the two that it stands for.
    take = {"_material": "material", "_unit": "cod_und_padrao"}
    out = left_lookup(own, products, {"cod_ncm": F.col("_ncm_key")}, take, spread)
    out = left_lookup(out, dims.cfop, {"cod_cfo": F.col("_cfop_key")}, I.CFOP_COLUMNS, spread, base=own)
    digits = lambda name, decimals=2: _avulsa_digits(F.col(name), decimals)
    texts = {
        "NUM_DOCFIS": E.document_number(F.col("_nnf"), F.lit(None)),
        "QUANTIDADE": E.fixed_point(F.col("_quantity"), 6, QUANTITY_WIDTH),
        "COD_NBM": F.lpad("_ncm_key", 8, "0"),
        "VLR_UNIT": digits("_price", 4),
        "VLR_ITEM": digits("_value"),
        **{c: digits("_base") for c in ("BASE_ICMS", "BASE_IPI", "VLR_CONTAB_ITEM")},
        "VLR_DESCONTO": digits("_discount"),
        I.BASE: _avulsa_value(F.col("_base")).cast(E.MONEY),
    }
    mapped = {"COD_PRODUTO": "_material", "COD_UND_PADRAO": "_unit", "COD_CFO": "_cfo", "COD_NATUREZA_OP": "_natop"}
    fixed = {n: F.lit(v) for n, v in settings.constants["goods"].items()}
    dates = {n: F.lit(settings.run_date) for n in ("DATA_FISCAL", "DAT_LANC_PIS_COFINS")}
    codes = {n: E.or_sentinel(F.col(c), settings.sentinel) for n, c in mapped.items()}
    return out.withColumns(fixed | dates | codes | texts).select(*FIRST_ITEM_LAYOUT, I.BASE, *passed)


def first_headers(
    resolved: DataFrame,
    items: DataFrame,
    dims: D.Dimensions,
    settings: Settings,
    counter: int,
    passed: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Headers of the first layout, numbered; only documents with item sums under their three keys have one."""
    sums = I.item_sums_by_number(items)
    names = {n: F.col(n).alias(f"_{n}") for n in ("BASE_IPI", "BASE_OUTR_ICMS", "BASE_ISEN_ICMS")}
    sums = sums.select(*NUMBER_KEYS, *names.values())
    reference, discount = F.get(E.doc("ide.NFref"), 0), E.doc("total.ICMSTot.vDesc")
    avulsa = E.is_avulsa(E.doc("emit.CPF"), E.doc("emit.IE"))
    heads = resolved.select(
        *passed,
        "COD_EMPRESA",
        "COD_ESTAB",
        F.lit("NFE").alias("COD_DOCTO"),
        F.col("_kind").alias("IDENT_FIS_JUR"),
        "COD_FIS_JUR",
        E.document_number(E.doc("ide.nNF"), F.lit(None)).alias("NUM_DOCFIS"),
        E.doc("ide.serie").alias("SERIE_DOCFIS"),
        first_date(E.doc("ide.dhEmi")).alias("DATA_EMISSAO"),
        E.doc("ide.mod").alias("COD_MODELO"),
        F.substring(reference["refNFe"], 1, 12).alias("NUM_DOCFIS_REF"),
        reference["refNF"]["serie"].alias("SERIE_DOCFIS_REF"),
        _first_amount(E.doc("total.ICMSTot.vProd")).alias("VLR_PRODUTO"),
        _first_amount(E.doc("total.ICMSTot.vNF")).alias("VLR_TOT_NOTA"),
        F.col("protNFe.infProt.chNFe").alias("NUM_AUTENTIC_NFE"),
        F.lit(FIRST_MODEL).alias("COD_MODELO_COTEPE"),
        F.when(avulsa, "S").alias("IND_NF_REG_ESPECIAL"),
        _first_amount(discount).alias("VLR_DESCONTO"),
        E.fixed_point(discount, 2, AMOUNT_WIDTH).alias("VLR_ABAT_NTRIBUTADO"),
        avulsa.alias("_avulsa"),
        F.get(E.doc("det"), 0)["prod"]["CFOP"].alias("_cfop_key"),
        E.doc("ide.nNF").try_cast("bigint").alias("_number"),
    )
    out = salted_join(heads, sums, NUMBER_KEYS, passed, hot_rows, "inner")
    out = left_lookup(out, dims.cfop, {"cod_cfo": F.col("_cfop_key")}, I.CFOP_COLUMNS, passed)
    nothing = F.lit(0).cast("decimal(1,0)")
    digits = lambda n: E.fixed_point(F.when(F.col("_avulsa"), nothing).otherwise(F.coalesce(f"_{n}", nothing)), 2, AMOUNT_WIDTH)
    values = {
        "COD_CFO": E.or_sentinel(F.col("_cfo"), settings.sentinel),
        "BASE_ISEN_ICMS": digits("BASE_ISEN_ICMS"),
        "BASE_OUTR_ICMS": digits("BASE_OUTR_ICMS"),
        "BASE_OUTR_IPI": digits("BASE_IPI"),
    }
    fixed = {n: F.lit(v) for n, v in settings.constants["header"].items()}
    dates = {n: F.lit(settings.run_date) for n in ("DATA_SAIDA_REC", "DAT_LANC_PIS_COFINS")}
    plain = out.withColumns(fixed | dates | values).select(*[c for c in FIRST_HEADER_LAYOUT if c != NUMBER], "_number", *passed)
    order = [F.col(c).asc_nulls_first() for c in ("_number", "NUM_AUTENTIC_NFE", "SERIE_DOCFIS", *passed)]
    return number_rows(plain, order, counter, NUMBER).select(*FIRST_HEADER_LAYOUT, *passed)


def first_new_partners(docs: DataFrame, dims: D.Dimensions) -> DataFrame:
    """Distinct issuers of goods invoices without a master row: the first layout's code and date, no default country."""
    cnpj, cpf, address = E.doc("emit.CNPJ"), E.doc("emit.CPF"), "emit.enderEmit"
    issuers = docs.where(E.doc("ide.nNF").isNotNull()).select(
        F.lit("1").alias("IND_FIS_JUR"),
        first_partner_code(cnpj, cpf).alias("COD_FIS_JUR"),
        first_date(E.doc("ide.dhEmi")).alias("DATA_X04"),
        F.lit("1").alias("IND_CONTEM_COD"),
        E.doc("emit.xNome").alias("RAZAO_SOCIAL"),
        E.padded_issuer_id(cnpj, cpf).alias("CPF_CGC"),
        E.doc("emit.IE").alias("INSC_ESTADUAL"),
        F.substring(E.doc("emit.xNome"), 1, 50).alias("NOME_FANTASIA"),
        F.substring(E.doc(f"{address}.xLgr"), 1, 50).alias("ENDERECO"),
        E.doc(f"{address}.nro").alias("NUM_ENDERECO"),
        F.substring(E.doc(f"{address}.xBairro"), 1, 20).alias("BAIRRO"),
        E.doc(f"{address}.xMun").alias("CIDADE"),
        E.doc(f"{address}.UF").alias("UF"),
        E.doc(f"{address}.CEP").alias("CEP"),
        F.substring(E.doc(f"{address}.cPais"), 1, 3).alias("COD_PAIS"),
        E.municipality(E.doc(f"{address}.cMun")).alias("COD_MUNICIPIO"),
    )
    return without_master(issuers.distinct(), dims).select(*PARTNER_LAYOUT)


def places_of_document(docs: DataFrame, passed: list[str]) -> DataFrame:
    """Origin and destination as the document has them, without what the master data knows."""
    return docs.select(
        *passed,
        E.doc("ide.UFIni").alias("UF_ORIG_DEST"),
        E.doc("ide.UFFim").alias("UF_DESTINO"),
        E.municipality(E.doc("ide.cMunIni")).alias("COD_MUNICIPIO_ORIG"),
        E.municipality(E.doc("ide.cMunFim")).alias("COD_MUNICIPIO_DEST"),
    )
