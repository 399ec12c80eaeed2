"""Document-level attributes: receiving establishment by role, issuer as partner."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E
from fiscalmill.operators.dims import Dimensions
from fiscalmill.operators.lookup import Lookup, left_lookup
from fiscalmill.settings import Settings


@dataclass(frozen=True)
class Role:
    """One way in which an own establishment can take part in a document."""

    name: str
    tax_id: Column
    applies: Column


def roles(settings: Settings) -> list[Role]:
    """Roles in order of precedence. The conditions test the document, so they null the join key."""
    payer, other_payer = E.doc("ide.toma3.toma"), E.doc("ide.toma4.toma")
    payer_id = F.coalesce(E.doc("ide.toma4.CNPJ"), E.doc("toma.CNPJ"))
    own_payer = (other_payer == "4") & payer_id.startswith(settings.own_tax_root)
    unnamed_payer = payer.isNull() & other_payer.isNull()
    return [
        Role("dest", E.doc("dest.CNPJ"), (payer == "3") | (E.doc("ide.mod") == "55")),
        Role("toma", payer_id, own_payer | unnamed_payer),
        Role("rem", E.doc("rem.CNPJ"), payer == "0"),
        Role("exped", E.doc("exped.CNPJ"), payer == "1"),
        Role("receb", E.doc("receb.CNPJ"), payer == "2"),
    ]


def receiving_establishment(docs: DataFrame, estab: Lookup, settings: Settings, spread: list[str]) -> DataFrame:
    """Adds COD_EMPRESA, COD_ESTAB and the state and municipality of the recipient."""
    own = estab.where(F.col("COD_ESTAB").startswith(settings.estab_prefix))
    out = docs
    order = roles(settings)
    for role in order:
        take = {f"_{role.name}_emp": "COD_EMPRESA", f"_{role.name}_est": "COD_ESTAB"}
        if role.name == "dest":
            take |= {"_dest_uf": "UF", "_dest_mun": "COD_MUNICIPIO"}
        out = left_lookup(out, own, {"CGC": role.tax_id}, take, spread, role.applies, docs)
    first = {c: F.coalesce(*[F.col(f"_{r.name}_{c}") for r in order]) for c in ("emp", "est")}
    out = out.withColumns({"COD_EMPRESA": first["emp"], "COD_ESTAB": first["est"]})
    return out.drop(*[f"_{r.name}_{c}" for r in order for c in ("emp", "est")])


def issuer_partner(docs: DataFrame, dims: Dimensions, spread: list[str], base: DataFrame | None = None) -> DataFrame:
    """Adds COD_FIS_JUR (override, else master, else derived) and what the master knows of the issuer."""
    cnpj, cpf = E.doc("emit.CNPJ"), E.doc("emit.CPF")
    out = left_lookup(docs, dims.overrides, {"CNPJ": cnpj}, {"_override": "cod_fis_jur"}, spread, base=base)
    take = {"_x04_code": "COD_FIS_JUR", "_x04_kind": "IND_FIS_JUR", "_x04_uf": "UF", "_x04_mun": "COD_MUNICIPIO"}
    out = left_lookup(out, dims.partners_by_tax_id, {"tax_key": E.tax_key(cnpj, cpf)}, take, spread, base=base)
    return with_partner_code(out)


def with_partner_code(docs: DataFrame) -> DataFrame:
    """COD_FIS_JUR of documents whose issuer was looked up."""
    derived = E.partner_code(E.doc("emit.CNPJ"), E.doc("emit.CPF"))
    return docs.withColumn("COD_FIS_JUR", F.coalesce(F.col("_override"), F.col("_x04_code"), derived))


def resolve(docs: DataFrame, dims: Dimensions, settings: Settings, spread: list[str]) -> DataFrame:
    """Documents with establishment and issuer, the common input of the header and item tables."""
    placed = receiving_establishment(docs, dims.establishments, settings, spread)
    return issuer_partner(placed, dims, spread, base=docs)


def without_items(docs: DataFrame) -> DataFrame:
    """Documents that keep of their items only the operation code of the first one, which headers read."""
    first = F.slice(E.doc("det"), 1, 1)
    code = F.transform(first, lambda i: F.struct(F.struct(i["prod"]["CFOP"].alias("CFOP")).alias("prod")))
    return docs.withColumn("NFe", F.col("NFe").withField("infNFe", F.col("NFe.infNFe").withField("det", code)))


def batch_keys(docs: DataFrame, settings: Settings) -> dict[str, tuple[str, DataFrame]]:
    """Keys by which documents and their items ask the tables that can be large."""
    cnpj, cpf = E.doc("emit.CNPJ"), E.doc("emit.CPF")
    ncm = docs.select(F.explode(F.transform(E.doc("det"), lambda i: i["prod"]["NCM"])).alias("k"))
    freight = [F.lit(k).alias("k") for k in (settings.freight_product_key, settings.other_freight_product_key)]
    fixed = docs.sparkSession.range(1).select(F.explode(F.array(*freight)).alias("k"))
    return {
        "partners_by_tax_id": ("tax_key", docs.select(E.tax_key(cnpj, cpf).alias("k"))),
        "overrides": ("CNPJ", docs.select(cnpj.alias("k"))),
        "products": ("ncm_key", ncm.unionByName(fixed).select(E.product_key(F.col("k")).alias("k"))),
    }
