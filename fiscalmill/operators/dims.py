"""Master data: establishments, partners, parameter mappings, value lists, parameter loading."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.functions import expr as E
from fiscalmill.operators.lookup import Lookup, left_lookup
from fiscalmill.settings import Settings


def establishments(estab: DataFrame, states: DataFrame, settings: Settings) -> DataFrame:
    """Own establishments with their state, without the codes the settings exclude.

    Rows with a null tax id or code drop out, as the comparison is then unknown.
    """
    cgc, code = F.col("CGC"), F.col("COD_ESTAB")
    ordinary = (cgc != settings.split_cgc) & (code != settings.split_drop_code)
    kept_half = (cgc == settings.split_cgc) & (code == settings.split_keep_code)
    chosen = estab.where((ordinary | kept_half) & (code != settings.removed_code))
    return with_state(chosen, states)


def matched(df: DataFrame, table: DataFrame, on: dict[str, Column], take: dict[str, str]) -> DataFrame:
    """Inner join to a lookup table of any size: broadcast behind its row count, else with frequent keys split."""
    found = left_lookup(df, Lookup(table.withColumn("_there", F.lit(True))), on, {**take, "_there": "_there"}, df.columns)
    return found.where("_there").drop("_there")


def with_state(df: DataFrame, states: DataFrame) -> DataFrame:
    """Adds UF; rows without a known state drop out."""
    return matched(df, states, {"IDENT_ESTADO": F.col("IDENT_ESTADO")}, {"UF": "COD_ESTADO"})


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows ranked first within their key; ties all stay. Spark limits the groups before the shuffle."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("POSICAO", rank).where(F.col("POSICAO") == 1)


def _newest_partner_first() -> list[Column]:
    # The master database sorts nulls as the highest value.
    return [
        F.col("VALID_FIS_JUR").desc_nulls_first(),
        F.col("IND_FIS_JUR").asc_nulls_last(),
        F.col("IDENT_FIS_JUR").desc_nulls_first(),
    ]


def partners_by_tax_id(partners: DataFrame, states: DataFrame) -> DataFrame:
    return latest_by(with_state(partners, states), ["CPF_CGC"], _newest_partner_first())


def partners_by_code(partners: DataFrame, states: DataFrame) -> DataFrame:
    return latest_by(with_state(partners, states), ["COD_FIS_JUR"], _newest_partner_first())


def partner_tax_ids(partners: DataFrame) -> DataFrame:
    """Tax ids of the newest partner versions, under two names; serves as the partner value list."""
    newest = latest_by(partners, ["CPF_CGC"], _newest_partner_first())
    return newest.select("CPF_CGC", F.col("CPF_CGC").alias("CNPJ")).distinct()


def parameters(details: DataFrame, heads: DataFrame, name: str, settings: Settings) -> DataFrame:
    """Detail rows of one parameter of the configured group."""
    group = heads.where(F.col("NOME_FRAMEWORK") == settings.param_framework).select("ID_PARAMETROS")
    rows = details.where(F.col("NOME_PARAM") == name)
    return matched(rows, group, {"ID_PARAMETROS": F.col("ID_PARAMETRO")}, {})


def cfop_map(details: DataFrame, heads: DataFrame, settings: Settings) -> DataFrame:
    """Operation code to internal code and nature; the value reads "code/nature"."""
    return (
        parameters(details, heads, settings.cfop_param, settings)
        .select(
            F.col("NOME_PARAM").alias("nome_param"),
            F.col("CONTEUDO").alias("cod_cfo"),
            F.col("DESCRICAO").alias("descricao"),
            F.substring("VALOR", 1, 4).alias("novo_cfo"),
            F.substring("VALOR", 6, 3).alias("novo_natop"),
        )
        .distinct()
    )


def override_map(details: DataFrame, heads: DataFrame, settings: Settings) -> DataFrame:
    """Issuer tax id to the partner code that replaces the one found by tax id."""
    return (
        parameters(details, heads, settings.override_param, settings)
        .select(
            F.col("NOME_PARAM").alias("nome_param"),
            F.col("CONTEUDO").alias("CNPJ"),
            F.col("VALOR").alias("cod_fis_jur"),
        )
        .distinct()
    )


def latest_products(products: DataFrame) -> DataFrame:
    return latest_by(products, ["COD_PRODUTO"], [F.col("VALID_PRODUTO").desc_nulls_first()])


def product_map(
    details: DataFrame, heads: DataFrame, products: DataFrame, units: DataFrame, settings: Settings
) -> DataFrame:
    """Product key to internal product and its unit, from the newest product version."""
    mapped = parameters(details, heads, settings.product_param, settings)
    newest = latest_products(products).select("COD_PRODUTO", "IDENT_UND_PADRAO")
    named = {"COD_UND_PADRAO": "COD_UND_PADRAO"}
    unit_of = left_lookup(newest, Lookup(units), {"IDENT_UND_PADRAO": F.col("IDENT_UND_PADRAO")}, named, ["COD_PRODUTO"])
    take = {"cod_und_padrao": "COD_UND_PADRAO"}
    joined = left_lookup(mapped, Lookup(unit_of), {"COD_PRODUTO": F.col("VALOR")}, take, ["CONTEUDO", "VALOR"])
    return joined.select(
        F.col("NOME_PARAM").alias("nome_param"),
        F.col("CONTEUDO").alias("cod_ncm"),
        F.col("DESCRICAO").alias("descricao"),
        F.col("VALOR").alias("material"),
        "cod_und_padrao",
    ).distinct()


def operation_code_list(codes: DataFrame) -> DataFrame:
    return codes.select(F.col("COD_CFO").cast("string").alias("cod_cfo"), "DESCRICAO").distinct().orderBy("cod_cfo")


def product_code_list(codes: DataFrame) -> DataFrame:
    return codes.select("COD_NBM", "DESCRICAO").distinct().orderBy("COD_NBM")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in a lookup table and would multiply document rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def load_parameters(current: DataFrame, heads: DataFrame, mapping: DataFrame, settings: Settings) -> DataFrame:
    """Parameter details after replacing every row of the configured group.

    `mapping` has NOME_PARAM, CONTEUDO, DESCRICAO, VALOR. Descriptions are cut to 300 characters. Row ids continue
    above the highest id in use and need only be unique, so no global sort is made.
    """
    group = heads.where(F.col("NOME_FRAMEWORK") == settings.param_framework).agg(F.min("ID_PARAMETROS")).scalar()
    last_id = current.agg(F.coalesce(F.max("ID_PARAM_DET"), F.lit(0))).scalar()
    kept = current.where(~F.coalesce(F.col("ID_PARAMETRO") == group, F.lit(False)))
    fresh = mapping.select(
        (last_id + 1 + F.monotonically_increasing_id()).alias("ID_PARAM_DET"),
        group.alias("ID_PARAMETRO"),
        "NOME_PARAM",
        "CONTEUDO",
        F.substring("DESCRICAO", 1, 300).alias("DESCRICAO"),
        "VALOR",
    )
    return kept.select(*fresh.columns).unionByName(fresh)


KEY_ROWS = 500_000
"""A lookup table of which only the key is read is broadcast up to this many rows."""


@dataclass(frozen=True)
class Dimensions:
    """Lookup tables of one run, each counted at most once."""

    establishments: Lookup
    partners_by_tax_id: Lookup
    partners_by_code: Lookup
    cfop: Lookup
    products: Lookup
    overrides: Lookup

    @property
    def small(self) -> bool:
        return all(getattr(self, f.name).small for f in fields(self))

    def limited(self, broadcast_rows: int) -> Dimensions:
        """The same tables, broadcast up to another number of rows."""
        return Dimensions(**{f.name: replace(getattr(self, f.name), broadcast_rows=broadcast_rows) for f in fields(self)})

    def reduced(self, keys: dict[str, tuple[str, DataFrame]]) -> Dimensions:
        """Tables too large to broadcast cut down to the keys that a batch has: table -> (its key column, keys)."""
        wanted = {n: k for n, k in keys.items() if not getattr(self, n).small}
        return replace(self, **{n: getattr(self, n).only(column, found).staged(n) for n, (column, found) in wanted.items()})

    def counting(self) -> Dimensions:
        """For rows that take nothing of a product: of the products only the rows whose key repeats, by their key.

        A key that is there once, or not at all, gives one row in a left join either way.
        """
        keys = self.products.frame.select("ncm_key")
        repeated = keys.join(repeated_keys(keys, ["ncm_key"]).select("ncm_key"), "ncm_key", "left_semi")
        none = {c: F.lit(None).cast("string") for c in self.products.frame.columns if c != "ncm_key"}
        products = Lookup(repeated.withColumns(none), broadcast_rows=KEY_ROWS)
        return replace(self, products=products.staged("repeated-products"))

    def staged(self) -> Dimensions:
        """Every table written once, side by side: each is small work beside the documents."""
        names = [f.name for f in fields(self)]
        with ThreadPoolExecutor(len(names)) as pool:
            done = list(pool.map(lambda n: getattr(self, n).staged(n), names))
        return Dimensions(**dict(zip(names, done)))


@dataclass(frozen=True)
class MasterData:
    """Master tables as they are stored."""

    establishments: DataFrame
    states: DataFrame
    partners: DataFrame
    heads: DataFrame
    details: DataFrame
    products: DataFrame
    units: DataFrame


def dimensions(master: MasterData, settings: Settings) -> Dimensions:
    """Lookup tables with the padded join keys that documents use."""
    by_tax_id = partners_by_tax_id(master.partners, master.states)
    products = product_map(master.details, master.heads, master.products, master.units, settings)
    return Dimensions(
        establishments=Lookup(establishments(master.establishments, master.states, settings)),
        partners_by_tax_id=Lookup(by_tax_id.withColumn("tax_key", E.tax_key(F.col("CPF_CGC")))),
        partners_by_code=Lookup(partners_by_code(master.partners, master.states)),
        cfop=Lookup(cfop_map(master.details, master.heads, settings)),
        products=Lookup(products.withColumn("ncm_key", E.product_key(F.col("cod_ncm")))),
        overrides=Lookup(override_map(master.details, master.heads, settings)),
    )
