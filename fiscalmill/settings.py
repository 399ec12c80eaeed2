"""Business settings and fixed output layouts."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Values a company sets once; every operator takes them from here."""

    run_date: str = "20240131"
    """Run date as yyyyMMdd, a parameter so that a re-run gives the same rows."""

    own_tax_root: str = "33009911"
    """First eight digits of the tax ids that belong to the company itself."""

    estab_prefix: str = "BR"
    """Only establishments whose code starts with this can receive documents."""

    split_cgc: str = "33009911046988"
    """Tax id held by two establishment codes ..."""

    split_drop_code: str = "BRBX"
    """... of which this one is never used ..."""

    split_keep_code: str = "BRBQ"
    """... and this one is the only one kept."""

    removed_code: str = "BRCR"
    """Establishment code that is left out."""

    param_framework: str = "XML_INTAKE"
    """Name of the parameter group that holds the three mappings."""

    # Names of the mappings in the parameter table, and product keys of freight documents.
    cfop_param: str = "CFOP NatOp"
    product_param: str = "Produto"
    override_param: str = "CNPJ"

    freight_model: str = "57"
    freight_product_key: str = "1050113"
    """Product key of freight documents of `freight_model`."""

    other_freight_product_key: str = "104011200"
    """Product key of every other freight document."""

    sentinel: str = "NP"
    """Written where a mapping has no entry."""

    default_country: str = "105"

    constants: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "header": dict(HEADER_CONSTANTS),
            "goods": {**ITEM_CONSTANTS, **GOODS_CONSTANTS},
            "freight": {**ITEM_CONSTANTS, **FREIGHT_CONSTANTS},
        }
    )


# Constant columns of the layouts.
HEADER_CONSTANTS = {
    "MOVTO_E_S": "1",
    "NORM_DEV": "1",
    "COD_CLASS_DOC_FIS": "1",
    "SITUACAO": "N",
    "IND_FATURA": "3",
    "IND_TP_FRETE": "2",
}

ITEM_CONSTANTS = {
    "MOVTO_E_S": "1",
    "NORM_DEV": "1",
    "IND_PRODUTO": "8",
    "TRIB_IPI": "3",
    "COD_SITUACAO_PIS": "70",
    "COD_SITUACAO_COFINS": "70",
    "IND_BEM_PATR": "N",
}

GOODS_CONSTANTS = {
    "COD_DOCTO": "NFE",
    "COD_FEDERAL": "00003",
    "COD_TRIB_IPI": "03",
}

FREIGHT_CONSTANTS = {
    "NUM_ITEM": "1",
    "NUM_DOCFIS_REF": "",
    "SERIE_DOCFIS_REF": "",
    "QUANTIDADE": "1000000",
    "COD_SITUACAO_A": "0",
    "COD_FEDERAL": "00049",
    "VLR_DESCONTO": "@",
    "COD_TRIB_IPI": "@",
}

# Column order of the three target tables.
HEADER_LAYOUT = """
COD_EMPRESA COD_ESTAB MOVTO_E_S NORM_DEV COD_DOCTO IDENT_FIS_JUR COD_FIS_JUR NUM_DOCFIS SERIE_DOCFIS
DATA_EMISSAO COD_CLASS_DOC_FIS COD_MODELO COD_CFO NUM_DOCFIS_REF SERIE_DOCFIS_REF DATA_SAIDA_REC
VLR_PRODUTO VLR_TOT_NOTA SITUACAO NUM_CONTROLE_DOCTO IND_FATURA NUM_AUTENTIC_NFE DAT_LANC_PIS_COFINS
BASE_ISEN_ICMS BASE_OUTR_ICMS BASE_OUTR_IPI COD_MODELO_COTEPE IND_NF_REG_ESPECIAL VLR_DESCONTO
VLR_ABAT_NTRIBUTADO IND_TP_FRETE UF_ORIG_DEST UF_DESTINO COD_MUNICIPIO_ORIG COD_MUNICIPIO_DEST
COD_NATUREZA_OP
""".split()

ITEM_LAYOUT = """
COD_EMPRESA COD_ESTAB DATA_FISCAL MOVTO_E_S NORM_DEV COD_DOCTO IND_FIS_JUR COD_FIS_JUR NUM_DOCFIS
SERIE_DOCFIS IND_PRODUTO COD_PRODUTO NUM_ITEM COD_CFO NUM_DOCFIS_REF SERIE_DOCFIS_REF COD_NATUREZA_OP
QUANTIDADE COD_MEDIDA COD_NBM VLR_UNIT VLR_ITEM COD_SITUACAO_A COD_SITUACAO_B COD_FEDERAL TRIB_ICMS
BASE_ICMS TRIB_IPI BASE_IPI VLR_CONTAB_ITEM COD_SITUACAO_PIS COD_SITUACAO_COFINS DAT_LANC_PIS_COFINS
IND_BEM_PATR COD_UND_PADRAO VLR_DESCONTO COD_TRIB_IPI
""".split()

PARTNER_LAYOUT = """
IND_FIS_JUR COD_FIS_JUR DATA_X04 IND_CONTEM_COD RAZAO_SOCIAL CPF_CGC INSC_ESTADUAL NOME_FANTASIA
ENDERECO NUM_ENDERECO BAIRRO CIDADE UF CEP COD_PAIS COD_MUNICIPIO
""".split()
