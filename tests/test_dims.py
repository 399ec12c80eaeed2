from pyspark.sql import functions as F

from fiscalmill.operators import dims as D
from fiscalmill.settings import Settings
from tests.conftest import rows

STATES = "IDENT_ESTADO int, COD_ESTADO string"


def test_establishment_exclusion(spark):
    s = Settings()
    data = [
        (s.split_cgc, "BRBX"),
        (s.split_cgc, "BRBQ"),
        (s.split_cgc, "BR01"),
        ("11", "BRBX"),
        ("11", "BRCR"),
        ("11", "BR02"),
        (None, "BR03"),
        ("11", None),
    ]
    estab = spark.createDataFrame([(*d, 1) for d in data], "CGC string, COD_ESTAB string, IDENT_ESTADO int")
    states = spark.createDataFrame([(1, "SP"), (2, "RJ")], STATES)
    kept = D.establishments(estab, states, s)
    assert rows(kept.select("CGC", "COD_ESTAB")) == sorted([(s.split_cgc, "BRBQ"), ("11", "BR02")], key=repr)
    assert kept.select("UF").distinct().collect()[0][0] == "SP"


def test_newest_partner_follows_the_database_null_order(spark):
    data = [
        ("1", "A", "1", 5, None),
        ("1", "B", "1", 6, "2024-01-01"),
        ("2", "C", None, 1, "2024-01-01"),
        ("2", "D", "2", 1, "2024-01-01"),
        ("3", "E", "1", 1, "2024-01-01"),
        ("3", "F", "1", 1, "2024-01-01"),
    ]
    names = "CPF_CGC string, COD_FIS_JUR string, IND_FIS_JUR string, IDENT_FIS_JUR int, v string"
    partners = spark.createDataFrame(data, names).select(
        "*", F.col("v").cast("date").alias("VALID_FIS_JUR"), F.lit(1).alias("IDENT_ESTADO")
    )
    newest = D.partners_by_tax_id(partners, spark.createDataFrame([(1, "SP")], STATES))
    assert {r[0] for r in newest.select("COD_FIS_JUR").collect()} == {"A", "D", "E", "F"}
    assert rows(D.partner_tax_ids(partners)) == [("1", "1"), ("2", "2"), ("3", "3")]


def test_partner_rank_is_limited_before_the_shuffle(spark):
    partners = spark.range(10).select(
        F.lit("x").alias("CPF_CGC"),
        F.lit(None).cast("date").alias("VALID_FIS_JUR"),
        F.lit("1").alias("IND_FIS_JUR"),
        F.col("id").alias("IDENT_FIS_JUR"),
    )
    plan = D.partner_tax_ids(partners)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_load_parameters(spark):
    s = Settings()
    heads = spark.createDataFrame([(3, s.param_framework), (5, s.param_framework), (4, "X")], "ID_PARAMETROS long, NOME_FRAMEWORK string")
    details = "ID_PARAM_DET long, ID_PARAMETRO long, NOME_PARAM string, CONTEUDO string, DESCRICAO string, VALOR string"
    current = spark.createDataFrame([(10, 3, "Produto", "old", "d", "v"), (11, 4, "Produto", "keep", "d", "v")], details)
    mapping = spark.createDataFrame([("Produto", "new", "x" * 400, "9")], "NOME_PARAM string, CONTEUDO string, DESCRICAO string, VALOR string")
    out = {r["CONTEUDO"]: r for r in D.load_parameters(current, heads, mapping, s).collect()}
    assert set(out) == {"keep", "new"}
    assert out["new"]["ID_PARAMETRO"] == 3 and out["new"]["ID_PARAM_DET"] > 11
    assert len(out["new"]["DESCRICAO"]) == 300


def test_cfop_map_splits_and_deduplicates(spark):
    s = Settings()
    heads = spark.createDataFrame([(1, s.param_framework), (2, "X")], "ID_PARAMETROS long, NOME_FRAMEWORK string")
    details = spark.createDataFrame(
        [
            (1, 1, "CFOP NatOp", "5101", "d", "1101/01A"),
            (2, 1, "CFOP NatOp", "5101", "d", "1101/01A"),
            (3, 2, "CFOP NatOp", "5102", "d", "1102/01B"),
            (4, 1, "CNPJ", "77", "d", "P1"),
        ],
        "ID_PARAM_DET long, ID_PARAMETRO long, NOME_PARAM string, CONTEUDO string, DESCRICAO string, VALOR string",
    )
    assert rows(D.cfop_map(details, heads, s).select("cod_cfo", "novo_cfo", "novo_natop")) == [("5101", "1101", "01A")]
    assert rows(D.override_map(details, heads, s).select("CNPJ", "cod_fis_jur")) == [("77", "P1")]
