"""Fiscal documents and master data derived from trade tables (orders, lineitem, customer, part, nation).

The trade tables stand in for a landing area: an order becomes a goods invoice or a freight document, its lines
become items, customers become issuers and nations become own establishments. The registered queries and the tests
read these frames; everything is a Spark plan over whole tables and grows with them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.functions.expr import ICMS_VARIANTS, MONEY, SUBSTITUTION_VARIANTS
from fiscalmill.operators.dims import MasterData
from fiscalmill.operators.lookup import HOT_ROWS, Lookup, left_lookup, salted
from fiscalmill.session import over_all_cores
from fiscalmill.settings import Settings
from fiscalmill.sources.schema import item_ddl

SETTINGS = Settings(
    split_cgc="33009911000007",
    split_drop_code="BR07",
    split_keep_code="BR99",
    removed_code="BR08",
    freight_product_key="0000002",
    other_freight_product_key="999999999",
)

COUNTER = 1000
MAX_ITEMS = 990
"""Most items that one invoice may carry."""


PRICE_ROWS = 2_000_000
"""The table of prices, two numbers a row, is broadcast up to this many rows: about 100 MB."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The rules of the sample are SQL text: one call to the parser for each instead of thousands of column calls.


def _fields(**values: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in values.items()) + ")"


def _digits(value: str, width: int) -> str:
    return f"lpad(cast({value} as string), {width}, '0')"


def _money(value: str) -> str:
    return f"cast({value} as {MONEY})"


def _state(nation: str) -> str:
    return f"concat('U', char(65 + {nation}))"


def _town(nation: str) -> str:
    return _digits(f"({nation}) * 37", 5)


def _cgc(nation: str) -> str:
    return f"concat(if(({nation}) % 5 = 4, '44009911', '33009911'), {_digits(nation, 6)})"


def _company(customer: str) -> str:
    """Company tax id of a customer: root, branch 0001, two check digits."""
    root, check = f"({customer} + 1) % 100000000", f"({customer} + 1) % 97"
    return f"concat({_digits(root, 8)}, '0001', {_digits(check, 2)})"


def _issuer(customer: str) -> str:
    return f"if({customer} % 7 = 0, {_digits(f'{customer} + 1', 11)}, {_company(customer)})"


def _access_key(key: str) -> str:
    series = f"({key}) % 3 + 1"
    return f"concat('3524', {_digits(key, 18)}, {_digits(series, 3)}, {_digits(key, 9)}, repeat('0', 10))"


def goods_only(key: Column) -> Column:
    """Keys that end in 0 or 5 are freight documents."""
    return key % 5 != 0


# Master data


def master_data(spark: SparkSession, folder: str, settings: Settings = SETTINGS) -> MasterData:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return MasterData(
        establishments=_establishments(nation, settings),
        states=nation.selectExpr("n_nationkey as IDENT_ESTADO", f"{_state('n_nationkey')} as COD_ESTADO"),
        partners=_partners(table(spark, folder, "customer")),
        heads=parameter_heads(region, settings),
        details=parameter_details(table(spark, folder, "part"), table(spark, folder, "customer"), settings),
        products=_product_versions(table(spark, folder, "part")),
        units=_units(table(spark, folder, "part")),
    )


def _establishments(nation: DataFrame, settings: Settings) -> DataFrame:
    n = "n_nationkey"
    own = f"concat(if({n} % 6 = 5, 'XX', 'BR'), {_digits(n, 2)})"
    return nation.selectExpr(
        f"{_digits('n_regionkey', 3)} as COD_EMPRESA",
        f"explode(if({n} = 7, array({own}, '{settings.split_keep_code}'), array({own}))) as COD_ESTAB",
        f"{_cgc(n)} as CGC",
        f"{_town(n)} as COD_MUNICIPIO",
        f"{n} as IDENT_ESTADO",
    )


def _partners(customer: DataFrame) -> DataFrame:
    """Two versions of most customers, and a row of its own for every second override code."""
    c, n = "c_custkey", "c_nationkey"

    def version(tax_id: str, code: str, kind: str, step: int, valid: str, state: str) -> str:
        return _fields(
            CPF_CGC=tax_id,
            COD_FIS_JUR=code,
            IND_FIS_JUR=kind,
            IDENT_FIS_JUR=f"{c} * 4 + {step}",
            VALID_FIS_JUR=valid,
            COD_MUNICIPIO=_town(state),
            IDENT_ESTADO=state,
        )

    code = f"concat('C', {c})"
    old = version(_issuer(c), code, "'3'", 1, f"if({c} % 17 = 0, null, date '2020-01-01')", n)
    new = version(_issuer(c), code, f"cast({c} % 2 + 1 as string)", 2, "date '2022-01-01'", n)
    other = version(
        f"lpad(cast({c} as string), 14, '9')", f"concat('P', {c})", "'2'", 3, "date '2021-06-01'", f"(({n} + 1) % 25)"
    )
    rows = f"array_compact(array(if({c} % 4 <> 0, {old}, null), if({c} % 4 <> 0, {new}, null), if({c} % 22 = 0, {other}, null)))"
    return customer.selectExpr(f"explode({rows}) as r").select("r.*")


def parameter_heads(region: DataFrame, settings: Settings) -> DataFrame:
    return region.selectExpr(
        "cast(r_regionkey + 1 as bigint) as ID_PARAMETROS",
        f"if(r_regionkey = 0, '{settings.param_framework}', concat('OTHER_', r_regionkey)) as NOME_FRAMEWORK",
    )


def product_mapping(part: DataFrame, settings: Settings) -> DataFrame:
    """Mapping rows of the products; some keys have lost their leading zero."""
    p = "p_partkey"
    return part.selectExpr(
        f"{p} as _p",
        f"'{settings.product_param}' as NOME_PARAM",
        f"if({p} % 20 = 1, {_digits(p, 7)}, {_digits(p, 8)}) as CONTEUDO",
        "p_name as DESCRICAO",
        f"cast({p} as string) as VALOR",
    )


def operation_mapping(part: DataFrame, settings: Settings) -> DataFrame:
    """Mapping rows of the operation codes, once per part that uses one."""
    n = "p_partkey % 40"
    return part.where(f"{n} <= 34").selectExpr(
        "p_partkey as _p",
        f"'{settings.cfop_param}' as NOME_PARAM",
        f"cast({n} + 5101 as string) as CONTEUDO",
        f"concat('CFOP ', {n} + 5101) as DESCRICAO",
        f"concat({n} + 1101, '/', {_digits(n, 3)}) as VALOR",
    )


def override_mapping(customer: DataFrame, settings: Settings) -> DataFrame:
    c = "c_custkey"
    return customer.where(f"{c} % 11 = 0 and {c} % 7 <> 0").selectExpr(
        f"{c} as _p",
        f"'{settings.override_param}' as NOME_PARAM",
        f"{_company(c)} as CONTEUDO",
        "c_name as DESCRICAO",
        f"concat('P', {c}) as VALOR",
    )


def parameter_details(part: DataFrame, customer: DataFrame, settings: Settings) -> DataFrame:
    """Parameter rows; products with a key that ends in 0 belong to a group the settings do not name."""
    mappings = (
        product_mapping(part, settings)
        .unionByName(operation_mapping(part, settings))
        .unionByName(override_mapping(customer, settings))
    )
    names = f"'{settings.product_param}', '{settings.cfop_param}'"
    return mappings.selectExpr(
        f"_p * 3 + coalesce(nullif(array_position(array({names}), NOME_PARAM), 0), 3) as ID_PARAM_DET",
        f"cast(if(NOME_PARAM = '{settings.product_param}' and _p % 10 = 0, 2, 1) as bigint) as ID_PARAMETRO",
        "NOME_PARAM",
        "CONTEUDO",
        "DESCRICAO",
        "VALOR",
    )


UNIT_ID = "cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int)"


def _product_versions(part: DataFrame) -> DataFrame:
    """Two versions per product, a tie for some, none for others."""

    def version(day: str, unit: str) -> str:
        return _fields(VALID_PRODUTO=f"date '{day}'", IDENT_UND_PADRAO=unit)

    old, new = version("2020-01-01", f"({UNIT_ID} + 3) % 25"), version("2021-01-01", UNIT_ID)
    tie = f"if(p_partkey % 50 = 1, {version('2021-01-01', f'{UNIT_ID} % 25 + 1')}, null)"
    return (
        part.where("p_partkey % 30 <> 7")
        .selectExpr(
            "cast(p_partkey as string) as COD_PRODUTO", f"explode(array_compact(array({old}, {new}, {tie}))) as v"
        )
        .select("COD_PRODUTO", "v.*")
    )


def _units(part: DataFrame) -> DataFrame:
    return part.selectExpr(f"{UNIT_ID} as IDENT_UND_PADRAO", "p_brand as COD_UND_PADRAO").distinct()


def operation_codes(part: DataFrame) -> DataFrame:
    code = "p_partkey % 40 + 5101"
    return part.selectExpr(f"{code} as COD_CFO", f"concat('CFOP ', {code}) as DESCRICAO")


def product_codes(part: DataFrame) -> DataFrame:
    return part.selectExpr(f"{_digits('p_partkey', 8)} as COD_NBM", "p_name as DESCRICAO")


# Items


def _icms(tax: str) -> str:
    """The one tax group of an item, chosen by its line number."""
    groups = {"ICMS00": 1, "ICMS10": 2, "ICMS40": 3, "ICMSSN102": 4, "ICMS90": 5, "ICMSSN900": 6, "ICMS60": 7}
    substitution = {"ICMS10": ("2.00", "null"), "ICMS90": ("3.00", "0.50"), "ICMSSN900": ("4.00", "null")}

    def group(name: str) -> str:
        fields = {"orig": "cast(l_suppkey % 3 as string)"}
        if name == "ICMS00":
            fields["vICMS"] = tax
        if name in SUBSTITUTION_VARIANTS:
            st, fcp = substitution.get(name, ("null", "null"))
            fields |= {"vICMSST": _money(st), "vFCPST": _money(fcp)}
        return f"if(l_linenumber = {groups.get(name, 0)}, {_fields(**fields)}, null)"

    return _fields(**{v: group(v) for v in ICMS_VARIANTS})


LINE = ["l_linenumber", "l_partkey", "l_suppkey", "_quantity", "_value", "_discount", "_tax", "_price"]
"""What an item is made of. Only these columns are moved between tasks; items are made where their document is."""


def item_sql() -> str:
    """Item of one line (`LINE` columns), typed as the document schema has it."""

    def share(rate: str) -> str:
        return f"nullif({_money(f'round(_value * {rate}, 2)')}, 0)"

    prod = _fields(
        CFOP="cast(l_partkey % 40 + 5101 as string)",
        NCM=_digits("l_partkey", 8),
        uCom="'UN'",
        qCom="_quantity",
        vUnCom="cast(_price as decimal(21,10))",
        vProd="_value",
        vDesc=share("_discount"),
        vOutro=f"if(l_linenumber = 7, {_money('0.25')}, null)",
        vFrete=f"if(l_suppkey % 2 = 0, {_money('1.00')}, null)",
        vSeg=f"if(l_partkey % 13 = 0, {_money('0.10')}, null)",
    )
    tax = share("_tax")
    ipi = f"if({tax} is null, null, {_fields(IPITrib=_fields(vIPI=tax))})"
    return _fields(_nItem="cast(l_linenumber as string)", prod=prod, imposto=_fields(IPI=ipi, ICMS=_icms(tax)))


def items_sql(lines: str) -> str:
    """Items of an array of lines."""
    of_line = re.sub(rf"\b({'|'.join(LINE)})\b", r"l.\1", item_sql())
    return f"transform({lines}, l -> {of_line})"


def goods_lines(spark: SparkSession, folder: str, price_rows: int | None = None) -> DataFrame:
    """Every line of a goods invoice: doc_key and the columns of `LINE`. Prices are broadcast up to `price_rows`."""
    lines = over_all_cores(table(spark, folder, "lineitem")).where(goods_only(F.col("l_orderkey")))
    own = lines.selectExpr(
        "l_orderkey as doc_key",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "cast(l_quantity as decimal(18,6)) as _quantity",
        f"{_money('l_extendedprice')} as _value",
        "cast(l_discount as decimal(4,2)) as _discount",
        "cast(l_tax as decimal(4,2)) as _tax",
    )
    prices = table(spark, folder, "part").selectExpr("p_partkey", f"{_money('p_retailprice')} as price")
    spread = ["doc_key", "l_linenumber", "l_suppkey", "_value"]
    return left_lookup(own, Lookup(prices, broadcast_rows=PRICE_ROWS if price_rows is None else price_rows), {"p_partkey": F.col("l_partkey")}, {"_price": "price"}, spread)


# Documents


def _body() -> str:
    """Document body of one order row that carries its customer's columns and its items."""
    k, n, total = "o_orderkey", "c_nationkey", _money("o_totalprice")
    goods, payer = f"({k} % 5 <> 0)", f"({k} div 10 % 6)"
    no_recipient = f"({k} % 9 = 0)"
    person = "(o_custkey % 7 = 0)"
    four = "'4'"
    start, end = f"(not {goods} and {k} % 3 <> 1)", f"(not {goods} and {k} % 3 <> 2)"
    discount = f"if({k} % 4 = 2, {_money(f'round({total} * 0.01, 2)')}, null)"

    def party(shift: int, when: str) -> str:
        return f"if({when}, {_fields(CNPJ=_cgc(f'({k} + {shift}) % 25'))}, null)"

    ide = _fields(
        nNF=f"if({goods}, cast({k} as string), null)",
        nCT=f"if({goods}, null, cast({k} as string))",
        serie=f"cast({k} % 3 + 1 as string)",
        mod=f"case when {goods} then '55' when {k} % 10 = 0 then '57' else '67' end",
        dhEmi="concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T23:30:00-03:00')",
        CFOP=f"if({goods}, null, cast({k} % 40 + 5101 as string))",
        UFIni=f"if({start}, {_state(f'({k} + 1) % 25')}, null)",
        UFFim=f"if({end}, {_state(f'{k} % 25')}, null)",
        cMunIni=f"if({start}, concat('35', {_town(f'({k} + 1) % 25')}), null)",
        cMunFim=f"if({end}, concat('35', {_town(f'{k} % 25')}), null)",
        NFref=f"if({k} % 4 = 1, array("
        + _fields(refNFe=_access_key(f"{k} - 1"), refNF=_fields(serie=f"cast({k} % 3 + 1 as string)"))
        + "), null)",
        toma3=f"if(not {goods} and {payer} < 4, {_fields(toma=f'cast({payer} as string)')}, null)",
        toma4=f"if(not {goods} and {payer} = 4, {_fields(toma=four, CNPJ=_cgc(f'({k} + 2) % 25'))}, null)",
    )
    address = _fields(
        xLgr="concat('Rua cte ', c_mktsegment, ' ', c_name)",
        nro="cast(o_custkey as string)",
        xBairro=f"concat('Bairro ', {n}, ' ', c_mktsegment)",
        xMun=f"concat('Town ', {n})",
        cMun=f"concat('35', {_town(n)})",
        UF=_state(n),
        CEP=_digits(f"{n} * 1000", 8),
        cPais="if(o_custkey % 5 <> 0, '1058', null)",
    )
    issuer = _fields(
        CNPJ=f"if({person}, null, {_company('o_custkey')})",
        CPF=f"if({person}, {_digits('o_custkey + 1', 11)}, null)",
        IE=f"if(not {person} or o_custkey % 14 = 0, {_digits('o_custkey + 1', 9)}, null)",
        xNome="c_name",
        enderEmit=address,
    )
    totals = _fields(vProd=total, vNF=f"{_money(f'{total} - coalesce({discount}, 0)')}", vDesc=discount)
    service_tax = f"if({k} % 3 = 0, {_fields(vICMS=_money('1'))}, null)"
    return _fields(
        ide=ide,
        emit=issuer,
        dest=party(0, f"not {goods} or not {no_recipient}"),
        rem=party(1, f"not {goods}"),
        exped=party(3, f"not {goods}"),
        receb=party(4, f"not {goods}"),
        toma=party(2, f"if({goods}, {no_recipient}, {payer} = 5)"),
        vPrest=f"if({goods}, null, {_fields(vTPrest=f'cast({total} as string)')})",
        imp=f"if({goods}, null, {_fields(ICMS=_fields(ICMS00=service_tax))})",
        total=f"if({goods}, {_fields(ICMSTot=totals)}, null)",
        det="_items",
    )


def _nested(issued: DataFrame, more: list[str] | None = None) -> DataFrame:
    """Orders of `_issued` with _items as documents, with further columns."""
    proof = _fields(infProt=_fields(chNFe=_access_key("o_orderkey")))
    body = _fields(infNFe=_body())
    return issued.selectExpr("doc_key", "filename", f"{proof} as protNFe", f"{body} as NFe", *(more or []))


def _issued(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with what documents take of them and of their customer."""
    k = F.col("o_orderkey")
    own = over_all_cores(table(spark, folder, "orders")).select(
        k.alias("doc_key"), k, "o_custkey", "o_orderdate", "o_totalprice"
    )
    names = ["c_name", "c_nationkey", "c_mktsegment"]
    customer = Lookup(table(spark, folder, "customer"))
    return left_lookup(own, customer, {"c_custkey": F.col("o_custkey")}, {n: n for n in names}, ["o_orderkey"])


FILENAME = "concat('file:///landing/doc-', cast(o_orderkey as string), '.xml') as filename"


def _bare(issued: DataFrame) -> DataFrame:
    return issued.selectExpr("*", FILENAME, f"cast(null as array<{item_ddl()}>) as _items")


def heads(spark: SparkSession, folder: str) -> DataFrame:
    """One document an order, without its items: for what never reads them."""
    return _nested(_bare(_issued(spark, folder)))


def _packed_lines(spark: SparkSession, folder: str, hot_rows: int, price_rows: int | None = None) -> DataFrame:
    """Lines of each document in order (doc_key, _lines), at most `MAX_ITEMS` in a row."""
    rows = table(spark, folder, "lineitem").count()
    # Keys are counted over the table itself: the lines have looked up their prices.
    counted = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("doc_key")).where(goods_only(F.col("doc_key")))
    lines, hot = salted(goods_lines(spark, folder, price_rows), ["doc_key"], LINE, hot_rows, rows, counted)
    order = [F.col("l_linenumber").cast("string"), F.expr(_digits("l_partkey", 8)), F.xxhash64(*LINE)]
    split = [] if hot is None else ["_salt"]
    placed = lines.withColumn("_place", F.row_number().over(Window.partitionBy("doc_key", *split).orderBy(*order)))
    if hot is not None:
        sizes = lines.where("_salt > 0").select("doc_key").distinct()
        counts = lines.join(sizes, "doc_key", "left_semi").groupBy("doc_key", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy("doc_key").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select("doc_key", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        placed = placed.join(before, ["doc_key", "_salt"], "left")
        placed = placed.withColumn("_place", F.col("_place") + F.coalesce("_before", F.lit(0)))
    numbered = placed.withColumn("_chunk", F.floor((F.col("_place") - 1) / MAX_ITEMS))
    together = F.array_sort(F.collect_list(F.struct("_place", *LINE))).alias("_lines")
    return numbered.groupBy("doc_key", "_chunk").agg(together).drop("_chunk")


def full_documents(
    spark: SparkSession,
    folder: str,
    hot_rows: int = HOT_ROWS,
    found: Callable[[DataFrame], DataFrame] | None = None,
    price_rows: int | None = None,
) -> DataFrame:
    """Documents with all their items, at most `MAX_ITEMS` each: a longer order gives several documents.

    An order of n lines gives greatest(1, ceil(n / MAX_ITEMS)) documents, whether its lines are salted or not: a line's
    place counts the lines of the salts before its own. Lines and orders are joined as the narrow rows they are, and
    become documents afterwards. `found` adds columns to documents without their items, before these join them.
    """
    issued, more = _issued(spark, folder), []
    if found is not None:
        without = found(_nested(_bare(issued), [c for c in issued.columns if c != "doc_key"]))
        more = [c for c in without.columns if c not in (*issued.columns, "filename", "protNFe", "NFe")]
        issued = without.select(*issued.columns, *more)
    both = issued.join(_packed_lines(spark, folder, hot_rows, price_rows), "doc_key", "full_outer")
    return _nested(both.selectExpr("*", FILENAME, f"{items_sql('_lines')} as _items"), more)


def xml_texts(docs: DataFrame) -> DataFrame:
    """Documents as XML text without indentation, freight documents in their own vocabulary, some with a byte order mark."""
    text = F.rtrim(F.to_xml(F.struct("protNFe", "NFe"), {"rowTag": "nfeProc", "indent": ""}), F.lit("\n"))
    k = F.col("doc_key")

    def freight(root: str, body: str) -> Column:
        out = text
        names = {"nfeProc": root, "NFe": body, "infNFe": "infCte", "protNFe": "protCTe", "chNFe": "chCTe"}
        for goods_name, name in names.items():
            out = F.regexp_replace(out, rf"(</?){goods_name}(?=[\s/>])", f"$1{name}")
        return out

    family = F.when(k % 10 == 0, freight("cteProc", "CTe")).when(k % 10 == 5, freight("cteOSProc", "CTeOS"))
    mark = F.when(k % 50 == 0, "\ufeff").otherwise("")
    return docs.select("doc_key", "filename", F.concat(mark, family.otherwise(text)).alias("text"))


def bad_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that hold no document, and texts that are cut off."""
    k = F.col("o_orderkey")
    kinds = F.array_compact(
        F.array(
            F.when(k % 97 == 0, F.struct(F.lit("other").alias("kind"), F.lit("<nfeProc><other/></nfeProc>").alias("text"))),
            F.when(k % 193 == 0, F.struct(F.lit("cut").alias("kind"), F.lit("<nfeProc><NFe><infNFe><ide>").alias("text"))),
        )
    )
    rows = table(spark, folder, "orders").select(k.alias("doc_key"), F.explode(kinds).alias("b"))
    name = F.concat(F.lit("file:///landing/bad-"), F.col("doc_key").cast("string"), F.lit("-"), F.col("b.kind"), F.lit(".xml"))
    return rows.select("doc_key", name.alias("filename"), F.col("b.text").alias("text"))


def is_newer(key: Column) -> Column:
    """Goods invoices that come in a newer layout."""
    return goods_only(key) & (key % 13 == 0)


def newer_texts(texts: DataFrame) -> DataFrame:
    """Texts in which the invoices of the newer layout have one more group, and a total with a currency sign and a decimal comma."""
    newer = F.regexp_replace("text", r"<vNF>(\d+)\.(\d+)</vNF>", r"<vNF>R\$ $1,$2</vNF>")
    note = F.concat(F.lit("<infAdic><note>note "), F.col("doc_key").cast("string"), F.lit("</note></infAdic></infNFe>"))
    newer = F.replace(newer, F.lit("</infNFe>"), note)
    return texts.withColumn("text", F.when(is_newer(F.col("doc_key")), newer).otherwise(F.col("text")))


def encoded_lines(texts: DataFrame) -> DataFrame:
    """Lines with accents: a third in declared ISO-8859-1, a third in declared UTF-8, a third in UTF-8 with a broken byte."""
    prolog = lambda name: F.lit(f'<?xml version="1.0" encoding="{name}"?>')
    plain = F.replace(F.replace(F.col("text"), F.lit("\ufeff"), F.lit("")), F.lit("Rua cte"), F.lit("Rua São cte"))
    accented = lambda name: F.concat(prolog(name), plain)
    latin = F.encode(accented("iso-8859-1"), "ISO-8859-1")
    broken = F.unhex(F.replace(F.hex(accented("UTF-8")), F.hex(F.lit("São")), F.lit("53E36F")))
    k = F.col("doc_key") % 3
    raw = F.when(k == 0, latin).when(k == 1, F.encode(accented("UTF-8"), "UTF-8")).otherwise(broken)
    return texts.select(raw.cast("string").alias("value"))
