"""Column expressions shared by the header, item and partner tables.

Everything here is a built-in expression, so it stays inside whole-stage code generation. Amounts are
decimals from the scan to the final digit string; no floating point is involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DOC = "NFe.infNFe"
"""Path of the document body."""

# The alternative tax groups of an item, in the order in which the origin is looked up.
ICMS_VARIANTS = (
    "ICMS00 ICMS10 ICMS30 ICMS40 ICMS51 ICMS60 ICMS70 ICMS90 ICMSPart ICMSST ICMSSN101 ICMSSN102 "
    "ICMSSN201 ICMSSN202 ICMSSN500 ICMSSN900"
).split()

# The tax groups that can carry substitution tax, in lookup order.
SUBSTITUTION_VARIANTS = "ICMS10 ICMS70 ICMS30 ICMS90 ICMSSN201 ICMSSN900".split()

MONEY = "decimal(18,2)"


def doc(path: str) -> Column:
    """Field of the document body, e.g. ``doc("ide.serie")``."""
    return F.col(f"{DOC}.{path}")


def strip_separators(c: Column) -> Column:
    return F.translate(c.cast("string"), ".,", "")


def raw_digits(c: Column, width: int) -> Column:
    """Digits of an amount as written, left-padded; no rescaling ("100.5" gives 1005)."""
    return F.lpad(strip_separators(c), width, "0")


def fixed_point(c: Column, decimals: int, width: int) -> Column:
    """Amount as digits with `decimals` implied places, half-even, left-padded to `width`."""
    scaled = F.bround(c, decimals).cast(f"decimal(38,{decimals})")
    return raw_digits(scaled, width)


def is_avulsa(cpf: Column, ie: Column) -> Column:
    """Note issued for a person: personal tax id together with a state registration."""
    return cpf.isNotNull() & ie.isNotNull()


def avulsa_amount(cpf: Column, ie: Column, amount: Column) -> Column:
    """Zero for a person's note, otherwise the amount with missing read as zero."""
    zero = F.lit(0).cast("decimal(1,0)")
    return F.when(is_avulsa(cpf, ie), zero).otherwise(F.coalesce(amount, zero))


def issuer_amount(amount: Column) -> Column:
    """`avulsa_amount` with the issuer of the current document."""
    return avulsa_amount(doc("emit.CPF"), doc("emit.IE"), amount)


def tax_key(cnpj: Column, cpf: Column | None = None) -> Column:
    """Tax id padded to 14 digits, the join key against the partner master."""
    return F.lpad(cnpj if cpf is None else F.coalesce(cnpj, cpf), 14, "0")


def partner_code(cnpj: Column, cpf: Column) -> Column:
    """Code of a partner unknown to the master data: M, first eight and last four digits."""
    tax_id = F.coalesce(cnpj, cpf)
    return F.concat(F.lit("M"), F.substring(tax_id, 1, 8), F.substring(tax_id, -4, 4))


def document_number(nnf: Column, nct: Column) -> Column:
    return F.lpad(F.coalesce(nnf, nct), 9, "0")


def header_class(nnf: Column, model: Column, freight_model: str) -> Column:
    return F.when(nnf.isNotNull(), "NFE").otherwise(freight_class(model, freight_model))


def freight_class(model: Column, freight_model: str) -> Column:
    return F.when(model == freight_model, "YD").otherwise("YJ")


def issue_date(ts: Column) -> Column:
    """yyyyMMdd of the date part; the zone offset must not move the day."""
    day = F.try_to_timestamp(F.substring(ts, 1, 10), F.lit("yyyy-MM-dd"))
    return F.date_format(day, "yyyyMMdd")


def key_number(access_key: Column) -> Column:
    """Document number inside an access key."""
    return F.substring(access_key, 26, 9)


def key_series(access_key: Column) -> Column:
    return F.substring(access_key, 23, 3)


def municipality(code: Column) -> Column:
    """Municipality without the two state digits."""
    return F.substring(code, 3, 5)


def or_sentinel(c: Column, sentinel: str) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def tax_origin(icms: Column) -> Column:
    """Origin digit of the tax group that is present."""
    return F.coalesce(*[icms[v]["orig"] for v in ICMS_VARIANTS], F.lit("0"))


def substitution(icms: Column, field: str) -> Column:
    return F.coalesce(*[icms[v][field] for v in SUBSTITUTION_VARIANTS])


def tax_base(item: Column) -> Column:
    """Goods value less discount plus every charge on the item; null without a goods value."""
    prod, taxes = item["prod"], item["imposto"]
    zero = F.lit(0).cast(MONEY)
    charges = [
        taxes["IPI"]["IPITrib"]["vIPI"],
        prod["vOutro"],
        prod["vFrete"],
        prod["vSeg"],
        substitution(taxes["ICMS"], "vICMSST"),
        substitution(taxes["ICMS"], "vFCPST"),
    ]
    net = prod["vProd"] - F.coalesce(prod["vDesc"], zero)
    return reduce(lambda total, c: total + F.coalesce(c, zero), charges, net).cast(MONEY)


def taxed(vicms: Column) -> Column:
    """True when a tax amount is present and positive; null counts as untaxed."""
    return F.coalesce(vicms > 0, F.lit(False))


def situation_code(vicms: Column) -> Column:
    return F.when(taxed(vicms), "90").otherwise("41")


def tribute_code(vicms: Column) -> Column:
    return F.when(taxed(vicms), "3").otherwise("2")


def padded_issuer_id(cnpj: Column, cpf: Column) -> Column:
    """Tax id at its own length: 14 for companies, 11 for persons."""
    return F.coalesce(F.lpad(cnpj, 14, "0"), F.lpad(cpf, 11, "0"))


def product_key(code: Column) -> Column:
    """Product code at its full eight digits; mapping files often lose a leading zero."""
    return F.when(F.length(code) < 8, F.lpad(code, 8, "0")).otherwise(code)
