"""SQL over the trade tables that each registered query is compared with.

Written from the rules of the sample documents, without using the library.
"""

from __future__ import annotations

from fiscalmill.sources.sample import MAX_ITEMS


def fp(value: str, decimals: int, width: int) -> str:
    return f"lpad(replace(cast(cast({value} as decimal(38,{decimals})) as varchar), '.', ''), {width}, '0')"


def pad(value: str, width: int) -> str:
    return f"lpad(cast({value} as varchar), {width}, '0')"


def state(n: str) -> str:
    return f"'U' || chr(cast(65 + {n} as int))"


def town(n: str) -> str:
    return pad(f"({n}) * 37", 5)


def cgc(n: str) -> str:
    return f"(case when ({n}) % 5 = 4 then '44009911' else '33009911' end || {pad(n, 6)})"


def company(c: str) -> str:
    return f"({pad(f'({c} + 1) % 100000000', 8)} || '0001' || {pad(f'({c} + 1) % 97', 2)})"


def access_key(k: str) -> str:
    return f"('3524' || {pad(k, 18)} || {pad(f'1 + ({k}) % 3', 3)} || {pad(k, 9)} || '0000000000')"


def derived(cnpj: str, cpf: str) -> str:
    tax_id = f"coalesce({cnpj}, {cpf})"
    return f"'M' || substr({tax_id}, 1, 8) || right({tax_id}, 4)"


DOC = f"""
doc0 as (
  select o_orderkey as k, o_custkey as c, c_nationkey as n, c_name, c_mktsegment,
    o_orderkey % 5 <> 0 as goods, (o_orderkey // 10) % 6 as payer,
    o_orderkey % 5 <> 0 and o_orderkey % 9 = 0 as no_recipient,
    cast(o_totalprice as decimal(18,2)) as total, o_orderdate
  from orders left join customer on o_custkey = c_custkey
),
doc1 as (
  select *,
    case when goods then cast(k as varchar) end as nnf,
    case when not goods then cast(k as varchar) end as nct,
    case when goods then '55' when k % 10 = 0 then '57' else '67' end as model,
    cast(1 + k % 3 as varchar) as serie,
    case when not goods and payer < 4 then cast(payer as varchar) end as toma3,
    case when not goods and payer = 4 then '4' end as toma4,
    case when not goods or not no_recipient then {cgc('k % 25')} end as dest,
    case when not goods then {cgc('(k + 1) % 25')} end as rem,
    case when not goods then {cgc('(k + 3) % 25')} end as exped,
    case when not goods then {cgc('(k + 4) % 25')} end as receb,
    case when (not goods and payer in (4, 5)) or no_recipient then {cgc('(k + 2) % 25')} end as toma,
    case when c % 7 <> 0 then {company('c')} end as cnpj,
    case when c % 7 = 0 then {pad('c + 1', 11)} end as cpf,
    case when c % 7 <> 0 or c % 14 = 0 then {pad('c + 1', 9)} end as ie,
    {access_key('k')} as chave,
    case when k % 4 = 1 then {access_key('k - 1')} end as refkey,
    case when not goods and k % 3 <> 1 then {state('(k + 1) % 25')} end as uf_ini,
    case when not goods and k % 3 <> 2 then {state('k % 25')} end as uf_fim,
    case when not goods and k % 3 <> 1 then {town('(k + 1) % 25')} end as mun_ini,
    case when not goods and k % 3 <> 2 then {town('k % 25')} end as mun_fim,
    case when not goods then cast(total as varchar) end as vtprest,
    case when k % 4 = 2 then round(total * cast(0.01 as decimal(4,2)), 2) end as vdesc,
    strftime(o_orderdate, '%Y%m%d') as emissao
  from doc0
),
first_line as (
  select l_orderkey as fk, min(l_linenumber * 1000000000000 + l_partkey) % 1000000000000 as fp
  from lineitem where l_orderkey % 5 <> 0 group by l_orderkey
),
doc as (
  select doc1.*, cpf is not null and ie is not null as avulsa,
    cast(5101 + (case when goods then fp else k end) % 40 as varchar) as cfop
  from doc1 left join first_line on fk = k
)"""

ESTAB = f"""
estab0 as (
  select {pad('n_regionkey', 3)} as COD_EMPRESA,
    case when n_nationkey % 6 = 5 then 'XX' else 'BR' end || {pad('n_nationkey', 2)} as COD_ESTAB,
    {cgc('n_nationkey')} as CGC, {town('n_nationkey')} as COD_MUNICIPIO, n_nationkey as IDENT_ESTADO,
    {state('n_nationkey')} as UF
  from nation
),
estab1 as (
  select * from estab0
  union all select COD_EMPRESA, 'BR99', CGC, COD_MUNICIPIO, IDENT_ESTADO, UF from estab0 where IDENT_ESTADO = 7
),
estab as (
  select * from estab1
  where ((CGC <> '33009911000007' and COD_ESTAB <> 'BR07') or (CGC = '33009911000007' and COD_ESTAB = 'BR99'))
    and COD_ESTAB <> 'BR08'
),
own as (select * from estab where COD_ESTAB like 'BR%')"""

ROLE = """
role as (
  select doc.*, coalesce(a.COD_EMPRESA, b.COD_EMPRESA, r.COD_EMPRESA, e.COD_EMPRESA, f.COD_EMPRESA) as emp,
    coalesce(a.COD_ESTAB, b.COD_ESTAB, r.COD_ESTAB, e.COD_ESTAB, f.COD_ESTAB) as est,
    a.UF as dest_uf, a.COD_MUNICIPIO as dest_mun
  from doc
  left join own a on a.CGC = dest and (toma3 = '3' or model = '55')
  left join own b on b.CGC = toma
    and ((toma4 = '4' and b.CGC like '33009911%') or (toma3 is null and toma4 is null))
  left join own r on r.CGC = rem and toma3 = '0'
  left join own e on e.CGC = exped and toma3 = '1'
  left join own f on f.CGC = receb and toma3 = '2'
)"""

PARTNER = f"""
partner0 as (
  select case when c_custkey % 7 = 0 then {pad('c_custkey + 1', 11)} else {company('c_custkey')} end as CPF_CGC,
    'C' || c_custkey as COD_FIS_JUR, '3' as IND_FIS_JUR, c_custkey * 4 + 1 as IDENT_FIS_JUR,
    case when c_custkey % 17 <> 0 then date '2020-01-01' end as VALID, c_nationkey as st
  from customer where c_custkey % 4 <> 0
  union all
  select case when c_custkey % 7 = 0 then {pad('c_custkey + 1', 11)} else {company('c_custkey')} end,
    'C' || c_custkey, cast(1 + c_custkey % 2 as varchar), c_custkey * 4 + 2, date '2022-01-01', c_nationkey
  from customer where c_custkey % 4 <> 0
  union all
  select lpad(cast(c_custkey as varchar), 14, '9'), 'P' || c_custkey, '2', c_custkey * 4 + 3, date '2021-06-01',
    (c_nationkey + 1) % 25
  from customer where c_custkey % 22 = 0
),
partner as (
  select *, {town('st')} as COD_MUNICIPIO, {state('st')} as UF from partner0
),
x04 as (
  select * from partner qualify rank() over (
    partition by CPF_CGC order by VALID desc nulls first, IND_FIS_JUR nulls last, IDENT_FIS_JUR desc nulls first) = 1
),
xcode as (
  select * from partner qualify rank() over (
    partition by COD_FIS_JUR order by VALID desc nulls first, IND_FIS_JUR nulls last, IDENT_FIS_JUR desc nulls first) = 1
)"""

MAPS = f"""
cfopmap as (
  select distinct 'CFOP NatOp' as nome_param, cast(code as varchar) as cod_cfo, 'CFOP ' || code as descricao,
    cast(code - 4000 as varchar) as novo_cfo, {pad('code - 5101', 3)} as novo_natop
  from (select 5101 + p_partkey % 40 as code from part) where code <= 5135
),
overmap as (
  select distinct 'CNPJ' as nome_param, {company('c_custkey')} as CNPJ, 'P' || c_custkey as cod_fis_jur
  from customer where c_custkey % 11 = 0 and c_custkey % 7 <> 0
),
brand as (
  select p_partkey, p_name, cast(replace(p_brand, 'Brand#', '') as int) as unit, p_brand from part
),
version as (
  select p_partkey, unit as u from brand where p_partkey % 30 <> 7
  union all
  select p_partkey, unit % 25 + 1 from brand where p_partkey % 50 = 1 and p_partkey % 30 <> 7
),
units as (select distinct unit, p_brand from brand),
prodmap as (
  select distinct 'Produto' as nome_param,
    case when b.p_partkey % 20 = 1 then {pad('b.p_partkey', 7)} else {pad('b.p_partkey', 8)} end as cod_ncm,
    b.p_name as descricao, cast(b.p_partkey as varchar) as material, units.p_brand as cod_und_padrao,
    {pad('b.p_partkey', 8)} as ncm
  from brand b left join version v on v.p_partkey = b.p_partkey left join units on units.unit = v.u
  where b.p_partkey % 10 <> 0
)"""

LINE = """
line0 as (
  select l_orderkey as k, l_linenumber as ln, l_partkey as p, l_suppkey as s, l_quantity,
    cast(p_retailprice as decimal(18,2)) as unit_price, cast(l_extendedprice as decimal(18,2)) as vprod,
    nullif(round(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)), 2), 0) as vdesc,
    nullif(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2), 0) as vipi
  from lineitem left join part on l_partkey = p_partkey where l_orderkey % 5 <> 0
),
line as (
  select *, vprod - coalesce(vdesc, 0) + coalesce(vipi, 0)
      + case when ln = 7 then 0.25 else 0 end + case when s % 2 = 0 then 1 else 0 end
      + case when p % 13 = 0 then 0.10 else 0 end
      + case ln when 2 then 2 when 5 then 3.50 when 6 then 4 else 0 end as base,
    case when ln between 1 and 7 then cast(s % 3 as varchar) else '0' end as origin,
    coalesce(ln = 1 and vipi > 0, false) as taxed
  from line0
)"""

ISSUER = f"""
issuer as (
  select role.*, overmap.cod_fis_jur as over_code, x04.IND_FIS_JUR as x_kind, x04.UF as x_uf,
    x04.COD_MUNICIPIO as x_mun,
    coalesce(overmap.cod_fis_jur, x04.COD_FIS_JUR, {derived('role.cnpj', 'role.cpf')}) as code,
    coalesce(xcode.IND_FIS_JUR, x04.IND_FIS_JUR, '1') as kind
  from role
  left join overmap on overmap.CNPJ = role.cnpj
  left join x04 on lpad(coalesce(role.cnpj, role.cpf), 14, '0') = lpad(x04.CPF_CGC, 14, '0')
  left join xcode on xcode.COD_FIS_JUR = overmap.cod_fis_jur
)"""

_RAW = "replace(vtprest, '.', '')"

ITEM = f"""
item0 as (
  select d.k as k, emp as COD_EMPRESA, est as COD_ESTAB, 'NFE' as COD_DOCTO, kind as IND_FIS_JUR,
    code as COD_FIS_JUR, lpad(nnf, 9, '0') as NUM_DOCFIS, serie as SERIE_DOCFIS,
    coalesce(m.material, 'NP') as COD_PRODUTO, cast(ln as varchar) as NUM_ITEM, coalesce(f.novo_cfo, 'NP') as COD_CFO,
    substr(refkey, 26, 9) as NUM_DOCFIS_REF, substr(refkey, 23, 3) as SERIE_DOCFIS_REF,
    coalesce(f.novo_natop, 'NP') as COD_NATUREZA_OP, {fp('l_quantity', 6, 17)} as QUANTIDADE,
    coalesce(m.cod_und_padrao, 'NP') as COD_MEDIDA, {pad('p', 8)} as COD_NBM,
    {fp('case when avulsa then 0 else coalesce(unit_price, 0) end', 4, 19)} as VLR_UNIT,
    {fp('case when avulsa then 0 else vprod end', 2, 17)} as VLR_ITEM, origin as COD_SITUACAO_A,
    case when taxed then '90' else '41' end as COD_SITUACAO_B, '00003' as COD_FEDERAL,
    case when taxed then '3' else '2' end as TRIB_ICMS,
    {fp('case when avulsa then 0 else base end', 2, 17)} as BASE_ICMS,
    {fp('case when avulsa then 0 else coalesce(line.vdesc, 0) end', 2, 17)} as VLR_DESCONTO, '03' as COD_TRIB_IPI,
    cast(case when avulsa then 0 else base end as decimal(18,2)) as base_amount
  from line join issuer d on d.k = line.k
  left join cfopmap f on f.cod_cfo = cast(5101 + p % 40 as varchar)
  left join prodmap m on m.ncm = {pad('p', 8)}
  union all
  select d.k, emp, est, case when model = '57' then 'YD' else 'YJ' end, coalesce(x_kind, '1'), code,
    lpad(nct, 9, '0'), serie, coalesce(m.material, 'NP'), '1', coalesce(f.novo_cfo, 'NP'), '', '',
    coalesce(f.novo_natop, 'NP'), '1000000', coalesce(m.cod_und_padrao, 'NP'), m.cod_ncm,
    lpad({_RAW}, 19, '0'), lpad({_RAW}, 17, '0'), '0', case when d.k % 3 = 0 then '90' else '41' end, '00049',
    case when d.k % 3 = 0 then '3' else '2' end, lpad({_RAW}, 17, '0'), '@', '@', total
  from issuer d
  left join cfopmap f on f.cod_cfo = d.cfop
  left join prodmap m on m.ncm = case when model = '57' then '00000002' else '999999999' end
  where not goods
),
item as (
  select *, '20240131' as DATA_FISCAL, '1' as MOVTO_E_S, '1' as NORM_DEV, '8' as IND_PRODUTO, '3' as TRIB_IPI,
    BASE_ICMS as BASE_IPI, BASE_ICMS as VLR_CONTAB_ITEM, '70' as COD_SITUACAO_PIS, '70' as COD_SITUACAO_COFINS,
    '20240131' as DAT_LANC_PIS_COFINS, 'N' as IND_BEM_PATR, COD_MEDIDA as COD_UND_PADRAO
  from item0
)"""

_SUM = """cast(sum(base_amount) as decimal(28,2)) as BASE_IPI,
    cast(sum(case when TRIB_ICMS = '3' then base_amount else 0 end) as decimal(28,2)) as BASE_OUTR_ICMS,
    cast(sum(case when TRIB_ICMS = '2' then base_amount else 0 end) as decimal(28,2)) as BASE_ISEN_ICMS"""

SUMS = f"""
sums as (
  select COD_EMPRESA, COD_ESTAB, NUM_DOCFIS, COD_FIS_JUR, IND_FIS_JUR as IDENT_FIS_JUR, {_SUM}
  from item group by all
)"""


def _sum_digits(name: str) -> str:
    return fp(f"case when d.avulsa then 0 else coalesce({name}, 0) end", 2, 17) + f" as {name.replace('BASE_IPI', 'BASE_OUTR_IPI').split('.')[-1]}"


HEADER = f"""
header as (
  select d.k as doc_key, s.COD_EMPRESA, s.COD_ESTAB, '1' as MOVTO_E_S, '1' as NORM_DEV,
    case when nnf is not null then 'NFE' when model = '57' then 'YD' else 'YJ' end as COD_DOCTO,
    s.IDENT_FIS_JUR, s.COD_FIS_JUR, lpad(coalesce(nnf, nct), 9, '0') as NUM_DOCFIS, serie as SERIE_DOCFIS,
    emissao as DATA_EMISSAO, '1' as COD_CLASS_DOC_FIS, model as COD_MODELO, coalesce(f.novo_cfo, 'NP') as COD_CFO,
    substr(refkey, 26, 9) as NUM_DOCFIS_REF, substr(refkey, 23, 3) as SERIE_DOCFIS_REF,
    '20240131' as DATA_SAIDA_REC,
    case when goods then {fp('case when avulsa then 0 else total end', 2, 17)} else lpad({_RAW}, 17, '0') end
      as VLR_PRODUTO,
    case when goods then {fp('case when avulsa then 0 else total - coalesce(vdesc, 0) end', 2, 17)}
      else lpad({_RAW}, 17, '0') end as VLR_TOT_NOTA,
    'N' as SITUACAO, 1000 + row_number() over (order by d.k) as NUM_CONTROLE_DOCTO, '3' as IND_FATURA,
    chave as NUM_AUTENTIC_NFE, '20240131' as DAT_LANC_PIS_COFINS,
    {_sum_digits('s.BASE_ISEN_ICMS')}, {_sum_digits('s.BASE_OUTR_ICMS')},
    {fp('case when d.avulsa then 0 else coalesce(s.BASE_IPI, 0) end', 2, 17)} as BASE_OUTR_IPI,
    model as COD_MODELO_COTEPE, case when avulsa then 'S' end as IND_NF_REG_ESPECIAL,
    {fp('case when avulsa or not goods then 0 else coalesce(vdesc, 0) end', 2, 17)} as VLR_DESCONTO,
    case when goods then lpad(replace(cast(vdesc as varchar), '.', ''), 17, '0') end as VLR_ABAT_NTRIBUTADO,
    '2' as IND_TP_FRETE, coalesce(uf_ini, xc.UF, x_uf) as UF_ORIG_DEST, coalesce(uf_fim, dest_uf) as UF_DESTINO,
    coalesce(mun_ini, xc.COD_MUNICIPIO, x_mun) as COD_MUNICIPIO_ORIG,
    coalesce(mun_fim, dest_mun) as COD_MUNICIPIO_DEST, coalesce(f.novo_natop, 'NP') as COD_NATUREZA_OP
  from issuer d
  left join cfopmap f on f.cod_cfo = d.cfop
  left join sums s on s.COD_EMPRESA = emp and s.COD_ESTAB = est
    and s.NUM_DOCFIS = lpad(coalesce(nnf, nct), 9, '0') and s.COD_FIS_JUR = d.code
  left join xcode xc on xc.COD_FIS_JUR = s.COD_FIS_JUR
)"""

NEW = f"""
newp as (
  select distinct '1' as IND_FIS_JUR, {derived('cnpj', 'cpf')} as COD_FIS_JUR, emissao as DATA_X04,
    '1' as IND_CONTEM_COD, c_name as RAZAO_SOCIAL, coalesce(cnpj, cpf) as CPF_CGC, ie as INSC_ESTADUAL,
    substr(c_name, 1, 50) as NOME_FANTASIA, substr('Rua cte ' || c_mktsegment || ' ' || c_name, 1, 50) as ENDERECO,
    substr(cast(c as varchar), 1, 10) as NUM_ENDERECO, substr('Bairro ' || n || ' ' || c_mktsegment, 1, 20) as BAIRRO,
    'Town ' || n as CIDADE, {state('n')} as UF, {pad('n * 1000', 8)} as CEP, '105' as COD_PAIS,
    {town('n')} as COD_MUNICIPIO
  from doc where not exists (
    select 1 from x04 where lpad(x04.CPF_CGC, 14, '0') = lpad(coalesce(doc.cnpj, doc.cpf), 14, '0'))
)"""

FIRST = f"""
every_version as (
  select p_partkey, (unit + 3) % 25 as u from brand where p_partkey % 30 <> 7
  union all select p_partkey, unit from brand where p_partkey % 30 <> 7
  union all select p_partkey, unit % 25 + 1 from brand where p_partkey % 50 = 1 and p_partkey % 30 <> 7
),
fprod as (
  select distinct case when b.p_partkey % 20 = 1 then {pad('b.p_partkey', 7)} else {pad('b.p_partkey', 8)} end as cod_ncm,
    cast(b.p_partkey as varchar) as material, units.p_brand as unit_code
  from brand b left join every_version v on v.p_partkey = b.p_partkey left join units on units.unit = v.u
  where b.p_partkey % 10 <> 0
),
fdoc as (
  select doc.*, own.COD_EMPRESA as emp, own.COD_ESTAB as est, coalesce(x04.IND_FIS_JUR, '1') as kind,
    coalesce(x04.COD_FIS_JUR, 'M' || substr(coalesce(cnpj, cpf), 1, 3) || right(coalesce(cnpj, cpf), 4)) as code
  from doc left join own on own.CGC = dest
  left join x04 on lpad(x04.CPF_CGC, 14, '0') = lpad(coalesce(cnpj, cpf), 14, '0')
  where goods
),
fitem as (
  select emp as COD_EMPRESA, est as COD_ESTAB, '20240131' as DATA_FISCAL, '1' as MOVTO_E_S, '1' as NORM_DEV,
    'NFE' as COD_DOCTO, kind as IND_FIS_JUR, code as COD_FIS_JUR, {pad('d.k', 9)} as NUM_DOCFIS, serie as SERIE_DOCFIS,
    '8' as IND_PRODUTO, coalesce(m.material, 'NP') as COD_PRODUTO, cast(ln as varchar) as NUM_ITEM,
    coalesce(f.novo_cfo, 'NP') as COD_CFO, coalesce(f.novo_natop, 'NP') as COD_NATUREZA_OP,
    {fp('l_quantity', 6, 11)} as QUANTIDADE, 'UN' as COD_MEDIDA, {pad('p', 8)} as COD_NBM,
    {fp('case when avulsa then 0 else coalesce(unit_price, 0) end', 4, 15)} as VLR_UNIT,
    {fp('case when avulsa then 0 else vprod end', 2, 15)} as VLR_ITEM,
    case when ln between 1 and 7 then cast(s % 3 as varchar) end as COD_SITUACAO_A,
    case when taxed then '90' else '41' end as COD_SITUACAO_B, '00003' as COD_FEDERAL,
    case when taxed then '3' else '2' end as TRIB_ICMS,
    cast(case when avulsa then 0 else vprod - coalesce(l.vdesc, 0) + coalesce(vipi, 0) end as decimal(18,2)) as base_amount,
    {fp('base_amount', 2, 15)} as BASE_ICMS, '3' as TRIB_IPI, BASE_ICMS as BASE_IPI, BASE_ICMS as VLR_CONTAB_ITEM,
    '70' as COD_SITUACAO_PIS, '70' as COD_SITUACAO_COFINS, '20240131' as DAT_LANC_PIS_COFINS, 'N' as IND_BEM_PATR,
    coalesce(m.unit_code, 'NP') as COD_UND_PADRAO,
    {fp('case when avulsa then 0 else coalesce(l.vdesc, 0) end', 2, 15)} as VLR_DESCONTO, '03' as COD_TRIB_IPI
  from line l join fdoc d on d.k = l.k
  left join cfopmap f on f.cod_cfo = cast(5101 + p % 40 as varchar)
  left join fprod m on m.cod_ncm = {pad('p', 8)}
),
fsums as (select COD_EMPRESA, COD_ESTAB, NUM_DOCFIS, {_SUM} from fitem group by all),
fheader as (
  select emp as COD_EMPRESA, est as COD_ESTAB, '1' as MOVTO_E_S, '1' as NORM_DEV, 'NFE' as COD_DOCTO,
    kind as IDENT_FIS_JUR, code as COD_FIS_JUR, {pad('d.k', 9)} as NUM_DOCFIS, serie as SERIE_DOCFIS,
    strftime(o_orderdate + interval 1 day, '%Y%m%d') as DATA_EMISSAO, '1' as COD_CLASS_DOC_FIS, model as COD_MODELO,
    coalesce(f.novo_cfo, 'NP') as COD_CFO, substr(refkey, 1, 12) as NUM_DOCFIS_REF,
    case when refkey is not null then serie end as SERIE_DOCFIS_REF, '20240131' as DATA_SAIDA_REC,
    {fp('case when avulsa then 0 else total end', 2, 15)} as VLR_PRODUTO,
    {fp('case when avulsa then 0 else total - coalesce(vdesc, 0) end', 2, 15)} as VLR_TOT_NOTA, 'N' as SITUACAO,
    1000 + row_number() over (order by d.k) as NUM_CONTROLE_DOCTO, '3' as IND_FATURA, chave as NUM_AUTENTIC_NFE,
    '20240131' as DAT_LANC_PIS_COFINS,
    {fp('case when avulsa then 0 else b.BASE_ISEN_ICMS end', 2, 15)} as BASE_ISEN_ICMS,
    {fp('case when avulsa then 0 else b.BASE_OUTR_ICMS end', 2, 15)} as BASE_OUTR_ICMS,
    {fp('case when avulsa then 0 else b.BASE_IPI end', 2, 15)} as BASE_OUTR_IPI, '55' as COD_MODELO_COTEPE,
    case when avulsa then 'S' end as IND_NF_REG_ESPECIAL,
    {fp('case when avulsa then 0 else coalesce(vdesc, 0) end', 2, 15)} as VLR_DESCONTO,
    {fp('vdesc', 2, 15)} as VLR_ABAT_NTRIBUTADO
  from fdoc d join fsums b on b.COD_EMPRESA = emp and b.COD_ESTAB = est and b.NUM_DOCFIS = {pad('d.k', 9)}
  left join cfopmap f on f.cod_cfo = d.cfop
)"""

UP_TO_FIRST = [DOC, ESTAB, PARTNER, MAPS, LINE, FIRST]

UP_TO_ISSUER = [DOC, ESTAB, ROLE, PARTNER, MAPS, ISSUER]
UP_TO_ITEM = [*UP_TO_ISSUER, LINE, ITEM]
UP_TO_HEADER = [*UP_TO_ITEM, SUMS, HEADER]


def sql(ctes: list[str], select: str) -> str:
    return "with " + ",".join(ctes) + "\n" + select


# Column names of the layout, in its order.
HEADER_NAMES = """
COD_EMPRESA, COD_ESTAB, MOVTO_E_S, NORM_DEV, COD_DOCTO, IDENT_FIS_JUR, COD_FIS_JUR, NUM_DOCFIS, SERIE_DOCFIS,
DATA_EMISSAO, COD_CLASS_DOC_FIS, COD_MODELO, COD_CFO, NUM_DOCFIS_REF, SERIE_DOCFIS_REF, DATA_SAIDA_REC,
VLR_PRODUTO, VLR_TOT_NOTA, SITUACAO, NUM_CONTROLE_DOCTO, IND_FATURA, NUM_AUTENTIC_NFE, DAT_LANC_PIS_COFINS,
BASE_ISEN_ICMS, BASE_OUTR_ICMS, BASE_OUTR_IPI, COD_MODELO_COTEPE, IND_NF_REG_ESPECIAL, VLR_DESCONTO,
VLR_ABAT_NTRIBUTADO, IND_TP_FRETE, UF_ORIG_DEST, UF_DESTINO, COD_MUNICIPIO_ORIG, COD_MUNICIPIO_DEST,
COD_NATUREZA_OP"""

# Column names of the layout, in its order.
ITEM_NAMES = """
COD_EMPRESA, COD_ESTAB, DATA_FISCAL, MOVTO_E_S, NORM_DEV, COD_DOCTO, IND_FIS_JUR, COD_FIS_JUR, NUM_DOCFIS,
SERIE_DOCFIS, IND_PRODUTO, COD_PRODUTO, NUM_ITEM, COD_CFO, NUM_DOCFIS_REF, SERIE_DOCFIS_REF, COD_NATUREZA_OP,
QUANTIDADE, COD_MEDIDA, COD_NBM, VLR_UNIT, VLR_ITEM, COD_SITUACAO_A, COD_SITUACAO_B, COD_FEDERAL, TRIB_ICMS,
BASE_ICMS, TRIB_IPI, BASE_IPI, VLR_CONTAB_ITEM, COD_SITUACAO_PIS, COD_SITUACAO_COFINS, DAT_LANC_PIS_COFINS,
IND_BEM_PATR, COD_UND_PADRAO, VLR_DESCONTO, COD_TRIB_IPI"""

HEADER_OK = "COD_CFO <> 'NP' and COD_ESTAB is not null"
ITEM_OK = "COD_CFO <> 'NP' and COD_PRODUTO <> 'NP' and COD_NATUREZA_OP <> 'NP' and COD_ESTAB is not null"


def _reason(codes: list[str]) -> str:
    parts = [f"case when {c} = 'NP' then '{c}' end" for c in codes]
    parts.append("case when COD_ESTAB is null then 'COD_ESTAB' end")
    return f"concat_ws(',', {', '.join(parts)}) as reason"


HEADER_REASON = _reason(["COD_CFO"])
ITEM_REASON = _reason(["COD_CFO", "COD_PRODUTO", "COD_NATUREZA_OP"])
ITEM_ERROR = sql(UP_TO_ITEM, f"select {ITEM_NAMES}, {ITEM_REASON} from item where not ({ITEM_OK})")
HEADER_VALID = sql(UP_TO_HEADER, f"select {HEADER_NAMES} from header where {HEADER_OK}")
PARTNER_NAMES = "CPF_CGC, COD_FIS_JUR, IND_FIS_JUR, IDENT_FIS_JUR, COD_MUNICIPIO, UF"
PARAM_LOADED = f"""
  select cast(2 as bigint) as ID_PARAMETRO, 'Produto' as NOME_PARAM,
    case when p_partkey % 20 = 1 then {pad('p_partkey', 7)} else {pad('p_partkey', 8)} end as CONTEUDO,
    p_name as DESCRICAO, cast(p_partkey as varchar) as VALOR
  from part where p_partkey % 10 = 0
  union all
  select 1, 'Produto', case when p_partkey % 20 = 1 then {pad('p_partkey', 7)} else {pad('p_partkey', 8)} end,
    substr(repeat(p_name || ' ', 40), 1, 300), cast(p_partkey as varchar)
  from part"""


def _counts(name: str, ok: str, source: str) -> str:
    return (
        f"select '{name}' as \"table\", count(*) as total, count(*) filter (where {ok}) as valid, "
        f"count(*) filter (where not ({ok})) as error from {source}"
    )


ITEM_VALID = sql(UP_TO_ITEM, f"select {ITEM_NAMES} from item where {ITEM_OK}")
NEW_PARTNERS = sql([DOC, PARTNER, NEW], "select * from newp")
HEADER_ERROR = sql(UP_TO_HEADER, f"select {HEADER_NAMES}, {HEADER_REASON} from header where not ({HEADER_OK})")
PARTS = f""" left join (select l_orderkey, count(*) as goods_lines from lineitem where l_orderkey % 5 <> 0 group by all) on l_orderkey = k,
    generate_series(1, greatest(1, cast(ceil(coalesce(goods_lines, 0) / {MAX_ITEMS}.0) as bigint))) as part"""
"""An order of more than MAX_ITEMS goods lines gives several documents."""

ORACLES: dict[str, str] = {
    "xml_scan_items": sql(
        [LINE],
        f"select {pad('k', 9)} as NUM_DOCFIS, cast(ln as varchar) as NUM_ITEM, cast(5101 + p % 40 as varchar) as CFOP, "
        f"{pad('p', 8)} as NCM, vprod as vProd, true as has_lineage from line",
    ),
    "xml_quarantine": """
        select 'bad-' || o_orderkey || '-other.xml' as filename, 'no_document' as reason from orders
        where o_orderkey % 97 = 0
        union all
        select 'bad-' || o_orderkey || '-cut.xml', 'malformed' from orders where o_orderkey % 193 = 0""",
    "tag_unify": sql(
        [DOC],
        "select k as doc_key, case when goods then 'NFE' when model = '57' then 'YD' else 'YJ' end as COD_DOCTO, "
        "chave as access_key, 'Rua cte ' || c_mktsegment || ' ' || c_name as street, vtprest as vTPrest from doc" + PARTS,
    ),
    "new_files_only": sql(
        [DOC],
        "select case when k % 2 = 0 then '1' else '2' end as run_id, model, count(*) as documents from doc" + PARTS + " group by all",
    ),
    "declared_encodings": sql(
        [DOC],
        f"select {pad('k', 9)} as NUM_DOCFIS, 'Rua S' || case when k % 3 = 2 then chr(65533) else 'ã' end || 'o cte ' "
        "|| c_mktsegment || ' ' || c_name as street from doc" + PARTS,
    ),
    "split_scan": sql(
        [DOC],
        f"select {pad('k', 9)} as NUM_DOCFIS, chave as access_key, "
        "cast(case when goods and goods_lines > 0 then goods_lines end as int) as items, "
        "'Rua cte ' || c_mktsegment || ' ' || c_name as street from doc" + PARTS,
    ),
    "schema_feedback": sql(
        [DOC],
        f"select {pad('k', 9)} as NUM_DOCFIS, case when goods and k % 13 = 0 then '2' else '1' end as run_id, "
        "case when goods and k % 13 = 0 then 'note ' || k end as note, "
        "case when goods then cast(total - coalesce(vdesc, 0) as decimal(18,2)) end as vNF from doc" + PARTS,
    ),
    "ingest_log": sql(
        [DOC],
        "select case when k % 2 = 0 then '1' else '2' end as run_id, model, count(*) as documents from doc" + PARTS + " group by all",
    ),
    "committed_runs": f"""
        with numbered as (
          select o_orderkey as k, row_number() over (partition by o_orderkey % 2 order by o_orderkey) as place,
            (select count(*) from orders where o_orderkey % 2 = 0) as even from orders
        )
        select case when k % 2 = 0 then 'a' else 'b' end as run_id, NUM_DOCFIS, COD_ESTAB,
          1000 + place + case when k % 2 = 0 then 0 else even end as NUM_CONTROLE_DOCTO
        from ({HEADER_VALID}) join numbered on k = cast(NUM_DOCFIS as bigint)""",
    "stream_import": f"select * exclude (NUM_CONTROLE_DOCTO) from ({HEADER_VALID})",
    "doc_class": sql(
        [DOC],
        "select k as doc_key, case when goods then 'NFE' when model = '57' then 'YD' else 'YJ' end as COD_DOCTO, "
        "case when goods then null when model = '57' then 'YD' else 'YJ' end as FREIGHT_DOCTO from doc",
    ),
    "doc_number": f"select o_orderkey as doc_key, {pad('o_orderkey', 9)} as NUM_DOCFIS from orders",
    "partner_code": sql(
        UP_TO_ISSUER,
        f"select k as doc_key, code as COD_FIS_JUR, {derived('cnpj', 'cpf')} as DERIVED, kind as IND_FIS_JUR from issuer",
    ),
    "fixed_point_amounts": sql(
        UP_TO_ITEM,
        "select k as doc_key, NUM_ITEM, QUANTIDADE, VLR_UNIT, VLR_ITEM, VLR_DESCONTO from item where COD_DOCTO = 'NFE'",
    ),
    "header_amounts": sql(
        UP_TO_HEADER, "select doc_key, VLR_PRODUTO, VLR_TOT_NOTA, VLR_DESCONTO, VLR_ABAT_NTRIBUTADO from header"
    ),
    "item_tax_base": sql(
        [LINE], "select k as doc_key, cast(ln as varchar) as NUM_ITEM, cast(base as decimal(18,2)) as base from line"
    ),
    "tax_origin_first_set": sql(
        [LINE],
        "select k as doc_key, cast(ln as varchar) as NUM_ITEM, origin as COD_SITUACAO_A, "
        "case when taxed then '90' else '41' end as COD_SITUACAO_B, "
        "case when taxed then '3' else '2' end as TRIB_ICMS from line",
    ),
    "special_regime": sql(
        [DOC],
        "select k as doc_key, case when avulsa then 'S' end as IND_NF_REG_ESPECIAL, "
        "cast(case when avulsa or not goods then 0 else total end as decimal(18,2)) as vProd from doc",
    ),
    "access_key_slices": sql(
        [DOC],
        "select k as doc_key, chave as NUM_AUTENTIC_NFE, substr(refkey, 26, 9) as NUM_DOCFIS_REF, "
        "substr(refkey, 23, 3) as SERIE_DOCFIS_REF, cfop as CFOP from doc",
    ),
    "dates_fixed": sql([DOC], "select k as doc_key, emissao as DATA_EMISSAO, '20240131' as DATA_SAIDA_REC from doc"),
    "places": sql(
        UP_TO_HEADER, "select doc_key, UF_ORIG_DEST, UF_DESTINO, COD_MUNICIPIO_ORIG, COD_MUNICIPIO_DEST from header"
    ),
    "role_resolution": sql([DOC, ESTAB, ROLE], "select k as doc_key, emp as COD_EMPRESA, est as COD_ESTAB from role"),
    "code_map_sentinel": sql(
        [DOC, MAPS],
        "select k as doc_key, coalesce(novo_cfo, 'NP') as COD_CFO, coalesce(novo_natop, 'NP') as COD_NATUREZA_OP "
        "from doc left join cfopmap on cod_cfo = cfop",
    ),
    "product_map": sql([MAPS], "select nome_param, cod_ncm, descricao, material, cod_und_padrao from prodmap"),
    "freight_product": sql(
        UP_TO_ITEM, "select k as doc_key, COD_PRODUTO, COD_MEDIDA, COD_NBM from item where COD_DOCTO <> 'NFE'"
    ),
    "cfop_map": sql([MAPS], "select * from cfopmap"),
    "override_map": sql([MAPS], "select * from overmap"),
    "establishments": sql([ESTAB], "select * from estab"),
    "partner_latest_by_taxid": sql([PARTNER], f"select {PARTNER_NAMES} from x04"),
    "partner_latest_by_code": sql([PARTNER], f"select {PARTNER_NAMES} from xcode"),
    "product_latest": sql(
        [MAPS], "select cast(p_partkey as varchar) as COD_PRODUTO, u as IDENT_UND_PADRAO from version"
    ),
    "taxid_view": sql([PARTNER], "select distinct CPF_CGC, CPF_CGC as CNPJ from x04"),
    "value_list_cfop": """
        select distinct cast(5101 + p_partkey % 40 as varchar) as cod_cfo, 'CFOP ' || (5101 + p_partkey % 40) as DESCRICAO
        from part order by 1""",
    "value_list_product": f"select distinct {pad('p_partkey', 8)} as COD_NBM, p_name as DESCRICAO from part order by 1",
    "map_key_repeats": sql([MAPS], "select ncm as ncm_key, count(*) as rows from prodmap group by ncm having count(*) > 1"),
    "param_load": PARAM_LOADED,
    "items_union": sql(UP_TO_ITEM, f"select {ITEM_NAMES} from item"),
    "item_sums": sql([*UP_TO_ITEM, SUMS], "select * from sums"),
    "item_sums_3keys": sql(UP_TO_ITEM, f"select COD_EMPRESA, COD_ESTAB, NUM_DOCFIS, {_SUM} from item group by all"),
    "item_tax_by_series": sql(
        [*UP_TO_ISSUER, LINE],
        "select lpad(nnf, 9, '0') as NUM_DOCFIS, serie as SERIE_DOCFIS, code as COD_FIS_JUR, "
        "cast(sum(case when ln = 1 then vipi end) as decimal(28,2)) as BASE_ICMS "
        "from line join issuer on issuer.k = line.k group by all",
    ),
    "header_items_inner": sql(
        [*UP_TO_ITEM, f"s3 as (select COD_EMPRESA, COD_ESTAB, NUM_DOCFIS, {_SUM} from item group by all)"],
        "select d.k as doc_key, s3.COD_EMPRESA, s3.COD_ESTAB, s3.NUM_DOCFIS, "
        + ", ".join(
            fp(f"case when avulsa then 0 else s3.{n} end", 2, 15) + f" as {n}"
            for n in ("BASE_IPI", "BASE_OUTR_ICMS", "BASE_ISEN_ICMS")
        )
        + " from issuer d join s3 on s3.COD_EMPRESA = emp and s3.COD_ESTAB = est "
        "and s3.NUM_DOCFIS = lpad(coalesce(nnf, nct), 9, '0')",
    ),
    "control_number": "select o_orderkey as doc_key, 1000 + row_number() over (order by o_orderkey) as NUM_CONTROLE_DOCTO from orders",
    "counter_next": "select 1000 + count(*) as NUM_DOCTO from orders",
    "header_table": sql(UP_TO_HEADER, f"select {HEADER_NAMES} from header"),
    "new_partners_table": NEW_PARTNERS,
    "header_valid": HEADER_VALID,
    "header_error": HEADER_ERROR,
    "item_valid": ITEM_VALID,
    "item_error": ITEM_ERROR,
    "run_metrics": sql(
        [*UP_TO_HEADER, NEW],
        _counts("headers", HEADER_OK, "header")
        + " union all "
        + _counts("items", ITEM_OK, "item")
        + " union all "
        + _counts("partners", "true", "newp"),
    ),
    "orphan_items": sql(
        UP_TO_HEADER,
        f"""select COD_EMPRESA, COD_ESTAB, NUM_DOCFIS, COD_FIS_JUR, count(*) as items from item i where {ITEM_OK}
        and not exists (select 1 from header h where h.COD_EMPRESA = i.COD_EMPRESA and h.COD_ESTAB = i.COD_ESTAB
          and h.NUM_DOCFIS = i.NUM_DOCFIS and h.COD_FIS_JUR = i.COD_FIS_JUR and h.COD_CFO <> 'NP')
        group by all""",
    ),
    "publish_by_name": HEADER_VALID,
    "publish_items": ITEM_VALID,
    "publish_partners": NEW_PARTNERS,
    "batch_headers": HEADER_VALID,
    "batch_items": ITEM_VALID,
    "header_error_csv": HEADER_ERROR,
    "counter_seed": f"select coalesce(max(NUM_CONTROLE_DOCTO), 0) as NUM_DOCTO from ({HEADER_VALID})",
    "error_csv": ITEM_ERROR,
    "preview": sql([DOC], "select k as doc_key, model from doc order by k limit 10"),
}
ORACLES["param_replace"] = ORACLES["param_load"]
ORACLES["first_items"] = sql(UP_TO_FIRST, "select * exclude (base_amount) from fitem")
ORACLES["first_headers"] = sql(UP_TO_FIRST, "select * from fheader")
ORACLES["first_partners"] = sql(
    [DOC, PARTNER],
    f"""select distinct '1' as IND_FIS_JUR,
      'M' || substr(coalesce(cnpj, cpf), 1, 3) || right(coalesce(cnpj, cpf), 4) as COD_FIS_JUR,
      strftime(o_orderdate + interval 1 day, '%Y%m%d') as DATA_X04, '1' as IND_CONTEM_COD, c_name as RAZAO_SOCIAL,
      coalesce(cnpj, cpf) as CPF_CGC, ie as INSC_ESTADUAL, substr(c_name, 1, 50) as NOME_FANTASIA,
      substr('Rua cte ' || c_mktsegment || ' ' || c_name, 1, 50) as ENDERECO, cast(c as varchar) as NUM_ENDERECO,
      substr('Bairro ' || n || ' ' || c_mktsegment, 1, 20) as BAIRRO, 'Town ' || n as CIDADE, {state('n')} as UF,
      {pad('n * 1000', 8)} as CEP, case when c % 5 <> 0 then '105' end as COD_PAIS, {town('n')} as COD_MUNICIPIO
    from doc where goods and not exists (
      select 1 from x04 where lpad(x04.CPF_CGC, 14, '0') = lpad(coalesce(doc.cnpj, doc.cpf), 14, '0'))""",
)
ORACLES["places_of_document"] = sql(
    [DOC],
    "select k as doc_key, uf_ini as UF_ORIG_DEST, uf_fim as UF_DESTINO, mun_ini as COD_MUNICIPIO_ORIG, "
    "mun_fim as COD_MUNICIPIO_DEST from doc",
)
ORACLES["item_sums_series"] = sql(
    UP_TO_HEADER,
    "select NUM_DOCFIS, SERIE_DOCFIS, COD_ESTAB, BASE_OUTR_IPI, BASE_OUTR_ICMS, BASE_ISEN_ICMS from header",
)
