"""The registered queries: each takes a session and a folder of trade tables and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.functions import expr as E
from fiscalmill.operators import dims as D
from fiscalmill.operators import headers as H
from fiscalmill.operators import items as I
from fiscalmill.operators import numbering as N
from fiscalmill.operators import validate as V
from fiscalmill.operators.documents import receiving_establishment, resolve, with_partner_code
from fiscalmill.operators.lookup import BROADCAST_ROWS, Lookup, left_lookup
from fiscalmill.operators.partners import new_partners
from fiscalmill.plans import batch, runs, variants
from fiscalmill.session import tune
from fiscalmill.settings import HEADER_LAYOUT, ITEM_LAYOUT, PARTNER_LAYOUT
from fiscalmill.sources import parameters, sample, schema, sinks, staging, xml, xml_splits
from fiscalmill.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = ["doc_key"]
RUN = "20240131000000"
LARGEST = ["orders", "lineitem"]
"""Tables that documents are made of. Shuffles are dealt by their size."""


def query(f: Query) -> Query:
    @wraps(f)
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        large = sum(staging.bytes_of(spark, f"{folder}/{name}.parquet") for name in LARGEST)
        return f(tune(spark, large), folder)

    QUERIES[f.__name__] = tuned
    return f


class World:
    """Frames that several queries start from, built on demand."""

    def __init__(self, spark: SparkSession, folder: str, price_rows: int | None = None) -> None:
        self.spark, self.folder, self.settings, self.price_rows = spark, folder, sample.SETTINGS, price_rows

    def table(self, name: str) -> DataFrame:
        return sample.table(self.spark, self.folder, name)

    @cached_property
    def master(self) -> D.MasterData:
        return sample.master_data(self.spark, self.folder, self.settings)

    @cached_property
    def dims(self) -> D.Dimensions:
        return D.dimensions(self.master, self.settings)

    @cached_property
    def staged_dims(self) -> D.Dimensions:
        return self.dims.staged()

    @cached_property
    def docs(self) -> DataFrame:
        return sample.full_documents(self.spark, self.folder, price_rows=self.price_rows)

    @cached_property
    def heads(self) -> DataFrame:
        """Documents for queries that read no items."""
        return sample.heads(self.spark, self.folder)

    @cached_property
    def _resolved(self) -> tuple[DataFrame, int]:
        """Documents are resolved before their items join them, so no lookup moves items."""
        found = lambda heads: resolve(heads, self.staged_dims, self.settings, KEY).drop("COD_FIS_JUR")
        docs = sample.full_documents(self.spark, self.folder, found=found)
        return staging.stage_counted(with_partner_code(docs), "documents")

    @property
    def resolved(self) -> DataFrame:
        return self._resolved[0]

    @property
    def documents(self) -> int:
        return self._resolved[1]

    @cached_property
    def raw_lines(self) -> DataFrame:
        return I.explode_items(self.docs).select(*KEY, "item")

    @cached_property
    def lines(self) -> DataFrame:
        return I.lines_of(I.explode_items(self.resolved), [*KEY, "item"])

    @cached_property
    def items(self) -> DataFrame:
        return I.item_table(self.resolved, self.lines, self.staged_dims, self.settings, KEY)

    def with_staged_items(self) -> World:
        """For queries that read the items more than once: they are made once and written."""
        self.items = self.summed_items = staging.stage(self.items, "items")
        return self

    @cached_property
    def summed_items(self) -> DataFrame:
        """Items for sums, which take nothing of the product map: its rows are not looked up, only its repeats."""
        return I.item_table(self.resolved, self.lines, self.staged_dims.counting(), self.settings, KEY)

    @cached_property
    def sums(self) -> DataFrame:
        return I.item_sums(self.summed_items)

    @cached_property
    def open_headers(self) -> DataFrame:
        return H.unnumbered_headers(
            self.resolved, self.sums, self.staged_dims, self.settings, KEY, rows=self.documents
        )

    @cached_property
    def headers(self) -> DataFrame:
        return H.header_table(
            self.resolved, self.sums, self.staged_dims, self.settings, sample.COUNTER, KEY, rows=self.documents
        )

    def texts(self) -> DataFrame:
        return sample.xml_texts(self.docs)


# Intake


@query
def xml_scan_items(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as XML files, scanned natively, staged, and exploded to items."""
    path = staging.new_folder(spark, "landing")
    xml.write_files(sample.full_documents(spark, folder), path)
    docs = xml.readable(xml.scan_files(spark, [path]))
    item = F.col("item")
    return I.explode_items(docs).select(
        E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT")).alias("NUM_DOCFIS"),
        item["_nItem"].alias("NUM_ITEM"),
        item["prod"]["CFOP"].alias("CFOP"),
        item["prod"]["NCM"].alias("NCM"),
        item["prod"]["vProd"].alias("vProd"),
        F.col("filename").contains("/landing-").alias("has_lineage"),
    )


@query
def xml_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Files that do not fit the schema, written as a CSV list and read back."""
    texts = World(spark, folder).texts().unionByName(sample.bad_texts(spark, folder))
    bad = staging.stage(xml.verdicts(texts), "verdicts").where(F.col("reason").isNotNull())
    return sinks.csv_round_trip(bad, staging.new_folder(spark, "quarantine"))


@query
def declared_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that declare ISO-8859-1 or UTF-8, some of the latter with a broken byte, read from one folder."""
    landing = staging.new_folder(spark, "landing")
    xml.write_lines(sample.encoded_lines(flat(World(spark, folder).texts())), landing)
    docs = xml.parse_documents(xml.split_documents(xml.read_text_documents(spark, [landing], whole_files=False)))
    return docs.select(
        E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT")).alias("NUM_DOCFIS"),
        E.doc("emit.enderEmit.xLgr").alias("street"),
    )


@query
def tag_unify(spark: SparkSession, folder: str) -> DataFrame:
    """Both document families read through one vocabulary; words inside the data stay as they are."""
    docs = xml.readable(staging.stage(xml.parse_documents(World(spark, folder).texts()), "documents"))
    return docs.select(
        "doc_key",
        E.header_class(E.doc("ide.nNF"), E.doc("ide.mod"), sample.SETTINGS.freight_model).alias("COD_DOCTO"),
        F.col("protNFe.infProt.chNFe").alias("access_key"),
        E.doc("emit.enderEmit.xLgr").alias("street"),
        E.doc("vPrest.vTPrest").alias("vTPrest"),
    )


ARRIVALS, ARRIVAL_DOCUMENTS, FILE_DOCUMENTS = 8, 100_000, 50_000
"""Files that must not be packed arrive in at most so many parts, each of at least about so many documents. A file has about
so many documents at least, if there are two such files, so that several tasks read it."""


def arrivals(texts: DataFrame, rows: int) -> list[DataFrame]:
    """Staged texts dealt to one part or more, file by file: each is read once."""
    files = sorted(texts.inputFiles())
    parts = min(ARRIVALS, max(1, rows // ARRIVAL_DOCUMENTS), max(1, len(files)))
    if parts == 1:
        return [texts]
    return [texts.sparkSession.read.schema(texts.schema).parquet(*files[part::parts]) for part in range(parts)]


@query
def split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of both vocabularies in files without line breaks, each file read by several tasks.

    Files that several tasks read are not packed. So they arrive in parts, and a part that was read is removed.
    """
    found = staging.new_folder(spark, "documents")
    made = flat(World(spark, folder).texts().unionByName(sample.bad_texts(spark, folder)))
    texts, rows = staging.stage_counted(made.select("text"), "texts")
    parts = arrivals(texts, rows)
    files = max(2, rows // len(parts) // FILE_DOCUMENTS)
    for part in parts:
        with staging.run_scope(spark, uuid.uuid4().hex):
            landing = staging.new_folder(spark, "landing")
            part.coalesce(files).write.option("lineSep", " ").text(landing)
            docs = xml.readable(xml.parse_documents(xml_splits.scan_documents(spark, [landing])))
            read = docs.select(
                E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT")).alias("NUM_DOCFIS"),
                F.col("protNFe.infProt.chNFe").alias("access_key"),
                F.size(E.doc("det")).alias("items"),
                E.doc("emit.enderEmit.xLgr").alias("street"),
            )
            read.write.mode("append").option("compression", staging.COMPRESSION).parquet(found)
    return spark.read.schema(read.schema).parquet(found)


@query
def schema_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Known schema extended by what the files hold, as leaf paths and types."""
    path = staging.new_folder(spark, "landing")
    xml.write_files(sample.full_documents(spark, folder), path)
    found = xml.infer_schema(spark, [path])
    return schema.schema_paths(spark, schema.merge_schemas(schema.document_schema(), found))


@query
def new_files_only(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals in a landing area; each run of the intake takes the files it has not seen."""
    landing, target = staging.new_folder(spark, "landing"), staging.new_folder(spark, "intake")
    checkpoint = staging.new_folder(spark, "intake-checkpoint")
    texts = staging.stage(flat(World(spark, folder).texts()).select("doc_key", "text"), "texts")
    arrivals = [F.col("doc_key") % 2 == 0, F.col("doc_key") % 2 != 0]
    for run, arrived in enumerate(arrivals, start=1):
        xml.write_lines(texts.where(arrived).select("text"), landing)
        intake.stage_new_documents(spark, landing, checkpoint, target, run_id=str(run), whole_files=False)
    return (
        spark.read.parquet(target)
        .groupBy(F.col("run_id").cast("string").alias("run_id"), E.doc("ide.mod").alias("model"))
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def flat(texts: DataFrame) -> DataFrame:
    """Texts with one line for each document."""
    text = F.col("text")
    return texts.withColumn("text", F.when(text.contains("\n"), F.regexp_replace(text, "\n *", "")).otherwise(text))


def new_store(spark: SparkSession) -> runs.Store:
    return runs.Store.under(staging.new_folder(spark, "store"))


@query
def schema_feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a newer layout do not fit the schema in the first run; their texts widen it, and the next run reads them."""
    texts = sample.newer_texts(World(spark, folder).texts())
    store, extras = new_store(spark), {"note": "NFe.infNFe.infAdic.note"}
    runs.take_documents(spark, texts, store, "1", extras)
    runs.take_documents(spark, texts.limit(0), store, "2", extras)
    return store.runs.read(spark, "documents").select(
        E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT")).alias("NUM_DOCFIS"),
        "run_id",
        "note",
        E.doc("total.ICMSTot.vNF").alias("vNF"),
    )


@query
def ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """Runs over one landing area take each file once; the files of a run that never commits come again."""
    landing, store = staging.new_folder(spark, "landing"), new_store(spark)
    texts = staging.stage(flat(World(spark, folder).texts()).select("doc_key", "text"), "texts")
    for run, arrived in (("1", F.col("doc_key") % 2 == 0), ("2", F.col("doc_key") % 2 != 0)):
        xml.write_lines(texts.where(arrived).select("text"), landing)
        failed = store.begin(spark, "failed")
        failed.write(runs.files_of_run(spark, landing, store, "failed"), "ingested")
        runs.take_folder(spark, landing, store, run, files="lines")
    runs.take_folder(spark, landing, store, "3", files="lines")
    taken = store.runs.read(spark, "documents")
    return taken.groupBy("run_id", E.doc("ide.mod").alias("model")).agg(F.count(F.lit(1)).alias("documents"))


@query
def committed_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of two runs, of which one is repeated, among attempts that wrote rows and never committed."""
    w, store = World(spark, folder), new_store(spark)
    texts = staging.stage(w.texts(), "texts")
    even, odd = texts.where("doc_key % 2 = 0"), texts.where("doc_key % 2 <> 0")
    runs.import_texts(spark, even, w.master, w.settings, store, "a", sample.COUNTER)
    for run in ("a", "b"):
        store.begin(spark, run).write(store.runs.read(spark, "headers").select(*HEADER_LAYOUT), "headers")
    runs.import_texts(spark, odd, w.master, w.settings, store, "b", sample.COUNTER)
    runs.import_texts(spark, even, w.master, w.settings, store, "a", sample.COUNTER)
    return store.runs.read(spark, "headers").select("run_id", "NUM_DOCFIS", "COD_ESTAB", "NUM_CONTROLE_DOCTO")


class Stopped(Exception):
    """Stands for a driver that is lost between the commit of a batch and the stream's checkpoint."""


@query
def stream_import(spark: SparkSession, folder: str) -> DataFrame:
    """Whole runs from a stream that admits two files a batch, stopped once after a commit, and started again."""
    w, store = World(spark, folder), new_store(spark)
    landing, checkpoint = staging.new_folder(spark, "landing"), staging.new_folder(spark, "checkpoint")
    with staging.run_scope(spark, uuid.uuid4().hex):
        texts = staging.stage(flat(w.texts()).select("text"), "texts")
        enough = texts.rdd.getNumPartitions() >= 4
        xml.write_lines(texts.coalesce(4) if enough else texts.repartition(4), landing)
    lost = []

    def stop_once(run_id: str) -> None:
        if not lost:
            lost.append(run_id)
            raise Stopped(run_id)

    for _ in range(2):
        try:
            runs.stream_imports(
                spark, landing, checkpoint, w.master, w.settings, store, "arrivals", sample.COUNTER,
                whole_files=False, files_per_batch=2, after=stop_once,
            )
        except StreamingQueryException as stopped:
            if "Stopped" not in str(stopped):
                raise
    return store.runs.read(spark, "headers").select(*[c for c in HEADER_LAYOUT if c != H.NUMBER])


# Projections


@query
def doc_class(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    nnf, nct, model = E.doc("ide.nNF"), E.doc("ide.nCT"), E.doc("ide.mod")
    freight = F.when(nct.isNotNull(), E.freight_class(model, w.settings.freight_model))
    return w.heads.select(
        *KEY, E.header_class(nnf, model, w.settings.freight_model).alias("COD_DOCTO"), freight.alias("FREIGHT_DOCTO")
    )


@query
def doc_number(spark: SparkSession, folder: str) -> DataFrame:
    number = E.document_number(E.doc("ide.nNF"), E.doc("ide.nCT"))
    return World(spark, folder).heads.select(*KEY, number.alias("NUM_DOCFIS"))


@query
def partner_code(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    kinds = left_lookup(
        w.resolved, w.staged_dims.partners_by_code, {"COD_FIS_JUR": F.col("_override")}, {"_kind": "IND_FIS_JUR"}, KEY,
        nulls_apart=True,
    )
    return kinds.select(
        *KEY,
        "COD_FIS_JUR",
        E.partner_code(E.doc("emit.CNPJ"), E.doc("emit.CPF")).alias("DERIVED"),
        F.coalesce("_kind", "_x04_kind", F.lit("1")).alias("IND_FIS_JUR"),
    )


@query
def fixed_point_amounts(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return w.items.where(F.col("COD_DOCTO") == "NFE").select(
        *KEY, "NUM_ITEM", "QUANTIDADE", "VLR_UNIT", "VLR_ITEM", "VLR_DESCONTO"
    )


@query
def header_amounts(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    columns = H.document_columns(w.resolved, w.settings, KEY)
    return columns.select(*KEY, "VLR_PRODUTO", "VLR_TOT_NOTA", "VLR_DESCONTO", "VLR_ABAT_NTRIBUTADO")


@query
def item_tax_base(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("item")
    lines = World(spark, folder).raw_lines
    return lines.select(*KEY, item["_nItem"].alias("NUM_ITEM"), E.tax_base(item).alias("base"))


@query
def tax_origin_first_set(spark: SparkSession, folder: str) -> DataFrame:
    item = F.col("item")
    icms = item["imposto"]["ICMS"]
    return World(spark, folder).raw_lines.select(
        *KEY,
        item["_nItem"].alias("NUM_ITEM"),
        E.tax_origin(icms).alias("COD_SITUACAO_A"),
        E.situation_code(icms["ICMS00"]["vICMS"]).alias("COD_SITUACAO_B"),
        E.tribute_code(icms["ICMS00"]["vICMS"]).alias("TRIB_ICMS"),
    )


@query
def special_regime(spark: SparkSession, folder: str) -> DataFrame:
    cpf, ie = E.doc("emit.CPF"), E.doc("emit.IE")
    return World(spark, folder).heads.select(
        *KEY,
        F.when(E.is_avulsa(cpf, ie), "S").alias("IND_NF_REG_ESPECIAL"),
        E.issuer_amount(E.doc("total.ICMSTot.vProd")).cast(E.MONEY).alias("vProd"),
    )


@query
def access_key_slices(spark: SparkSession, folder: str) -> DataFrame:
    reference = F.get(E.doc("ide.NFref"), 0)["refNFe"]
    return World(spark, folder).docs.select(
        *KEY,
        F.col("protNFe.infProt.chNFe").alias("NUM_AUTENTIC_NFE"),
        E.key_number(reference).alias("NUM_DOCFIS_REF"),
        E.key_series(reference).alias("SERIE_DOCFIS_REF"),
        H.header_cfop(F.get(E.doc("det"), 0)["prod"]["CFOP"], E.doc("ide.CFOP")).alias("CFOP"),
    )


@query
def dates_fixed(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return w.heads.select(
        *KEY, E.issue_date(E.doc("ide.dhEmi")).alias("DATA_EMISSAO"), F.lit(w.settings.run_date).alias("DATA_SAIDA_REC")
    )


@query
def places(spark: SparkSession, folder: str) -> DataFrame:
    return World(spark, folder).open_headers.select(
        *KEY, "UF_ORIG_DEST", "UF_DESTINO", "COD_MUNICIPIO_ORIG", "COD_MUNICIPIO_DEST"
    )


# Lookups


@query
def role_resolution(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    found = receiving_establishment(w.heads, w.dims.establishments, w.settings, KEY)
    return found.select(*KEY, "COD_EMPRESA", "COD_ESTAB")


@query
def code_map_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    code = H.header_cfop(F.get(E.doc("det"), 0)["prod"]["CFOP"], E.doc("ide.CFOP"))
    found = left_lookup(w.docs, w.dims.cfop, {"cod_cfo": code}, I.CFOP_COLUMNS, KEY)
    return found.select(
        *KEY,
        E.or_sentinel(F.col("_cfo"), w.settings.sentinel).alias("COD_CFO"),
        E.or_sentinel(F.col("_natop"), w.settings.sentinel).alias("COD_NATUREZA_OP"),
    )


@query
def product_map(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.product_map(w.master.details, w.master.heads, w.master.products, w.master.units, w.settings)


@query
def freight_product(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return I.freight_items(w.resolved, w.staged_dims, w.settings, KEY).select(*KEY, "COD_PRODUTO", "COD_MEDIDA", "COD_NBM")


@query
def cfop_map(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.cfop_map(w.master.details, w.master.heads, w.settings)


@query
def override_map(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.override_map(w.master.details, w.master.heads, w.settings)


@query
def establishments(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.establishments(w.master.establishments, w.master.states, w.settings)


PARTNER_COLUMNS = ["CPF_CGC", "COD_FIS_JUR", "IND_FIS_JUR", "IDENT_FIS_JUR", "COD_MUNICIPIO", "UF"]


@query
def partner_latest_by_taxid(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.partners_by_tax_id(w.master.partners, w.master.states).select(*PARTNER_COLUMNS)


@query
def partner_latest_by_code(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return D.partners_by_code(w.master.partners, w.master.states).select(*PARTNER_COLUMNS)


@query
def product_latest(spark: SparkSession, folder: str) -> DataFrame:
    return D.latest_products(World(spark, folder).master.products).select("COD_PRODUTO", "IDENT_UND_PADRAO")


@query
def taxid_view(spark: SparkSession, folder: str) -> DataFrame:
    return D.partner_tax_ids(World(spark, folder).master.partners)


@query
def value_list_cfop(spark: SparkSession, folder: str) -> DataFrame:
    return D.operation_code_list(sample.operation_codes(World(spark, folder).table("part")))


@query
def value_list_product(spark: SparkSession, folder: str) -> DataFrame:
    return D.product_code_list(sample.product_codes(World(spark, folder).table("part")))


@query
def map_key_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Product keys that would multiply item rows."""
    return D.repeated_keys(World(spark, folder).dims.products.frame, ["ncm_key"])


@query
def param_load(spark: SparkSession, folder: str) -> DataFrame:
    """Parameter details after replacing the configured group by a new product mapping."""
    w = World(spark, folder)
    mapping = sample.product_mapping(w.table("part"), w.settings).withColumn(
        "DESCRICAO", F.repeat(F.concat("DESCRICAO", F.lit(" ")), 40)
    )
    loaded = D.load_parameters(w.master.details, w.master.heads, mapping, w.settings)
    return loaded.drop("ID_PARAM_DET")


@query
def param_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Stored parameters after the configured group was replaced, twice with the same mapping, and read back."""
    w = World(spark, folder)
    mapping = sample.product_mapping(w.table("part"), w.settings).withColumn(
        "DESCRICAO", F.repeat(F.concat("DESCRICAO", F.lit(" ")), 40)
    )
    path = staging.new_folder(spark, "parameters")
    parameters.store(w.master.details, path)
    for _ in range(2):
        parameters.replace(spark, path, w.master.heads, mapping, w.settings)
    return parameters.read(spark, path).drop("ID_PARAM_DET")


# Items


@query
def items_union(spark: SparkSession, folder: str) -> DataFrame:
    return World(spark, folder).items.select(*ITEM_LAYOUT)


@query
def item_sums(spark: SparkSession, folder: str) -> DataFrame:
    return World(spark, folder).sums


@query
def item_sums_3keys(spark: SparkSession, folder: str) -> DataFrame:
    return I.item_sums_by_number(World(spark, folder).summed_items)


@query
def item_tax_by_series(spark: SparkSession, folder: str) -> DataFrame:
    return I.item_tax_by_series(World(spark, folder).lines)


@query
def header_items_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Headers that have item sums, by the superseded three keys."""
    w = World(spark, folder)
    return variants.headers_with_sums(w.resolved, I.item_sums_by_number(w.summed_items), KEY, rows=w.documents)


# The first layout


def first_layout(spark: SparkSession, folder: str) -> tuple[World, DataFrame, DataFrame]:
    """Resolved goods invoices with all their items, and the items of the first layout."""
    w = World(spark, folder)
    # Invoices are resolved before their items join them. Lines without an order join none, and are no invoice.
    found = lambda heads: variants.first_resolved(heads, w.staged_dims, w.settings, KEY)
    docs = variants.goods_invoices(sample.full_documents(spark, folder, found=found))
    resolved = staging.stage(docs, "resolved")
    products = variants.first_product_map(w.master.details, w.master.heads, w.master.products, w.master.units, w.settings)
    lookup = Lookup(products).staged("first-products")
    return w, resolved, variants.first_items(resolved, w.staged_dims, lookup, w.settings, KEY)


@query
def first_items(spark: SparkSession, folder: str) -> DataFrame:
    return first_layout(spark, folder)[2].select(*variants.FIRST_ITEM_LAYOUT)


@query
def first_headers(spark: SparkSession, folder: str) -> DataFrame:
    w, resolved, items = first_layout(spark, folder)
    heads = variants.first_headers(resolved, items, w.staged_dims, w.settings, sample.COUNTER, KEY)
    return heads.select(*variants.FIRST_HEADER_LAYOUT)


@query
def first_partners(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return variants.first_new_partners(w.heads, w.dims)


@query
def places_of_document(spark: SparkSession, folder: str) -> DataFrame:
    return variants.places_of_document(World(spark, folder).heads, KEY)


@query
def item_sums_series(spark: SparkSession, folder: str) -> DataFrame:
    """Headers joined to item sums that keep the series in their key."""
    w = World(spark, folder)
    sums = I.item_sums(w.summed_items, by_series=True)
    heads = H.unnumbered_headers(w.resolved, sums, w.staged_dims, w.settings, KEY, rows=w.documents)
    return heads.select("NUM_DOCFIS", "SERIE_DOCFIS", "COD_ESTAB", "BASE_OUTR_IPI", "BASE_OUTR_ICMS", "BASE_ISEN_ICMS")


# Headers


@query
def control_number(spark: SparkSession, folder: str) -> DataFrame:
    number = F.coalesce(E.doc("ide.nNF"), E.doc("ide.nCT")).cast("bigint")
    rows = World(spark, folder).heads.select(*KEY, number.alias("_number"))
    order = [F.col("_number").asc_nulls_first(), F.col("doc_key").asc()]
    return N.number_rows(rows, order, sample.COUNTER, H.NUMBER).select(*KEY, H.NUMBER)


@query
def counter_next(spark: SparkSession, folder: str) -> DataFrame:
    return N.next_counter(control_number(spark, folder), sample.COUNTER)


@query
def header_table(spark: SparkSession, folder: str) -> DataFrame:
    return World(spark, folder).headers.select(*HEADER_LAYOUT)


# Partners


@query
def new_partners_table(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return new_partners(w.heads, w.dims, w.settings)


# Validation and sinks


@query
def header_valid(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return V.header_split(w.headers.select(*HEADER_LAYOUT), w.settings)[0]


@query
def header_error(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return V.header_split(w.headers.select(*HEADER_LAYOUT), w.settings)[1]


@query
def item_valid(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return V.item_split(w.items.select(*ITEM_LAYOUT), w.settings)[0]


@query
def item_error(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder)
    return V.item_split(w.items.select(*ITEM_LAYOUT), w.settings)[1]


@query
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder).with_staged_items()
    return V.run_metrics(w.open_headers, w.items, new_partners(w.resolved, w.staged_dims, w.settings), w.settings)


@query
def orphan_items(spark: SparkSession, folder: str) -> DataFrame:
    w = World(spark, folder).with_staged_items()
    return V.orphan_items(w.open_headers, w.items, w.settings)


def published(rows: DataFrame, layout: list[str]) -> DataFrame:
    """Rows as a target has them after publishing."""
    target = sinks.FileTarget(staging.new_folder(rows.sparkSession, "published"))
    sinks.publish(rows, layout, target, run_id=RUN)
    return target.read(rows.sparkSession).where(F.col(sinks.RUN_ID) == RUN).select(*layout)


@query
def publish_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Valid headers published into the target by column name, and read back."""
    w = World(spark, folder)
    good, _ = V.header_split(w.headers.select(*HEADER_LAYOUT), w.settings)
    return published(good, HEADER_LAYOUT)


@query
def publish_items(spark: SparkSession, folder: str) -> DataFrame:
    """Valid items published into the target, and read back."""
    w = World(spark, folder)
    good, _ = V.item_split(w.items.select(*ITEM_LAYOUT), w.settings)
    return published(good, ITEM_LAYOUT)


@query
def publish_partners(spark: SparkSession, folder: str) -> DataFrame:
    """New partners published into the target, and read back."""
    w = World(spark, folder)
    return published(new_partners(w.heads, w.dims, w.settings), PARTNER_LAYOUT)


@query
def counter_seed(spark: SparkSession, folder: str) -> DataFrame:
    """Counter for a first run, from the headers that were published before."""
    return N.seed_counter(publish_by_name(spark, folder))


@query
def header_error_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty headers written as CSV with a header line, and read back."""
    w = World(spark, folder)
    _, bad = V.header_split(w.headers.select(*HEADER_LAYOUT), w.settings)
    return sinks.csv_round_trip(bad, staging.new_folder(spark, "header-errors"))


def batch_outputs(spark: SparkSession, folder: str) -> batch.Outputs:
    """A whole run from text: documents of both vocabularies and broken ones, one a line, to the output tables.

    The run plans and compiles more on the driver than any other query, so prices are broadcast no further than other tables.
    """
    w = World(spark, folder, price_rows=BROADCAST_ROWS)
    texts = w.texts().unionByName(sample.bad_texts(spark, folder))
    landing = staging.new_folder(spark, "landing")
    xml.write_lines(flat(texts).select(F.col("text").alias("value")), landing)
    found = xml.split_documents(xml.read_text_documents(spark, [landing], whole_files=False))
    outputs = batch.build(xml.parse_documents(found), w.master, w.settings, sample.COUNTER)
    if outputs is None:
        raise ValueError("no documents")
    return outputs


@query
def batch_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Valid headers of a run from text."""
    return V.header_split(batch_outputs(spark, folder).headers, sample.SETTINGS)[0].select(*HEADER_LAYOUT)


@query
def batch_items(spark: SparkSession, folder: str) -> DataFrame:
    """Valid items of a run from text."""
    return V.item_split(batch_outputs(spark, folder).items, sample.SETTINGS)[0].select(*ITEM_LAYOUT)


@query
def error_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty items written as CSV with a header line, and read back."""
    w = World(spark, folder)
    _, bad = V.item_split(w.items.select(*ITEM_LAYOUT), w.settings)
    return sinks.csv_round_trip(bad, staging.new_folder(spark, "item-errors"))


@query
def preview(spark: SparkSession, folder: str) -> DataFrame:
    """First ten documents by number."""
    return batch.preview(World(spark, folder).heads.select(*KEY, E.doc("ide.mod").alias("model")), KEY)
