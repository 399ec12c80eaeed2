import pytest
from pyspark.sql import functions as F

from fiscalmill.operators import headers as H
from fiscalmill.operators import items as I
from fiscalmill.operators.dims import Dimensions, dimensions
from fiscalmill.operators import validate as V
from fiscalmill.operators.documents import batch_keys, resolve, without_items
from fiscalmill.operators.lookup import Lookup
from fiscalmill.plans import batch
from fiscalmill.plans.queries import QUERIES, World
from fiscalmill.settings import HEADER_LAYOUT, ITEM_LAYOUT, PARTNER_LAYOUT
from fiscalmill.sources import sample, sinks, xml
from fiscalmill.sources.staging import stage
from fiscalmill.streaming import intake
from tests.conftest import rows


def one_line(df):
    return df.select(F.regexp_replace("text", "\n *", "").alias("value"))


@pytest.fixture(scope="module")
def landing(spark, folder, tmp_path_factory):
    """Every document and some bad ones, one per line."""
    path = str(tmp_path_factory.mktemp("landing") / "in")
    texts = World(spark, folder).texts().unionByName(sample.bad_texts(spark, folder))
    one_line(texts).write.text(path)
    return path


@pytest.fixture(scope="module")
def targets(tmp_path_factory):
    base = tmp_path_factory.mktemp("out")
    return batch.Targets(
        headers=sinks.FileTarget(f"{base}/headers"),
        items=sinks.FileTarget(f"{base}/items"),
        partners=sinks.FileTarget(f"{base}/partners"),
        error_folder=f"{base}/error",
        counter_path=f"{base}/counter",
    )


@pytest.fixture(scope="module")
def counts(spark, folder, landing, targets):
    master = sample.master_data(spark, folder)
    out = batch.run(
        spark, [landing], master, sample.SETTINGS, sample.COUNTER, targets, "20240131", whole_files=False
    )
    return {r["table"]: r for r in out.collect()}


def published(spark, target, layout):
    return rows(target.read(spark).select(*layout))


def test_xml_files_give_the_same_tables_as_the_queries(spark, folder, counts, targets):
    assert published(spark, targets.headers, HEADER_LAYOUT) == rows(QUERIES["header_valid"](spark, folder))
    assert published(spark, targets.items, ITEM_LAYOUT) == rows(QUERIES["item_valid"](spark, folder))
    assert published(spark, targets.partners, PARTNER_LAYOUT) == rows(QUERIES["new_partners_table"](spark, folder))


def test_counts_and_counter(spark, counts, targets):
    headers, items = counts["headers"], counts["items"]
    assert headers["valid"] + headers["error"] == headers["total"]
    assert items["valid"] + items["error"] == items["total"]
    assert targets.headers.read(spark).count() == headers["valid"]
    assert sinks.read_counter(spark, targets.counter_path, "next") == sample.COUNTER + headers["total"]
    assert sinks.read_counter(spark, targets.counter_path, "20240131") == sample.COUNTER


def test_error_files(spark, counts, targets):
    quarantine = spark.read.option("header", True).csv(f"{targets.error_folder}/schema_error_20240131")
    assert quarantine.groupBy("reason").count().count() == 2
    bad = spark.read.option("header", True).csv(f"{targets.error_folder}/param_error_item_20240131")
    assert bad.count() == counts["items"]["error"]


def test_nothing_to_import(spark, folder, tmp_path, targets):
    (tmp_path / "empty.xml").write_text("")
    out = batch.run(
        spark, [str(tmp_path)], sample.master_data(spark, folder), sample.SETTINGS, 5, targets, "x", whole_files=False
    )
    assert out is None


def test_large_lookups_and_hot_keys_change_nothing(spark, folder):
    """Every lookup through the salted shuffle, with keys split from 20 rows on."""
    w = World(spark, folder)
    small = dimensions(w.master, w.settings)
    large = Dimensions(**{n: Lookup(getattr(small, n).frame, None, 0, 20) for n in small.__dataclass_fields__})
    docs = resolve(stage(w.docs, "parsed"), large, w.settings, ["doc_key"])
    docs = stage(docs, "documents")
    lines = I.lines_of(I.explode_items(docs), ["doc_key", "item"])
    items = stage(I.item_table(docs, stage(lines, "lines"), large, w.settings, ["doc_key"]), "items")
    assert rows(items.select(*ITEM_LAYOUT)) == rows(QUERIES["items_union"](spark, folder))
    sums = I.item_sums(items)
    headers = H.unnumbered_headers(docs, sums, large, w.settings, ["doc_key"], hot_rows=20)
    assert rows(headers) == rows(w.open_headers)


def test_stream_takes_each_file_once(spark, folder, tmp_path):
    landing, checkpoint, target = (str(tmp_path / n) for n in ("in", "cp", "out"))
    docs = one_line(World(spark, folder).texts().where("doc_key < 40"))
    docs.coalesce(1).write.mode("append").text(landing)
    intake.stage_new_documents(spark, landing, checkpoint, target, "1", whole_files=False)
    intake.stage_new_documents(spark, landing, checkpoint, target, "2", whole_files=False)
    assert spark.read.parquet(target).groupBy("run_id").count().collect() == [(1, 40)]
    docs.coalesce(1).write.mode("append").text(landing)
    intake.stage_new_documents(spark, landing, checkpoint, target, "3", whole_files=False)
    found = {r["run_id"]: r["count"] for r in spark.read.parquet(target).groupBy("run_id").count().collect()}
    assert found == {1: 40, 3: 40}


def test_arrivals_reach_a_handler(spark, folder, tmp_path):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    one_line(World(spark, folder).texts().where("doc_key < 10")).write.text(landing)
    seen = []
    intake.for_each_arrival(spark, landing, checkpoint, lambda df, n: seen.append(df.count()), whole_files=False)
    intake.for_each_arrival(spark, landing, checkpoint, lambda df, n: seen.append(df.count()), whole_files=False)
    assert sum(seen) == 10


def test_unseen_files(spark, tmp_path):
    for name in ("a.xml", "b.xml"):
        (tmp_path / name).write_text("<x/>")
    listing = intake.unseen_files(spark, str(tmp_path), spark.createDataFrame([], "path string"))
    log = listing.where(F.col("path").endswith("a.xml"))
    assert [r["path"][-5:] for r in intake.unseen_files(spark, str(tmp_path), log).collect()] == ["b.xml"]


@pytest.fixture(scope="module")
def parsed(spark, folder):
    texts = World(spark, folder).texts().unionByName(sample.bad_texts(spark, folder))
    return stage(xml.parse_documents(texts), "parsed").drop("doc_key")


@pytest.mark.parametrize("largest", [0, 60, 200_000])
def test_tables_too_large_to_broadcast_give_the_same_rows(spark, folder, parsed, largest):
    """No table, some tables and all tables are broadcast; with none, documents and items take ways of their own."""
    w = World(spark, folder)
    out = batch.build(parsed, w.master, w.settings, sample.COUNTER, broadcast_rows=largest)
    valid = lambda df, codes: df.where(V.valid(codes, w.settings))
    assert rows(valid(out.headers, V.HEADER_CODES).select(*HEADER_LAYOUT)) == rows(QUERIES["header_valid"](spark, folder))
    assert rows(valid(out.items, V.ITEM_CODES).select(*ITEM_LAYOUT)) == rows(QUERIES["item_valid"](spark, folder))
    assert rows(out.partners) == rows(QUERIES["new_partners_table"](spark, folder))
    assert out.quarantine.count() == sample.bad_texts(spark, folder).count()


def test_large_lookups_shuffle_no_items(spark, folder, parsed):
    w = World(spark, folder)
    dims = dimensions(w.master, w.settings).limited(0)
    plan = resolve(without_items(xml.readable(parsed)), dims, w.settings, ["filename"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan and "vUnCom" not in plan and "qCom" not in plan


def test_tables_are_cut_down_to_the_keys_of_a_batch(spark, folder, parsed):
    w = World(spark, folder)
    dims = dimensions(w.master, w.settings).limited(50)
    few = parsed.where("NFe.infNFe.ide.nNF < 20")
    cut = dims.reduced(batch_keys(few, w.settings))
    assert cut.partners_by_tax_id.small and 0 < cut.partners_by_tax_id.rows < dims.partners_by_tax_id.rows
    assert cut.products.rows < dims.products.rows and cut.establishments is dims.establishments


def test_items_join_their_documents_as_numbers(spark, folder):
    """With lookup tables too large to broadcast, no join carries the struct of an item; numbered documents are kept."""
    from fiscalmill.operators.items import item_numbers
    from fiscalmill.plans import batch
    from fiscalmill.plans.queries import World
    from fiscalmill.sources import staging, xml
    from tests.test_queries import joined_types

    w, steps, frames = World(spark, folder), [], {}
    parsed = staging.stage(xml.parse_documents(w.texts()).withColumn(batch.ROW, F.monotonically_increasing_id()), "parsed")

    def step(name, make):
        steps.append(name)
        frames[name] = make()
        return staging.stage(frames[name], name)

    outputs = batch.build(parsed, w.master, w.settings, 0, step, broadcast_rows=20)
    assert "numbered" not in steps
    assert not any("imposto" in kind for kind in joined_types(frames["items"]))
    assert outputs.items.count() == w.items.count()
