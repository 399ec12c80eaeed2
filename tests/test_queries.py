from collections import Counter
from math import ceil
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from fiscalmill import session
from fiscalmill.plans.queries import QUERIES, World
from fiscalmill.sources import staging

TABLES = "region nation customer supplier part orders lineitem".split()
CHECKED = sorted(set(entry.QUERIES) & set(entry.oracle_queries.ORACLES))


@pytest.fixture(scope="module")
def database(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, folder, database, name):
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    found = Counter(tuple(r[c] for c in columns) for r in df.collect())
    result = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert found == wanted


def test_every_query_but_the_schema_has_sql():
    assert set(entry.QUERIES) - set(entry.oracle_sql()) == {"schema_merge"}


def test_header_sums_equal_item_sums(spark, folder):
    """Sums of all matched headers are the sums of their items; nothing is lost or doubled.

    Persons' notes are left out: their headers carry zeros while their freight items keep the price.
    """
    from pyspark.sql import functions as F

    from fiscalmill.plans.queries import World

    w = World(spark, folder)
    regular = w.open_headers.where(F.col("IND_NF_REG_ESPECIAL").isNull() & F.col("COD_ESTAB").isNotNull())
    headers = regular.agg(F.sum(F.col("BASE_OUTR_IPI").cast("decimal(20,0)")) / 100).first()[0]
    items = w.items.join(regular.select("doc_key"), "doc_key", "left_semi").agg(F.sum("_base_amount")).first()[0]
    assert float(headers) == float(items)


def joined_types(df):
    """Types of all columns that a join below the frame gives."""
    found, todo = set(), [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "Join" in node.nodeName():
            found |= {node.output().apply(i).dataType().simpleString() for i in range(node.output().size())}
    return found


def test_joins_of_documents_move_no_items(spark, folder):
    """Lines are joined as narrow rows; items are made of them where their document is."""
    from fiscalmill.sources import sample

    kinds = joined_types(sample.full_documents(spark, folder))
    assert kinds and not any("imposto" in k for k in kinds)


def test_sums_need_only_repeated_products(spark, folder):
    from fiscalmill.operators import items as I
    from fiscalmill.plans.queries import World
    from tests.conftest import rows

    w = World(spark, folder)
    assert w.staged_dims.counting().products.rows < w.staged_dims.products.rows
    assert rows(w.sums) == rows(I.item_sums(w.items))


def test_lines_are_counted_without_their_prices(spark, folder, monkeypatch):
    """Hot keys of lines are counted over the table, so the prices are not looked up a second time for it."""
    from fiscalmill.operators import lookup
    from fiscalmill.sources import sample

    counted = []
    monkeypatch.setattr(lookup, "hot_keys_if_any", lambda df, keys, hot_rows: counted.append((df, keys)))
    lines = sample._packed_lines(spark, folder, hot_rows=100)
    assert [keys for _, keys in counted] == [["doc_key"]]
    assert "Join" not in counted[0][0]._jdf.queryExecution().optimizedPlan().toString()
    assert sum(len(r["_lines"]) for r in lines.collect()) == counted[0][0].count()


def test_quarantine_stages_no_documents(spark, folder, monkeypatch):
    """What a text is quarantined for is found without writing the documents that are fine."""
    from fiscalmill.sources import sample, staging, xml
    from tests.conftest import rows

    staged, stage = [], staging.stage
    monkeypatch.setattr(staging, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    found = rows(entry.queries()["xml_quarantine"](spark, folder))
    assert [df.columns for df in staged if "NFe" in df.columns] == []
    texts = World(spark, folder).texts().unionByName(sample.bad_texts(spark, folder))
    assert found == rows(xml.quarantined(xml.parse_documents(texts)))


def written_frames(monkeypatch):
    """(source plan, options, path) of nothing but texts that are written from now on."""
    from pyspark.sql import DataFrameWriter

    seen, text = [], DataFrameWriter.text

    def noted(writer, path, *args, **kwargs):
        text(writer, path, *args, **kwargs)
        seen.append(path)

    monkeypatch.setattr(DataFrameWriter, "text", noted)
    return seen


@pytest.mark.parametrize("name", ["ingest_log", "stream_import"])
def test_landing_texts_are_packed_and_made_once(spark, folder, monkeypatch, name):
    from fiscalmill.sources import sample, staging

    landings, made, documents = written_frames(monkeypatch), [], sample.full_documents
    monkeypatch.setattr(sample, "full_documents", lambda *a, **k: made.append(a) or documents(*a, **k))
    entry.queries()[name](spark, folder)
    for landing in landings:
        files, at = staging.file_system(spark, landing)
        names = [f.getPath().getName() for f in files.listStatus(at)]
        assert len([n for n in names if n.endswith(".txt.gz")]) > 1 and not [n for n in names if n.endswith(".txt")]
    assert landings and len(made) == 1


def test_parts_of_a_split_scan_lose_nothing_and_go(spark, folder, monkeypatch):
    from fiscalmill.plans import queries
    from fiscalmill.sources import staging
    from tests.conftest import rows

    once = rows(entry.queries()["split_scan"](spark, folder))
    monkeypatch.setattr(queries, "ARRIVAL_DOCUMENTS", 600)
    landings = written_frames(monkeypatch)
    assert rows(entry.queries()["split_scan"](spark, folder)) == once
    assert len(landings) > 1 and not any(staging.exists(spark, landing) for landing in landings)


def test_shuffles_are_dealt_by_the_size_of_the_input(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "INPUT_BYTES", 500)
    large = sum(staging.bytes_of(spark, f"{folder}/{name}.parquet") for name in ("orders", "lineitem"))
    assert large == sum(Path(folder, f"{name}.parquet").stat().st_size for name in ("orders", "lineitem"))
    QUERIES["doc_number"](spark, folder)
    assert spark.conf.get(session.INITIAL_PARTITIONS) == str(ceil(large / 500))
    assert int(spark.conf.get(session.ADVISED).rstrip("b")) <= session.TASK_BYTES
    session.tune(spark)
    assert spark.conf.get(session.INITIAL_PARTITIONS) == str(ceil(large / 500))
    monkeypatch.undo()
    QUERIES["doc_number"](spark, folder)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    assert staging.bytes_of(spark, f"{folder}/nothing.parquet") == 0


def test_partitions_that_are_not_joined_are_dealt_by_size_too(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "INPUT_BYTES", 500)
    large = sum(Path(folder, f"{name}.parquet").stat().st_size for name in ("orders", "lineitem"))
    own = spark.conf.get(session.PARTITIONS)
    joined = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joined, False)
    try:
        for _ in range(2):
            QUERIES["doc_number"](spark, folder)
            assert spark.conf.get(session.PARTITIONS) == str(ceil(large / 500))
        monkeypatch.undo()
        QUERIES["doc_number"](spark, folder)
        assert spark.conf.get(session.PARTITIONS) == own
    finally:
        spark.conf.unset(joined)
    assert int(spark.conf.get(session.SPLIT_BYTES).rstrip("b")) <= session.TASK_BYTES
