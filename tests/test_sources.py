import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalmill.functions import expr as E
from fiscalmill.operators.items import explode_items
from fiscalmill.sources import sample, schema, sinks, staging, tables, xml
from tests.conftest import rows

GOODS = (
    '<?xml version="1.0"?><nfeProc versao="4.00"><NFe><infNFe Id="NFe1"><ide><nNF>7</nNF><mod>55</mod></ide>'
    '<emit><xNome>Inacte CTe</xNome></emit><det nItem="1"><prod><CFOP>5101</CFOP><vProd>12.30</vProd></prod></det>'
    "</infNFe></NFe></nfeProc>"
)
FREIGHT = (
    "\ufeff<cteOSProc versao='3.00'><CTeOS><infCte><ide><nCT>8</nCT><mod>67</mod></ide></infCte></CTeOS>"
    "<protCTe><infProt><chCTe>35</chCTe></infProt></protCTe></cteOSProc>"
)


def texts(spark, *values):
    data = [(f"file:///in/{i}.xml", v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "filename string, text string")


def test_both_families_share_one_vocabulary(spark):
    docs = xml.parse_documents(texts(spark, GOODS, FREIGHT)).orderBy("filename").collect()
    goods, freight = docs
    assert goods["NFe"]["infNFe"]["ide"]["nNF"] == "7"
    assert goods["NFe"]["infNFe"]["emit"]["xNome"] == "Inacte CTe"
    assert goods["NFe"]["infNFe"]["det"][0]["_nItem"] == "1"
    assert freight["NFe"]["infNFe"]["ide"]["nCT"] == "8"
    assert freight["protNFe"]["infProt"]["chNFe"] == "35"


def test_words_inside_data_stay(spark):
    kept = "<cteProc><CTe a='CTe'>cte CTe infCte</CTe></cteProc>"
    out = spark.range(1).select(xml.unify_tags(F.lit(kept))).first()[0]
    assert out == "<nfeProc><NFe a='CTe'>cte CTe infCte</NFe></nfeProc>"


def test_quarantine_reasons(spark):
    df = xml.parse_documents(texts(spark, GOODS, "<nfeProc><other/></nfeProc>", "<nfeProc><NFe>", "junk"))
    assert rows(xml.quarantined(df)) == [("1.xml", "no_document"), ("2.xml", "malformed"), ("3.xml", "malformed")]
    assert xml.readable(df).count() == 1


def test_several_documents_in_one_text(spark):
    df = xml.split_documents(texts(spark, GOODS + FREIGHT, "junk"))
    assert df.groupBy("filename").count().orderBy("filename").collect()[0]["count"] == 2
    assert df.count() == 3


def test_items_explode_and_empty_documents_drop(spark):
    none = GOODS[: GOODS.index("<det")] + "</infNFe></NFe></nfeProc>"
    items = explode_items(xml.parse_documents(texts(spark, GOODS, none)))
    assert [r["item"]["prod"]["CFOP"] for r in items.collect()] == ["5101"]


def test_native_scan_has_lineage(spark, tmp_path):
    (tmp_path / "a.xml").write_text(GOODS)
    (tmp_path / "b.xml").write_text(GOODS.replace("<nNF>7", "<nNF>9"))
    docs = xml.scan_files(spark, [str(tmp_path / "a.xml"), str(tmp_path / "b.xml")])
    found = docs.select(xml.base_name(F.col("filename")), E.doc("ide.nNF")).collect()
    assert sorted(map(tuple, found)) == [("a.xml", "7"), ("b.xml", "9")]


def test_undecodable_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(GOODS.encode().replace(b"Inacte", b"In\xffcte"))
    docs = xml.parse_documents(xml.read_text_documents(spark, [str(tmp_path)]))
    assert docs.select(E.doc("emit.xNome")).first()[0] == "In�cte CTe"


def test_sample_documents_have_the_schema_of_parsed_ones(spark, folder):
    def shape(t):
        if isinstance(t, T.StructType):
            return {f.name: shape(f.dataType) for f in t.fields}
        return [shape(t.elementType)] if isinstance(t, T.ArrayType) else t.simpleString()

    want = shape(schema.document_schema())
    docs = sample.full_documents(spark, folder)
    assert shape(docs.schema["NFe"].dataType) == want["NFe"]
    assert shape(docs.schema["protNFe"].dataType) == want["protNFe"]


def test_long_orders_become_several_documents(spark, folder):
    whole = sample.full_documents(spark, folder)
    items = whole.select("doc_key", F.explode("NFe.infNFe.det").alias("i")).groupBy("doc_key").count()
    limit, sample.MAX_ITEMS = sample.MAX_ITEMS, 2
    try:
        split = sample.full_documents(spark, folder)
        assert split.agg(F.max(F.size("NFe.infNFe.det"))).first()[0] == 2
        again = split.select("doc_key", F.explode("NFe.infNFe.det").alias("i")).groupBy("doc_key").count()
        assert rows(items) == rows(again)
        salted = sample.full_documents(spark, folder, hot_rows=3)
        assert rows(split.groupBy("doc_key").count()) == rows(salted.groupBy("doc_key").count())
    finally:
        sample.MAX_ITEMS = limit


def test_schema_json_round_trip(tmp_path):
    path = str(tmp_path / "schema.json")
    schema.save_schema(schema.document_schema(), path)
    assert schema.load_schema(path) == schema.document_schema()


def test_merge_keeps_everything_known():
    known = T.StructType.fromDDL("a struct<X: string, n: decimal(10,2)>, list array<struct<q: int>>, keep string")
    found = T.StructType.fromDDL("A struct<x: bigint, n: double, extra: date>, list struct<r: string>, more string")
    merged = schema.merge_schemas(known, found)
    assert merged.simpleString() == T.StructType.fromDDL(
        "a struct<X: string, n: decimal(10,2), extra: date>, list array<struct<q: int, r: string>>, "
        "keep string, more string"
    ).simpleString()


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("int", "double", "double"),
        ("date", "int", "string"),
        ("string", "struct<a: int>", "struct<a: int>"),
        ("array<int>", "bigint", "array<bigint>"),
    ],
)
def test_widest(a, b, want):
    def parsed(t):
        return T.StructType.fromDDL(f"c {t}")["c"].dataType

    assert schema.widest(parsed(a), parsed(b)) == parsed(want)


def test_inferred_fields_extend_the_known_schema(spark, tmp_path):
    (tmp_path / "a.xml").write_text(GOODS.replace("<mod>", "<novo>1</novo><mod>"))
    merged = schema.merge_schemas(schema.document_schema(), xml.infer_schema(spark, [str(tmp_path)]))
    paths = {r["path"] for r in schema.schema_paths(spark, merged).collect()}
    known = {r["path"] for r in schema.schema_paths(spark, schema.document_schema()).collect()}
    assert known < paths and "NFe.infNFe.ide.novo" in paths


def test_publish_by_name_and_rerun(spark, tmp_path):
    target = sinks.FileTarget(str(tmp_path / "t"))
    df = spark.createDataFrame([("x", "y")], "B string, IDENT string")
    for _ in range(2):
        sinks.publish(df, ["IND", "B"], target, "1", {"IDENT": "IND"})
    sinks.publish(df, ["IND", "B"], target, "2", {"IDENT": "IND"})
    assert rows(target.read(spark)) == [("x", "y", "1"), ("x", "y", "2")]


def test_csv_keeps_missing_and_empty_apart(spark, tmp_path):
    df = spark.createDataFrame([("", None), (None, "007"), ('a"b', "x,y")], "a string, b string")
    assert rows(sinks.csv_round_trip(df, str(tmp_path / "c"))) == rows(df)


def test_run_ids_stay_strings_and_an_empty_rerun_leaves_nothing(spark, tmp_path):
    target = sinks.FileTarget(str(tmp_path / "t"))
    df = spark.createDataFrame([("x",)], "A string")
    target.write(df.limit(0), "007")
    assert target.read(spark).count() == 0
    target.write(df, "007")
    target.write(df, "8")
    assert rows(target.read(spark)) == [("x", "007"), ("x", "8")]
    target.write(df.limit(0), "007")
    assert rows(target.read(spark)) == [("x", "8")]


def test_error_list_is_replaced(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "A string")
    for rows_now in (df, df, df.limit(0)):
        sinks.write_csv(rows_now, str(tmp_path / "e"))
        assert sinks.read_csv(spark, str(tmp_path / "e"), df).count() == rows_now.count()


def test_counter_by_run(spark, tmp_path):
    """A first run starts at the seed, a new one after all others, a repeated one where it started before."""
    path, one = str(tmp_path / "n"), spark.createDataFrame([(17,)], "NUM_DOCTO long")
    assert sinks.read_counter(spark, path, "007", seed=5) == 5
    sinks.save_counter(one, path, "007", 5)
    assert sinks.read_counter(spark, path, "007") == 5
    assert sinks.read_counter(spark, path, "8") == 17
    sinks.save_counter(one.selectExpr("NUM_DOCTO + 3 as NUM_DOCTO"), path, "8", 17)
    sinks.save_counter(one, path, "007", 5)
    assert sinks.read_counter(spark, path, "9") == 20


def test_a_failed_counter_write_loses_nothing(spark, tmp_path):
    path, one = str(tmp_path / "n"), spark.createDataFrame([(17,)], "NUM_DOCTO long")
    sinks.save_counter(one, path, "1", 5)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|divi"):
        sinks.save_counter(one.selectExpr("NUM_DOCTO div 0 as NUM_DOCTO"), path, "2", 17)
    assert sinks.read_counter(spark, path, "2") == 17


def test_partitioned_database_reads_need_bounds(spark):
    with pytest.raises(ValueError):
        tables.read_jdbc(spark, "jdbc:none", "select 1", partition_column="id")


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        staging.shared_folder(Cluster())


def test_local_runs_without_a_folder_get_one():
    class Local:
        conf = type("Conf", (), {"get": lambda *_: None})()

        class sparkContext:
            master = "local[2]"
            folder = None

            @classmethod
            def getCheckpointDir(cls):
                return cls.folder

            @classmethod
            def setCheckpointDir(cls, folder):
                cls.folder = folder

    session = Local()
    first = staging.shared_folder(session)
    assert first and staging.shared_folder(session) == first


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while files.hasNext():
        names.append(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_of_a_staged_frame_are_removed(spark):
    before = shuffle_files(spark)
    staged = staging.stage(spark.range(1000).repartition(3, "id"), "numbers")
    for _ in range(100):  # they are removed beside the work
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert staged.count() == 1000
    assert spark.conf.get(staging.SHUFFLE_CLEANUP) == "false"


def test_written_xml_is_packed(spark, folder, tmp_path):
    docs = sample.heads(spark, folder).limit(40)
    path, lines = str(tmp_path / "files"), str(tmp_path / "lines")
    xml.write_files(docs, path)
    xml.write_lines(sample.xml_texts(docs).select(F.regexp_replace("text", "\n *", "").alias("value")), lines)
    for folder in (tmp_path / "files", tmp_path / "lines"):
        assert {p.suffix for p in folder.glob("part-*")} == {".gz"}
    assert xml.readable(xml.scan_files(spark, [path])).count() == 40
    assert xml.split_documents(xml.read_text_documents(spark, [lines], whole_files=False)).count() == 40
