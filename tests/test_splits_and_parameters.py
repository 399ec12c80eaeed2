import pytest
from pyspark.sql import functions as F

from fiscalmill.plans.queries import World
from fiscalmill.sources import parameters, sample, staging, xml_splits
from tests.conftest import rows


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for name in names:
        spark.conf.set(name, "60")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def doc(root, body, attributes=""):
    return f"<{root}{attributes}><NFe><a>{body}</a></NFe></{root}>"


def found(spark, path):
    return sorted((r["filename"].rsplit("/", 1)[-1], r["text"]) for r in xml_splits.scan_documents(spark, [str(path)]).collect())


FILES = {
    "many.xml": "﻿<?xml version='1.0'?>\n<hierarchy>" + "\n".join(doc(["nfeProc", "cteProc", "cteOSProc"][i % 3], "x" * (i * 7 % 50)) for i in range(40)) + "</hierarchy>\n",
    "one.xml": "<?xml version='1.0'?>" + doc("nfeProc", "é\r\nça <verProc>4.00</verProc> nfeProc 1 &gt; 0", ' versao="4.00"'),
    "long.xml": doc("nfeProc", "<b>word</b>" * 200) + doc("cteProc", "after"),
    "cut.xml": doc("nfeProc", "whole") + "<nfeProc><NFe><a>" + doc("nfeProc", "next") + " <cteProc v='1'><CTe><b>end",
    "other.xml": "<html><body>no document</body></html>",
    "empty.xml": "",
    "blank.xml": " \n\t\n",
}


def wanted():
    out = [("many.xml", doc(["nfeProc", "cteProc", "cteOSProc"][i % 3], "x" * (i * 7 % 50))) for i in range(40)]
    out += [("one.xml", FILES["one.xml"][21:]), ("long.xml", doc("nfeProc", "<b>word</b>" * 200)), ("long.xml", doc("cteProc", "after"))]
    return out + [("cut.xml", doc("nfeProc", "whole")), ("cut.xml", doc("nfeProc", "next"))]


def write(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())


def test_documents_of_whole_files(spark, tmp_path):
    write(tmp_path)
    got = found(spark, tmp_path)
    cut = [("cut.xml", "<nfeProc><NFe><a>"), ("cut.xml", "<cteProc v='1'><CTe><b>end>"), ("other.xml", "<html><body>no document</body></html>")]
    assert [(n, t.rstrip("\n>") if n == "other.xml" else t) for n, t in got] == sorted([*wanted(), *cut[:2], (cut[2][0], cut[2][1].rstrip(">"))])


def test_documents_across_splits(spark, tmp_path, small_splits):
    """Splits of 60 bytes: nearly every document lies on both sides of a cut, some on many splits."""
    write(tmp_path)
    assert spark.read.text(str(tmp_path / "many.xml")).rdd.getNumPartitions() > 20
    got = [x for x in found(spark, tmp_path) if x[0] != "other.xml"]
    whole = [x for x in got if x[1].endswith("Proc>")]
    assert whole == sorted(wanted())
    cut = sorted(t for n, t in got if (n, t) not in set(whole))
    assert len(cut) == 2 and cut[0].startswith("<cteProc v='1'><CTe><b>end") and cut[1].startswith("<nfeProc><NFe><a>")


def test_a_file_of_many_documents_goes_to_several_tasks(spark, folder, tmp_path, small_splits):
    texts = World(spark, folder).texts().where("doc_key < 400").select(F.regexp_replace("text", "\n *", "").alias("text"))
    texts.coalesce(1).write.option("lineSep", " ").text(str(tmp_path / "in"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    docs = xml_splits.scan_documents(spark, [str(tmp_path / "in")])
    plain = lambda df: rows(df.select(F.replace("text", F.lit("﻿"), F.lit("")).alias("text")))
    assert docs.rdd.getNumPartitions() > 4 and plain(docs) == plain(texts)


# Parameters


def table(spark, path):
    return rows(parameters.read(spark, path))


def test_replacing_a_group_leaves_the_others(spark, folder, tmp_path):
    w, path = World(spark, folder), str(tmp_path / "p")
    details = w.master.details.unionByName(spark.sql("select 999999L as ID_PARAM_DET, cast(null as bigint) as ID_PARAMETRO, 'n' as NOME_PARAM, 'c' as CONTEUDO, 'd' as DESCRICAO, 'v' as VALOR"))
    parameters.store(details, path)
    assert table(spark, path) == rows(details)
    mapping = sample.product_mapping(w.table("part"), w.settings)
    files = lambda group: sorted(p.name for p in (tmp_path / "p" / f"ID_PARAMETRO={group}").iterdir())
    others = files(2), files(parameters.NO_GROUP)
    parameters.replace(spark, path, w.master.heads, mapping, w.settings)
    once = table(spark, path)
    parameters.replace(spark, path, w.master.heads, mapping.repartition(5), w.settings)
    assert table(spark, path) == once and (files(2), files(parameters.NO_GROUP)) == others
    found = parameters.read(spark, path)
    assert found.where("ID_PARAMETRO = 1").count() == mapping.count()
    assert found.select("ID_PARAM_DET").distinct().count() == found.count()
    assert found.where("ID_PARAMETRO = 1").agg(F.min("ID_PARAM_DET")).first()[0] == 1_000_000


def test_an_empty_mapping_and_an_unknown_group(spark, folder, tmp_path):
    w, path = World(spark, folder), str(tmp_path / "p")
    parameters.store(w.master.details, path)
    mapping = sample.product_mapping(w.table("part"), w.settings)
    parameters.replace(spark, path, w.master.heads, mapping.where("false"), w.settings)
    assert table(spark, path) == rows(w.master.details.where("ID_PARAMETRO <> 1"))
    with pytest.raises(ValueError):
        parameters.replace(spark, path, w.master.heads.where("false"), mapping, w.settings)
    assert not staging.exists(spark, f"{path}/ID_PARAMETRO=1")


def test_files_are_scanned_once(spark, tmp_path, monkeypatch):
    write(tmp_path)
    scans, scan = [], xml_splits._scan
    monkeypatch.setattr(xml_splits, "_scan", lambda *a: scans.append(scan(*a)) or scans[-1])
    docs = xml_splits.scan_documents(spark, [str(tmp_path)])
    assert len(scans) == 1 and "MapInArrow" not in docs._jdf.queryExecution().optimizedPlan().toString()
