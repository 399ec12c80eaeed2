"""Texts that are made, dealt, cut and joined in larger portions."""

import pyarrow as pa
from pyspark.sql import functions as F

from fiscalmill.plans import queries
from fiscalmill.sources import sample, staging, xml, xml_splits


def test_arrivals_read_every_staged_file_once(spark, monkeypatch):
    texts = staging.stage(spark.range(400).select(F.concat(F.lit("text "), "id").alias("text")).repartition(6), "texts")
    monkeypatch.setattr(queries, "ARRIVAL_DOCUMENTS", 100)
    parts = queries.arrivals(texts, 400)
    files = [f for part in parts for f in part.inputFiles()]
    assert len(parts) == 4 and sorted(files) == sorted(texts.inputFiles())
    assert sorted(r["text"] for part in parts for r in part.collect()) == sorted(r["text"] for r in texts.collect())


def pieces(*records, size=1000):
    """What one file of some records gives, in batches of `size` records."""
    columns = {"value": list(records), "filename": ["f" if "Proc" in r else None for r in records]}
    rows = pa.RecordBatch.from_pydict(
        columns | {"file": [7] * len(records), "block": [0] * len(records), "first": [True] * len(records), "last": [True] * len(records)},
        pa.schema({"value": "string", "filename": "string", "file": "int64", "block": "int64", "first": "bool", "last": "bool"}),
    )
    batches = [rows.slice(a, size) for a in range(0, len(records), size)]
    return [(r["kind"], r["text"]) for out in xml_splits._pieces(iter(batches)) for r in out.to_pylist()]


def test_records_are_joined_as_they_lie_in_a_batch():
    documents = ["<nfeProc><NFe>Proc</NFe></nfeProc>", "<cteOSProc a='1'><x/></cteOSProc >", "<cteProc><y>z</y></cteProc>"]
    text = "junk" + documents[0] + documents[1] + " " + documents[2] + "<nfeProc><cut>"
    for size in (1, 2, 3, 1000):
        found = pieces(*text.split(">")[:-1], size=size)
        assert [t for _, t in found] == [*documents, "<nfeProc><cut>"]


def test_one_document_is_told_by_plain_searches(spark):
    one, other = "<nfeProc><NFe>ação</NFe></nfeProc>", "<cteOSProc v='1'><CTe>Proc</CTe></cteOSProc>"
    prolog = '<?xml version="1.0"?>'
    given = {
        one: [one], other: [other], "junk": ["junk"], "": [""], one + other: [one, other], "﻿" + one: [one],
        prolog + one: [one], prolog + "\n" + one: [one], "﻿" + prolog + one + prolog + one: [one + prolog, one],
        "<nfeProc><nfeProc>": ["<nfeProc>", "<nfeProc>"], one + " tail": [one + " tail"], "<nfeProcX></nfeProcX>" + one: [one],
        "<?xml " + one: [one],
    }
    df = spark.createDataFrame([(t,) for t in given], "text string")
    found = xml.split_documents(df.select("text", F.col("text").alias("whole"))).collect()
    assert {w: sorted(r["text"] for r in found if r["whole"] == w) for w in given} == {w: sorted(t) for w, t in given.items()}


def test_sample_texts_are_not_indented(spark, folder):
    texts = sample.xml_texts(sample.full_documents(spark, folder))
    assert texts.where(F.col("text").contains("\n")).isEmpty()


def test_landed_texts_of_the_intake_are_packed(spark, folder, tmp_path, monkeypatch):
    landed = []
    monkeypatch.setattr(queries.staging, "new_folder", lambda spark, name: landed.append(name) or f"{tmp_path}/{name}-{len(landed)}")
    rows = queries.new_files_only(spark, folder).collect()
    landing = next(tmp_path.glob("landing-*"))
    files = [f.name for f in landing.iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert len(list(tmp_path.glob("texts-*"))) == 1
    assert sum(r["documents"] for r in rows) == 1500


def test_prices_of_a_run_from_text_are_broadcast_no_further_than_other_tables(spark, folder, monkeypatch):
    asked = []
    lookup = sample.left_lookup

    def watched(left, table, *more, **named):
        asked.append(table.broadcast_rows)
        return lookup(left, table, *more, **named)

    monkeypatch.setattr(sample, "left_lookup", watched)
    queries.batch_outputs(spark, folder)
    assert asked and max(asked) <= 200_000
    few, all_ = sample.goods_lines(spark, folder, price_rows=10), sample.goods_lines(spark, folder)
    assert max(asked) == sample.PRICE_ROWS
    assert sorted(map(repr, few.collect())) == sorted(map(repr, all_.collect()))
