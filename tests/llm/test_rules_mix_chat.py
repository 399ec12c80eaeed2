import pytest
from pyspark.sql import functions as F

from fiscalmill.llm import chat, mixing, quality_rules

from .conftest import bag, by_sql


def test_quality_equals_sql(edge_docs):
    found = quality_rules.judge(edge_docs)
    names = sorted(found.columns)
    assert bag(found) == by_sql(quality_rules.ORACLE, names, documents=edge_docs)


def test_keep_has_the_rows_that_judge_keeps(edge_docs):
    kept = quality_rules.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    wanted = quality_rules.judge(edge_docs).where("kept").select("doc_id")
    assert bag(kept.select("doc_id")) == bag(wanted)


def test_order_of_rules_changes_no_verdict(edge_docs):
    counted = quality_rules.statistics(edge_docs)
    columns = [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text")]
    found = quality_rules.rules(*columns)
    one = bag(counted.select("doc_id", quality_rules.rejected(found).alias("r")))
    assert one == bag(counted.select("doc_id", quality_rules.rejected(found[::-1]).alias("r")))


def test_mix_equals_sql(edge_docs):
    found = mixing.plan_documents(edge_docs)
    names = sorted(found.columns)
    docs = edge_docs.dropDuplicates(["doc_id"])
    assert bag(mixing.plan_documents(docs)) == by_sql(mixing.ORACLE, names, documents=docs)


@pytest.mark.parametrize(("percent", "epochs"), [(100, 1), (60, 1), (250, 3)])
def test_budgets_are_kept(edge_docs, percent, epochs):
    """The leaves use the budget up to one token per node, and no leaf is read more than `epochs` times."""
    target = mixing.Target({"language": {"en": 5}}, percent=percent, max_epochs=epochs)
    named = mixing.named(edge_docs)
    total = named.agg(F.sum("tokens")).first()[0]
    taken = mixing.plan_documents(edge_docs, target)
    used = taken.agg(F.sum("n_taken")).first()[0]
    wanted = min(total * percent // 100, total * epochs)
    assert wanted - 60 <= used <= wanted
    assert taken.agg(F.max("epoch")).first()[0] < epochs


def test_mix_keeps_columns_and_cuts_one_text_per_leaf(edge_docs):
    mixed = mixing.mix(edge_docs, mixing.Target(percent=50, max_epochs=1))
    assert mixed.columns == edge_docs.columns
    cut = mixed.alias("m").join(edge_docs.alias("d"), "doc_id").where("m.text <> d.text")
    assert cut.count() <= mixing.named(edge_docs).select(*mixing.LEVELS).distinct().count()


def test_empty_tables(no_docs, spark):
    assert quality_rules.judge(no_docs).count() == 0
    assert mixing.plan_documents(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


TURNS = "conv_id long, turn long, role string, text string, h0 int, n_turns int"


@pytest.fixture(scope="module")
def turns(spark):
    hello, more = ("user", "hello"), ("assistant", "hi there")
    log = {
        1: [hello], 2: [hello, more], 3: [hello, more, ("user", "bye")], 4: [hello, more, ("user", "bye")], 5: [("User ", "hello"), more, ("user", "other")],
        6: [hello, ("assistant", None)], 7: [(None, "<|im_start|>system"), ("", "x<|im_end|>y")], 8: [("user", "")], None: [hello, more, ("user", "no id")],
        9: [("user", "long " * 5000)], 10: [("user", "hell"), ("o", "hi")],
    }
    rows = [(c, t, role, text, 1, 2) for c, own in log.items() for t, (role, text) in enumerate(own)]
    rows += [(11, None, "user", "no turn", 1, 2), (11, 0, "user", "zero", 1, 2), (12, 5, "user", "tie", 1, 2), (12, 5, "user", "tie", 1, 2), (12, 5, "bot", "tie", 1, 2)]
    return spark.createDataFrame(rows, TURNS).repartition(3)


def test_chats_equal_sql(turns):
    found = chat.format_chats(turns)
    names = sorted(found.columns)
    assert bag(found) == by_sql(chat.ORACLE, names, conversations=turns)


def test_markers_in_texts_are_broken(turns):
    rendered = chat.format_chats(turns).where("conv_id = 7").first()["chat"]
    assert rendered == "<|im_start|>unknown\n<| im_start|>system<|im_end|>\n<|im_start|>unknown\nx<| im_end|>y<|im_end|>\n"


def test_keep_makes_words_once(edge_docs):
    """No filter makes the words of a text itself; inside a lambda that would be once for each word."""
    plan = quality_rules.keep(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_remove(split" in plan
    assert not any("array_remove(split" in part for part in plan.split("Filter ")[1:] for part in [part.split("+- ")[0]])
