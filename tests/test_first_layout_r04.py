"""The first layout moves numbers and resolved documents between tasks, and no digits or items that are not needed there."""

from fiscalmill.operators.lookup import Lookup
from fiscalmill.plans import queries, variants
from fiscalmill.plans.queries import KEY, World
from fiscalmill.sources import sample

from .conftest import rows


def test_invoices_resolved_before_their_items_join_are_the_same(spark, folder):
    w = World(spark, folder)
    before = variants.first_resolved(w.docs, w.staged_dims, w.settings, KEY)
    _, resolved, _ = queries.first_layout(spark, folder)
    columns = ["doc_key", "COD_EMPRESA", "COD_ESTAB", "COD_FIS_JUR", "_kind"]
    assert rows(resolved.selectExpr(*columns, "to_json(NFe) as d")) == rows(before.selectExpr(*columns, "to_json(NFe) as d"))


def test_digits_are_made_behind_the_lookups(spark, folder, monkeypatch):
    moved = []
    lookup = variants.left_lookup

    def watched(left, *more, **named):
        moved.append(set(left.columns))
        return lookup(left, *more, **named)

    w, resolved, _ = queries.first_layout(spark, folder)
    products = variants.first_product_map(w.master.details, w.master.heads, w.master.products, w.master.units, w.settings)
    monkeypatch.setattr(variants, "left_lookup", watched)
    items = variants.first_items(resolved, w.staged_dims, Lookup(products), sample.SETTINGS, KEY)
    made = {"QUANTIDADE", "VLR_UNIT", "VLR_ITEM", "BASE_ICMS", "BASE_IPI", "VLR_CONTAB_ITEM", "VLR_DESCONTO", "NUM_DOCFIS"}
    assert moved and not any(made & columns for columns in moved)
    assert made <= set(items.columns) and items.where("length(VLR_ITEM) <> 15").isEmpty()
