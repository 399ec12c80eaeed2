import zlib

import numpy as np
import pytest

from fiscalmill.llm import bit_sliced, quality_classifier

from .conftest import bag, by_sql

VECTORS = "vec_id long, embedding array<float>, label int, block int, score long"


def test_top_k_equals_sql(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=8)], 0, 1, 2) for i in range(0, 330)]
    rows += [(i, rows[5][1], 0, 1, 2) for i in (400, 401, 402)] + [(7, rows[9][1], 0, 1, 2)]  # ties; an id that comes again
    rows += [(500, None, 0, 1, 2), (501, [1.0, None] + [0.0] * 6, 0, 1, 2), (502, [float("nan")] * 8, 0, 1, 2), (503, [float("inf")] * 8, 0, 1, 2)]
    rows += [(None, rows[0][1], 0, 1, 2), (600, [0.0] * 8, 0, 1, 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    vectors = bit_sliced.quantised(df)
    found = bit_sliced.top_k(vectors, vectors.where("vec_id % 100 = 0"))
    assert bag(found) == by_sql(bit_sliced.ORACLE, sorted(found.columns), embeddings=df)


def test_other_lengths_are_no_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, [3.0, -1.0]), (3, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = bit_sliced.quantised(df)
    found = bit_sliced.top_k(vectors, vectors.where("vec_id = 0")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 2, 1024 * 3072 - 2048 * 1024)]
    assert bit_sliced.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("low", [-5, -3000])
def test_sliced_sum_bounds_every_score(low):
    """Bit-sliced sums differ from the scores by a constant and at most the bound."""
    r = np.random.default_rng(1)
    values = r.integers(low, 3000, (200, 6)).astype(np.int32)
    queries = r.integers(-900, 900, (4, 6)).astype(np.int64)
    slices, lows, width, cut = bit_sliced.slices_of(values)
    total = bit_sliced.sliced_scores(slices, width, cut, queries)
    bits = np.unpackbits(total.view(np.uint8).reshape(*total.shape[:2], -1), axis=-1, bitorder="little")[:, :, :200].astype(np.int64)
    sums = (bits << np.arange(total.shape[1])[None, :, None]).sum(axis=1)
    bounds = (np.abs(queries) * ((1 << cut) - 1)).sum(axis=1)
    difference = queries @ values.T.astype(np.int64) - sums
    for q in range(4):
        assert difference[q].max() - difference[q].min() <= bounds[q]


def test_held_out_accuracy(spark, folder):
    docs, labels = (spark.read.parquet(folder.replace("sf0.001", "sf0.01") + f"/{t}.parquet") for t in ("documents", "labels"))
    found = {r["doc_id"]: r for r in quality_classifier.classify(docs, labels).collect()}
    known = [(found[r["doc_id"]], r["quality"]) for r in labels.collect()]
    held = [(r, q) for r, q in known if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert len(held) > 30 and sum(r["predicted"] == q for r, q in held) / len(held) > 0.95


def test_classifier_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0, 1.0) for i in range(1, 20)] + [(None, 1, 0, 1.0), (3, None, 0, 1.0), (4, 7, 0, 1.0)], "doc_id long, quality int, toxic int, x double")
    found = quality_classifier.classify(edge_docs, labels).collect()
    assert len(found) == edge_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    one_class = quality_classifier.classify(edge_docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in one_class}) == 1
    assert quality_classifier.classify(no_docs, labels).count() == 0
    assert {r["score"] for r in quality_classifier.classify(edge_docs, labels.limit(0)).collect()} == {0.5}


def test_large_components_are_scored_exactly(spark):
    """Components beyond 32 bits, products beyond 64 bits, and a sum that only whole numbers get right."""
    big, small = 3_000_000.0, 0.5
    data = [(0, [1.0, 0.0]), (1, [big, 0.0]), (2, [big + 1e6, 0.0]), (3, [big - 5e5, 0.0]), (4, [-big, small])]
    wide = [(100, [2.0**45, 2.0**45]), (5, [2.0**44, -(2.0**44)]), (6, [2.0**44, -(2.0**44) + 2**10])]
    df = spark.createDataFrame(data + wide, "vec_id long, embedding array<double>")
    vectors = bit_sliced.quantised(df)
    found = bit_sliced.top_k(vectors, vectors.where("vec_id % 100 = 0")).collect()
    whole = {i: [int(1024 * x) for x in v] for i, v in data + wide}
    for query in (0, 100):
        scores = {i: sum(a * b for a, b in zip(v, whole[query], strict=True)) for i, v in whole.items() if i != query}
        wanted = sorted(scores, key=lambda i: (-scores[i], i))[:10]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        fits = lambda s: s if -(1 << 63) <= s < 1 << 63 else None
        assert got == [(n + 1, i, fits(scores[i])) for n, i in enumerate(wanted)]
