import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fiscalmill.llm import importance, regular_sampling, simhash, whitening, word_runs

from .conftest import bag, by_sql, invented

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# SimHash


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """Rows (id, fingerprint) to (id, hex, smallest id of the component), all pairs compared."""
    label = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 2:
                label = [label[j] if x == label[i] else x for x in label]
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[label[i]] = min(low.get(label[i], doc_id), doc_id)
    return Counter((doc_id, format(f, "016x"), low.get(label[i])) for i, (doc_id, f) in enumerate(rows))


def test_simhash_groups_against_brute_force(spark, edge_docs, no_docs):
    words = invented(70, 40)
    more = [(1000 + i, " ".join([*words[:i], "X", *words[i + 1 :]]) * 3) for i in range(40)]
    more += [(5, "another text under a used id"), (None, "one"), (None, None)] + [(2000, words[0])] * 30
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    found = simhash.groups(docs.repartition(5))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, found.collect())) == brute_groups(rows)
    assert simhash.groups(no_docs).count() == 0


@pytest.mark.parametrize("short", [1, simhash.SHORT_LIST])
def test_links_join_all_close_fingerprints(spark, monkeypatch, short):
    """A ball of neighbours, chains of two bits a step, the ends of the number range, and others: both ways through a list."""
    monkeypatch.setattr(simhash, "SHORT_LIST", short)
    r = np.random.default_rng(3)
    centre = int(r.integers(0, 1 << 63))
    ball = [centre ^ (1 << int(i)) ^ (1 << int(j)) for i, j in r.integers(0, 64, (300, 2))]
    chain = [sum(3 << (2 * i) for i in range(n)) for n in range(33)]
    dense = [(7 << 60) + int(x) for x in r.integers(0, 1 << 16, 200)]
    prints = {*ball, *chain, *dense, (1 << 64) - 1, 1 << 63, 1, 0, *map(int, r.integers(0, 1 << 63, 100))}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long").repartition(7)).collect()
    label = {p: p for p in signed}
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = {k: new if v == old else v for k, v in label.items()}
    joined = {p: p for p in signed}
    for a, b in found:
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() >= 1 and label[a] == label[b]
        old, new = joined[a], joined[b]
        joined = {k: new if v == old else v for k, v in joined.items()}
    parts = lambda x: {frozenset(k for k in x if x[k] == v) for v in set(x.values())}
    assert parts(joined) == parts(label)


def test_posting_lists_hold_all_pairs_at_the_minimum():
    like = simhash.CONTRACT
    assert len(like.free) == 28 and all(bin(simhash._mask(f) & ((1 << 64) - 1)).count("1") == 48 for f in like.free)
    a = np.array([0, 0, 0x0102030405060708], np.uint64)
    b = np.array([0x0101, 1 << 63, 0x0102030405060708], np.uint64)
    assert simhash.tally(a, b).tolist() == [6, 7, 8]
    assert simhash._first_list(a[:2], b[:2], 2).tolist() == [like.free.index((0, 1)), like.free.index((0, 7))]


def test_long_texts_are_read_in_portions(monkeypatch):
    text = " ".join(invented(9, 700) + ["é" * 90]).encode()
    whole = simhash.fingerprint(text), Counter(importance.features(text)[1].tolist()), importance.features(text)[0]
    for portion in (1, 37, 400):
        monkeypatch.setattr(word_runs, "PORTION", portion)
        assert (simhash.fingerprint(text), Counter(importance.features(text)[1].tolist()), importance.features(text)[0]) == whole
    assert simhash.fingerprint(b"  a \n b  ") == simhash.fingerprint(b"A B") != 0


# Whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int, rows string, part int").repartition(3)


def brute_whitening(rows):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit) - mean
    e, p = np.linalg.eigh(centred.T @ centred / n)
    e, p = e[::-1], p[:, ::-1]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in kept]
    return [i for i, _ in kept], n, deviations, e, (np.array([x for _, x in kept]) - mean) @ p


def test_whitening_against_eigenvectors(spark):
    r = np.random.default_rng(5)
    mixed = r.standard_normal((90, 20)) @ np.diag(np.linspace(3, 0.4, 20)) @ np.linalg.qr(r.standard_normal((20, 20)))[0]
    good = [(i, mixed[i % 80].tolist()) for i in range(90)] + [(7, mixed[3].tolist()), (None, mixed[4].tolist())]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, [None] + [1.0] * 19), (902, [nan] * 20), (903, [inf] * 20), (904, [1.0, 2.0]), (905, [])]
    found = whitening.whitened(vectors(spark, [(i, v, 1, "r", 2) for i, v in good + bad])).toPandas()
    ids, n, deviations, e, projected = brute_whitening(good)
    assert len(found) == 16 * len(good) and set(found["n"]) == {n} and found["identity_error"].max() < 1e-9
    keyed = Counter(map(tuple, found[found["component"] == 1][["vec_id", "deviation"]].fillna(-1).astype(int).values.tolist()))
    assert keyed == Counter((-1 if i is None else i, d) for i, d in zip(ids, deviations, strict=True))
    for k in range(16):
        part = found[found["component"] == k + 1]
        assert abs(part["explained"].iloc[0] / (e[k] / e.sum()) - 1) < 1e-9
        wanted = np.sort(np.abs(projected[:, k] / math.sqrt(e[k])))
        assert np.allclose(np.sort(np.abs(part["whitened"])), wanted, atol=1e-8)


def test_whitening_with_equal_eigenvalues_and_without_variance(spark):
    axes = [(i, [float(i == j) for j in range(9)]) for i in range(9)]
    found = whitening.whitened(vectors(spark, [(i, v, 1, "r", 2) for i, v in axes])).toPandas()
    assert found["component"].max() == 8 and found["identity_error"].max() < 1e-9  # one direction does not vary
    for rows in ([(1, [1.0, 2.0])] * 3, [], [(1, [])]):
        assert whitening.whitened(vectors(spark, [(i, v, 1, "r", 2) for i, v in rows])).count() == 0


def test_whitening_ends_early_in_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FULL_DIMS", 10)
    r = np.random.default_rng(6)
    strong = r.standard_normal((60, 40)) * np.array([50.0, 30.0, 20.0] + [0.1] * 37)
    rows = [(i, v.tolist()) for i, v in enumerate(strong)]
    found = whitening.whitened(vectors(spark, [(i, v, 1, "r", 2) for i, v in rows]), wanted=3).toPandas()
    _, _, _, e, projected = brute_whitening(rows)
    for k in range(3):
        part = found[found["component"] == k + 1].sort_values("vec_id")["whitened"].to_numpy()
        wanted = projected[:, k] / math.sqrt(e[k])
        assert np.allclose(part * np.sign(part[0] * wanted[0]), wanted, atol=1e-7)


def test_deviation_beyond_a_long():
    centre = whitening.Centre(3, [0, 9])
    found = centre.deviations()(np.array([[1 << 40, 3], [5, 4]]))
    assert found == [None, 15**2 + 3**2]


# Resampling


def test_resample_equals_sql(spark, edge_docs, no_docs):
    target = spark.createDataFrame([(1, "One two WORDS and é words", "c"), (2, None, "c"), (3, " ".join(invented(6, 30)), "c")], "item_id long, text string, n_words string")
    found = importance.resample(edge_docs, target)
    assert bag(found) == by_sql(importance.ORACLE, sorted(found.columns), documents=edge_docs, benchmark=target)
    assert found.where("rank is not null").count() == found.join(edge_docs.select("doc_id").distinct(), "doc_id", "left").where("rank is not null").count()
    assert importance.resample(no_docs, target).count() == 0
    nothing = importance.resample(edge_docs, target.where("false"))
    assert bag(nothing) == by_sql(importance.ORACLE, sorted(found.columns), documents=edge_docs, benchmark=target.where("false"))


def test_features_are_buckets_of_words_and_pairs():
    n, found = importance.features("Ab-c É,ab".encode())
    wanted = [zlib.crc32(x.encode()) % 10000 for x in ("ab", "c", "É", "ab", "ab c", "c É", "É ab")]
    assert n == 4 and Counter(found.tolist()) == Counter(wanted)
    assert importance.features(None)[0] == 0 and len(importance.features(b" - ")[1]) == 0


def test_ranks_with_equal_scores_and_one_frequent_key(spark):
    """A third of the rows has one score and one id; ranks are exact, and no segment holds more than twice the mean."""
    r = np.random.default_rng(4)
    rows = [(5, 77)] * 700 + [(int(s), int(i)) for s, i in zip(r.integers(0, 20, 1400), r.permutation(1400), strict=True)] + [(3, None)]
    df = spark.createDataFrame(rows, "score long, id long").repartition(9)
    found, n = regular_sampling.ranked(df, "score", "id", "rank")
    got = sorted((x["rank"], x["score"], x["id"]) for x in found.collect())
    order = sorted(rows, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
    assert n == len(rows) and got == [(i + 1, *x) for i, x in enumerate(order)]
    sizes = [x["count"] for x in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 2.5 * len(rows) / 8
    none, n = regular_sampling.ranked(df.where("false"), "score", "id", "rank")
    assert n == 0 and none.count() == 0


def test_splitters_weigh_runs_of_different_length():
    keys = [(-s, False, 0, run, place) for run, n in ((0, 4), (1, 4)) for place, s in enumerate(range(100 * run + n, 100 * run, -1))]
    cuts = regular_sampling.splitters(keys, {0: 1.0, 1: 100.0}, 4)
    assert [c[3] for c in cuts] == [1, 1, 0] and cuts == sorted(cuts)
