import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fiscalmill.llm import graph, near_dedup, quality_rules, suffix_index, suffix_trees, tokens

from .conftest import bag, by_sql, invented

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, like):
    text = text or ""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if like.lower else text)
    k = like.words
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute_groups(rows, like):
    sets = [shingles(t, like) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= like.percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    lowest = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)].append(doc_id)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in lowest[root(i)] if x is not None]
        least = min(ids) if ids else None
        out[(doc_id, len(sets[i]), least, doc_id == least)] += 1
    return out


@pytest.mark.parametrize("like", [near_dedup.CONTRACT, near_dedup.Likeness()])
def test_groups_against_brute_force(edge_docs, like):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    found = near_dedup.groups(edge_docs, like).select("doc_id", "n_shingles", "component_id", "kept")
    assert Counter(tuple(r) for r in found.collect()) == brute_groups(rows, like)


def test_a_large_group_of_near_copies(spark):
    """Copies of one text with more and more changes: chains, borderline pairs, many components in one family."""
    r = random.Random(5)
    base = [f"w{r.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5, 6, 8, 12])):
            words[r.randrange(120)] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.groups(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert Counter(tuple(x) for x in found.collect()) == brute_groups(rows, near_dedup.CONTRACT)


def test_deduplicate_keeps_columns(edge_docs, no_docs):
    left = near_dedup.deduplicate(edge_docs)
    assert left.columns == edge_docs.columns
    kept = near_dedup.groups(edge_docs, near_dedup.Likeness()).where("kept").select("doc_id")
    assert bag(left.select("doc_id")) == bag(kept)
    assert near_dedup.groups(no_docs).count() == 0


def brute_kept(rows, like):
    """What one row of each group leaves: the ids and texts by the order (id, null last, place)."""
    sets = [shingles(t, like) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= like.percent * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        first[label[i]] = min(first.get(label[i], (2, 0, 0)), (doc_id is None, doc_id or 0, i))
    return [rows[i] for _, _, i in first.values()]


def test_one_row_of_each_group(spark, edge_docs, folder):
    """Repeated rows, one id for several texts, rows without an id: the stage against brute force, by rows and texts."""
    a, b, c = (" ".join(invented(i, 90)) for i in (21, 22, 23))
    near = lambda text, word: " ".join([*text.split()[:-1], word])
    more = [(100, a), (100, a), (103, near(a, "x")), (102, b), (103, near(b, "y")), (103, "quite another text under this id")]
    more += [(None, c), (None, c), (None, near(c, "z")), (None, near(a, "v")), (None, "no id and seen once")]
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + more
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True).repartition(5)
    left = corpus_pipeline.near_dedup_stage(spark, docs, folder)
    assert left.columns == docs.columns
    found, wanted = left.select("doc_id", "text").collect(), brute_kept(rows, near_dedup.Likeness())
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in wanted)
    like = near_dedup.Likeness()
    assert Counter(shingles(r["text"], like) for r in found if r["doc_id"]) == Counter(shingles(t, like) for i, t in wanted if i)
    texts = [r["text"] for r in found]
    assert texts.count(a) == 1 and sum(t in (c, near(c, "z")) for t in texts) == 1 and near(b, "y") not in texts and near(a, "x") not in texts


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(2)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.sort(pool[:3000]), np.sort(pool[1000:])
    sa, sb, both = near_dedup.sketches([a, b, np.sort(pool)])
    assert (np.maximum(sa, sb) == both).all()
    n = np.array([3000.0])
    keeps = lambda p: near_dedup.likelihood_keeps(sa[None], sb[None], n, n, p)[0]
    assert keeps(50) and not keeps(95)


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)]
    found = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {v: x for v, x in label.items() if x != v} == found
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_bytes(rows):
    n = suffix_index.LENGTH
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(x[j : j + n] for _, x in texts for j in range(len(x) - n + 1))
    out = Counter()
    for i, x in texts:
        covered = np.zeros(len(x) + 1, bool)
        for j in range(len(x) - n + 1):
            if seen[x[j : j + n]] > 1:
                covered[j : j + n] = True
        kept = bytes(b for b, c in zip(x, covered[:-1], strict=True) if not c)
        out[(i, len(x), int(covered.sum()), int((covered[1:] & ~covered[:-1]).sum() + covered[0]), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [suffix_index.HOT, 3, 1])
def test_hot_groups_are_split_exactly(spark, monkeypatch, hot):
    """Passages of lengths around LENGTH in many documents, between words of their own or of a few, cut by text ends."""
    monkeypatch.setattr(suffix_index, "HOT", hot)
    r = random.Random(3)
    passage = " ".join(invented(20, 110))
    rows = []
    for i in range(60):
        start, size = r.choice([0, 5, 90]), r.choice([195, 199, 200, 201, 207, 230, 400])
        own = lambda k, n: " ".join(invented(k, n))
        left, right = own(100 + r.choice([i, i % 4]), r.choice([0, 2, 40])), own(200 + r.choice([i, i % 4]), r.choice([0, 3, 40]))
        rows.append((r.choice([i, None]), left + passage[start : start + size] + right))
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string").repartition(4)
    found = suffix_index.repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(x) for x in found.collect()) == brute_bytes(rows + rows[:2])


@pytest.mark.parametrize("hot", [suffix_index.HOT, 1])
def test_repeated_bytes_against_brute_force(edge_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_index, "HOT", hot)
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    found = suffix_index.repeats(edge_docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in found.collect()) == brute_bytes(rows)


def test_remove_repeats_keeps_rows_and_columns(edge_docs, no_docs):
    left = suffix_index.remove_repeats(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == edge_docs.count()
    assert left.where("n_chars <> length(text)").count() == 0
    assert suffix_index.remove_repeats(no_docs).count() == 0


def test_suffix_array_and_matches():
    r = np.random.default_rng(1)
    text = np.concatenate([r.integers(2, 4, 400), [0], r.integers(2, 4, 300), [1]])
    order = suffix_index.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    statistics = suffix_index.RunLengthIndex(text).matching_statistics(30)
    for i in range(0, len(text), 7):
        longest = 0
        for j in range(len(text)):
            k = 0
            while i != j and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            longest = max(longest, k)
        assert statistics[i] == min(longest, 30)


def test_repeated_words_equal_sql(edge_docs, no_docs):
    docs = edge_docs.where(F.col("doc_id").isNotNull())
    found = suffix_trees.repeats(docs)
    assert bag(found) == by_sql(suffix_trees.ORACLE, sorted(found.columns), documents=docs)
    assert suffix_trees.repeats(edge_docs).count() == edge_docs.count()
    assert suffix_trees.repeats(no_docs).count() == 0


def doubling_words(n):
    """Two different words of n letters: a b b a ..., and the same with the letters changed about."""
    letters = "a"
    while len(letters) < n:
        letters += letters.translate({97: 98, 98: 97})
    return letters, letters.translate({97: 98, 98: 97})


@pytest.mark.parametrize("length", [16, 32, 64, 1024, 4096])
def test_regular_words_have_different_hashes(spark, length):
    a, b = doubling_words(length)
    first, second = tokens.words_of([a.encode(), b.encode()]).hashes
    assert first != second
    if length == 1024:
        shared = " ".join(invented(3, 12))
        docs = spark.createDataFrame([(1, f"{a} {shared}"), (2, f"{b} {shared}"), (3, a), (4, b)], "doc_id long, text string")
        assert {r["n_removed"] for r in suffix_trees.repeats(docs).collect()} == {0}
        assert {r["component_id"] for r in near_dedup.groups(docs).collect()} == {1, 2, 3, 4}


def test_stages_keep_columns_with_names_of_their_own(spark):
    names = ["__words", "__hashes", "__windows", "__row", "__text", "row", "rest", "Row_"]
    text = " ".join(invented(5, 60))
    docs = spark.createDataFrame([(1, text, *range(8)), (2, f"{text} {text[:250]}", *range(8, 16))], ["doc_id", "text", *names])
    for left in (quality_rules.keep(docs), suffix_index.remove_repeats(docs)):
        assert left.columns == docs.columns
        assert Counter(tuple(r[n] for n in names) for r in left.collect()) <= Counter([tuple(range(8)), tuple(range(8, 16))])
    assert suffix_index.remove_repeats(docs).count() == 2
