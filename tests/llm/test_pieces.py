import math
from collections import Counter

import numpy as np
import pytest

from fiscalmill.llm import pieces

from .conftest import edge_texts


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(pieces.MODEL)


def test_ids_are_the_models_and_come_back(vocabulary):
    for text in [t for t in edge_texts() if t] + ["  two  spaces \n lines\n\n", "<s> <0x0A>"]:
        ids = vocabulary.encode(text)
        assert ids == vocabulary.model.encode(text)
        assert vocabulary.decode(ids) == vocabulary.model.decode(ids)
        assert (vocabulary.decode(ids) == text) or "▁" in text


def every_segmentation(vocabulary, chunk):
    if not chunk:
        return {(): 1.0}
    out = {}
    for end in range(1, len(chunk) + 1):
        i = vocabulary.model.piece_to_id(chunk[:end])
        if i > 2 and vocabulary.model.id_to_piece(i) == chunk[:end]:
            for rest, p in every_segmentation(vocabulary, chunk[end:]).items():
                out[(i, *rest)] = p * math.exp(vocabulary.log_weight[i])
    return out


def test_samples_against_enumeration(vocabulary):
    """First samples by their probability, all samples distinct, and the scores unbiased."""
    text, n = "to be", 6000
    every = every_segmentation(vocabulary, "▁to▁be")
    total = sum(every.values())
    drawn = pieces.sampled(vocabulary, [text] * n, [f"s{i}" for i in range(n)], 3)
    first = Counter(tuple(d[0][0].tolist()) for d in drawn)
    for ids, p in every.items():
        assert abs(first[ids] / n - p / total) < 0.02
    for d in drawn:
        names = [tuple(x[0].tolist()) for x in d]
        assert len(set(names)) == 3
        assert all(abs(x[1] - math.log(every[n_] / total)) < 1e-9 for x, n_ in zip(d, names, strict=True))
    assert abs(sum(math.exp(p - q) for d in drawn for _, p, q in d) / n - 1) < 0.05
    assert abs(sum(d[1][1] < d[0][1] for d in drawn) / n - 0.9) < 0.1


def test_all_segmentations_of_a_short_text(vocabulary):
    found = pieces.sampled(vocabulary, ["a"], ["x"], 50)[0]
    assert len(found) == 2 and all(inclusion == 0.0 for _, _, inclusion in found)


def log_mass(vocabulary, chunk):
    """Log of the mass of all segmentations of a chunk, place by place."""
    total = [0.0] * (len(chunk) + 1)
    for at in range(len(chunk) - 1, -1, -1):
        logs = []
        for end in range(at + 1, min(len(chunk), at + vocabulary.longest) + 1):
            i = vocabulary.model.piece_to_id(chunk[at:end])
            if i > 2 and vocabulary.model.id_to_piece(i) == chunk[at:end]:
                logs.append(vocabulary.log_weight[i] + total[end])
            if end == at + 1 and not logs:
                logs.append(sum(vocabulary.log_weight[x] for x in vocabulary.character(ord(chunk[at]))) + total[end])
        most = max(logs)
        total[at] = most + math.log(sum(math.exp(x - most) for x in logs))
    return total[0]


@pytest.mark.parametrize("text", ["to" * 200, "=" * 400, "日本語" * 134, "a😀\U000e0041" * 134, " " * 400, "https://example.org/" + "a1b2c3d4e5" * 60])
def test_long_chunks_have_one_lattice(vocabulary, text):
    chunk, n = vocabulary.chunks(text), 400
    assert len(chunk) == 1 and len(chunk[0]) > 400
    mass = log_mass(vocabulary, chunk[0])
    drawn = pieces.sampled(vocabulary, [text] * n, [f"s{i}" for i in range(n)], 1)
    crossed = 0
    for ((ids, log_prob, _),) in drawn:
        assert vocabulary.decode(ids.tolist()) == text
        assert abs(log_prob - (sum(vocabulary.log_weight[i] for i in ids) - mass)) < 1e-6
        ends = set(np.cumsum([len(vocabulary.bytes[i]) for i in ids]).tolist())
        crossed += len(chunk[0][:200].replace("▁", " ").encode()) not in ends
    apart = math.exp(log_mass(vocabulary, chunk[0][:200]) + log_mass(vocabulary, chunk[0][200:]) - mass)
    assert abs(crossed / n - (1 - apart)) < 0.1


def test_operator_on_edges(spark, edge_docs, no_docs):
    rows = pieces.segmentations(edge_docs, k=3).collect()
    again = pieces.segmentations(edge_docs.repartition(5), k=3).collect()
    key = lambda r: (str(r["doc_id"]), r["rank"], r["ids"], r["exact"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    texts = {r["doc_id"]: r["text"] or "" for r in edge_docs.collect()}
    assert Counter(r["doc_id"] for r in rows if r["rank"] == 0) == Counter(r["doc_id"] for r in edge_docs.collect())
    assert all(r["exact"] == ("▁" not in texts[r["doc_id"]]) for r in rows)
    assert [r["n_tokens"] for r in rows if not texts[r["doc_id"]]] == [0, 0]
    assert pieces.segmentations(no_docs).count() == 0
