"""Texts of a batch are cut, numbered, decoded and sampled together: the same as one by one."""

import numpy as np
import pytest

from fiscalmill.llm import pieces

from .conftest import edge_texts

TEXTS = [t or "" for t in edge_texts()] + ["one two", " lead", "a\n\nb c\n", "日本 語 \U000e0041", "a ▁ b", "� x", "to" * 30, "\n", "▁"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(pieces.MODEL)


def test_rows_of_a_batch_are_those_of_its_texts(vocabulary):
    names = [f"1:{i}" for i in range(len(TEXTS))]
    together = pieces.rows_of(vocabulary, list(range(len(TEXTS))), TEXTS, names, 3).to_pylist()
    apart = [r for i, t in enumerate(TEXTS) for r in pieces.rows_of(pieces.Pieces(pieces.MODEL), [i], [t], [names[i]], 3).to_pylist()]
    assert [(r["doc_id"], r["rank"], r["ids"]) for r in together] == [(r["doc_id"], r["rank"], r["ids"]) for r in apart]
    for a, b in zip(together, apart, strict=True):
        assert a["log_prob"] == pytest.approx(b["log_prob"], abs=1e-9) and a["log_inclusion"] == pytest.approx(b["log_inclusion"], abs=1e-9)
    for r in together:
        text = TEXTS[r["doc_id"]]
        assert r["exact"] == (vocabulary.decode(r["ids"]) == text) and r["n_tokens"] == len(r["ids"])
        assert r["rank"] > 0 or r["ids"] == vocabulary.model.encode(text)


def test_chunks_of_one_hash_stay_apart(vocabulary, monkeypatch):
    """Chunks are compared with what is known under their number, so a hash that says nothing changes no id."""
    monkeypatch.setattr(vocabulary, "known", pieces.Known())
    monkeypatch.setattr(pieces.tokens, "LONG_WORD", 0)
    monkeypatch.setattr(pieces.xxhash, "xxh3_64_intdigest", lambda value: len(value) % 3 << 62)
    for text in ["aa bb cc dd", "bb aa\nxyz abc", "aa bb cc dd ee"]:
        assert vocabulary.encode(text) == vocabulary.model.encode(text)
    vocabulary.known = pieces.Known()


def test_numbers_keep_all_keys_while_the_table_grows():
    table, rng = pieces.Numbers(), np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 90_000, dtype=np.uint64) << np.uint64(1))
    for part in np.array_split(np.arange(len(keys)), 7):
        assert (table.of(keys[part]) == -1).all()
        table.add(keys[part], part)
    assert (table.of(keys) == np.arange(len(keys))).all()
    near = np.arange(5, dtype=np.uint64)  # all of one slot
    table.add(near[1:], 10 + np.arange(4))
    assert table.of(near[1:]).tolist() == [10, 11, 12, 13]


def test_a_long_first_path_is_searched_to_the_end_of_its_mass(vocabulary, monkeypatch):
    texts = ["▁".join("to be or not to be that is the question".split()) * 20, "the same again " * 30]
    wide = pieces.sampled(vocabulary, texts, ["x", "y"], 4)
    monkeypatch.setattr(pieces, "WINDOW", 2)
    narrow = pieces.sampled(vocabulary, texts, ["x", "y"], 4)
    assert [[(d[0].tolist(), d[1:]) for d in own] for own in wide] == [[(d[0].tolist(), d[1:]) for d in own] for own in narrow]
