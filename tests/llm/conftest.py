import random
from collections import Counter

import duckdb
import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, words int, class string, tokens int, budget int"
"""The columns of documents and further ones whose names the operators use themselves."""


def invented(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("bdklmnrst") + r.choice("aeiouéß") for _ in range(r.randint(1, 4))) for _ in range(n)]


def edge_texts() -> list[str | None]:
    """Nulls, empty and white texts, long ones, copies, near copies, shared passages, repeats inside, junk, odd bytes."""
    a, b, c = (" ".join(invented(i, 120)) for i in (1, 2, 3))
    near = a.split()
    near[60] = "changed"
    shared = " ".join(invented(4, 45))
    loop = " ".join(invented(5, 20))
    return [
        None, "", "  \t\n", "one", "one", "ONE", "two words", a, a, " ".join(near), a.upper(), b,
        f"{c} {shared} end", f"{shared} {b[:150]}", f"{' '.join(invented(6, 30))}\n{shared}\n{' '.join(invented(7, 30))}",
        " ".join([loop] * 4), "\n".join(["a line that comes again"] * 8), " ".join(["same"] * 300), "x" * 700, "é" * 450,
        " ".join(w + "***" for w in invented(8, 40)), " ".join(invented(9, 3000)), "tab\tand\x0bmore\x0cwords\r\nof one line " + c[:90],
        "a\x00b 日本語 😀 ▁", "BIG WORDS!! " * 12, "\n\n".join(invented(10, 15)), c, c[:1] + c,
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = []
    for i, text in enumerate(edge_texts()):
        rows.append((i + 1, text, ["en", "de", None][i % 3], [f"src{i % 4}", None][i % 5 == 4], None if text is None else len(text)))
    rows.append(rows[7])  # a repeated row
    rows.append((None, "a document without an id and a few more words than ten of them here", None, None, None))
    rows = [(*r, "k", 1, "c", 2, 3) for r in rows]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


def bag(df, names=None):
    names = names or sorted(df.columns)
    return Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def _plain(v):
    return tuple(_plain(x) for x in v) if isinstance(v, (list, tuple)) else v


def by_sql(sql, names, **tables):
    """Rows of SQL over small Spark tables, as a bag with columns in the order of `names`."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_in", df.toArrow())
        con.execute(f"create table {name} as select * from {name}_in")
    result = con.execute(sql)
    at = [d[0] for d in result.description]
    return Counter(tuple(_plain(r[at.index(n)]) for n in names) for r in result.fetchall())
