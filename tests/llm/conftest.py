import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key long, m long, found string, score double, n_lines int"


def words(r: random.Random, n: int, pool: int = 4000) -> list[str]:
    return ["w" + format(r.randrange(pool), "x") for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """A small corpus: copies, near copies, shared passages and lines, periodic text, nulls, empty texts, repeated rows, a long text."""
    r = random.Random(5)
    base = [words(r, 120) for _ in range(12)]
    shared = "\n".join(" ".join(words(r, 30)) for _ in range(3))
    out = []

    def add(text, source="s1", doc_id=-1):
        out.append((len(out) + 1 if doc_id == -1 else doc_id, text, "en", source, len(text or ""), 7, 8, 9, "x", 0.5, 3))

    for k, b in enumerate(base):
        add(" ".join(b) + "\n" + " ".join(words(r, 15)), "hot")
        for j in range(4):  # near copies
            c = list(b)
            for _ in range(2 + j):
                c[r.randrange(len(c))] = "edit"
            add(" ".join(c), "s%d" % (k % 3))
    for _ in range(6):
        add(out[0][1])  # copies
    for _ in range(5):  # a passage of several lines in other text
        add(" ".join(words(r, 40)) + "\n" + shared + "\n\n" + " ".join(words(r, 20)), "hot")
    add("ab " * 300)
    add("zq" * 400, None)
    add("É ü ß " * 80 + "中文 テスト", "s9")
    add("", "hot")
    add("  \n\t ", "hot")
    add(None, None)
    add("a b c", "s2")
    add("A  B\nc", "s2")
    add(" ".join(words(r, 30000, 10**6)), "long")
    out.append(out[3])  # a repeated row
    add("no id, " + " ".join(words(r, 60)), "s1", None)
    add("no id, " + " ".join(words(r, 60)), "s1", None)
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
