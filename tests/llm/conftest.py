import random

import pytest

WORDS = "the river stone light wind paper garden quick brown silent moon carries seven letters across every window while birds".split()


def prose(seed: int, n: int = 80, per_line: int = 14) -> str:
    r = random.Random(seed)
    w = [r.choice(WORDS) + r.choice("abcdefghij") * (r.random() < 0.6) + str(seed % 7) * (r.random() < 0.02) for _ in range(n)]
    return "\n".join(" ".join(w[i : i + per_line]) + "." for i in range(0, n, per_line))


@pytest.fixture(scope="session")
def texts():
    base = [prose(i, 40 + 7 * i) for i in range(30)]
    near = [base[3].replace(base[3].split()[20], "changed"), base[4] + " more"]
    odd = [None, "", " \n\t ", "one", "A", "x" * 20_000, "É Â ß 漢字 🙂 <|endoftext|> don't", "a b c d e f g h i j " * 3_000, "\x00 \x1c   　 x"]
    return [*base, base[3], base[3], base[5], *near, *odd]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i * 3 % 101, t, ["en", "fr", None][i % 3], f"s{i % 2}", None if t is None else len(t), "extra", "clash") for i, t in enumerate(texts)]
    rows += [rows[0], (None, "a row without an id here", None, None, None, None, None), (None, None, "en", "s0", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, words string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
