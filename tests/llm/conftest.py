import random

import pytest

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "me", "no", "ra", "si", "tu", "ve") for b in ("l", "m", "n", "r", "s", "th", "x", "zo")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Ids with gaps, a null id, null, blank and empty texts, ties, repeated rows, near copies, shared lines."""
    rng = random.Random(3)
    base = [prose(rng, 60) for _ in range(12)]
    line = prose(rng, 20)
    out = [(i * 3, t) for i, t in enumerate(base)]
    near = base[0].split()
    near[30] = "other"
    out += [(100, base[1]), (101, base[1].upper()), (102, " ".join(near)), (103, base[2] + "\n" + line), (104, base[3] + "\n" + line + "\n"),
            (105, None), (106, ""), (107, " \t\n "), (108, "Only three words"), (109, "only THREE words"), (110, "don't  stop\n\n日本 ½ é"),
            (3, base[1]), (3, base[1]), (None, base[4]), (None, "alone here with a null id of its own"), (111, "x" * 3000 + " " + line), (112, prose(rng, 3000))]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names an operator might use itself."""
    made = [(i, t, "en" if k % 3 else None, None if t is None else len(t), k, "z", 0.5) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, n_chars long, key long, tokens string, score double").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")
