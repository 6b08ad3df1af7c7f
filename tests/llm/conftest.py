import random

import pytest

DOCS = "doc_id long, text string, kept string, digest int, node string, row int, key string, spans string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(11)
    return ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def docs(spark, words):
    """Prose with copies, near copies, shared passages and every odd case, beside columns whose
    names the operators use themselves."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, texts = prose(60), [None, "", " \n\t", "one two", "a\nb\n a\nb"]
    for k in range(60):
        base = prose(rng.randint(60, 160))
        texts.append(base)
        if k % 4 == 0:
            texts.append(base)
        if k % 5 == 0:
            changed = base.split()
            changed[rng.randrange(len(changed))] = "changed"
            texts.append(" ".join(changed))
        if k % 6 == 0:
            texts.append(f"{prose(30)} {passage} {prose(20)}")
    texts += ["ab" * 400, "x" * 5000, prose(4000), "Émile größe 日本 🙂 " * 20, "aaaa " * 300]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, t, "no", 1, "n", 2, "k", "s") for i, t in zip(order, texts)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def repeated(spark):
    """Repeated rows and null identifiers."""
    return spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None), (2, None)], "doc_id long, text string")
