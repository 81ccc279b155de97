import random

import pytest
from pyspark.sql import functions as F

VOWELS = ["ba", "ke", "li", "mo", "nu", "sha", "tre", "vi", "zo", "qua"]


def vocabulary(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) + str(i % 7) for i in range(n)]


def prose(rng, n, vocab):
    out = []
    for i in range(n):
        out.append(rng.choice(vocab).capitalize() if i % 11 == 0 else rng.choice(vocab))
        out.append("\n" if rng.random() < 0.05 else " " if rng.random() < 0.98 else "  \t")
    return "".join(out)


def build_documents():
    """(doc_id, text): prose, copies, near copies in chains, shared passages, and odd texts."""
    rng, vocab = random.Random(5), vocabulary(900)
    texts = [prose(rng, rng.randint(1, 260), vocab) for _ in range(70)]
    base = prose(rng, 200, vocab).split()
    for edits in range(24):                              # a family of near copies, some below the threshold
        copy = list(base)
        for _ in range(edits // 3 + 1):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        texts.append(" ".join(copy))
    chain = prose(rng, 150, vocab).split()
    for step in range(6):                                # each close to the one before, the ends far apart
        texts.append(" ".join(chain))
        for _ in range(3):
            chain[rng.randrange(len(chain))] = rng.choice(vocab)
    passage = prose(rng, 90, vocab)
    for n in (5, 40, 200):
        texts.append(prose(rng, n, vocab) + " " + passage + " " + prose(rng, n // 2, vocab))
    texts += [texts[3], texts[3], texts[10].upper(), "one two three", "One  two\nthree", "one two three four"]
    texts += ["", None, " \n\t ", "a", "a " * 400, "line of words here\n" * 30, "é ü ß 漢字 語 " * 20, "<|endoftext|> x", "### *** $$$ %%% &&& ||| <<< >>>"]
    texts.append(prose(rng, 6000, vocab))                # very long
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(int(i) * 3 + 1, t) for i, t in zip(order, texts)]


@pytest.fixture(scope="session")
def documents():
    return build_documents()


@pytest.fixture(scope="session")
def docs(spark, documents):
    """The documents with columns whose names operators use inside."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in documents]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit(7) for c in ("key", "keys", "n", "node", "component", "start", "length", "rank", "spans", "codes", "size", "_host", "leader")}
    return df.withColumns(clash).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows and ties."""
    rows = [(None, "alpha beta gamma delta epsilon zeta", None, None, 1), (None, None, None, None, None)]
    rows += [(4, "alpha beta gamma delta epsilon zeta", "en", "a", 3)] * 2 + [(2, "alpha beta gamma delta epsilon zeta", "en", "a", 3), (9, None, "fr", "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
