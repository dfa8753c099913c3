"""A small corpus with nulls, empty and long texts, ties, repeated rows, near copies, shared passages and odd columns."""

import random

import pytest

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(5, 160)) for _ in range(60)]
    passage, item = prose(rng, 120), prose(rng, 24)
    rows = list(enumerate(texts))
    rows += [(60, texts[3]), (61, texts[3].upper()), (62, texts[3] + " end")]
    base = prose(rng, 150).split()
    for k in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(1000))
        rows.append((100 + k, " ".join(words)))
    rows += [(200 + k, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for k in range(6)]
    rows += [(210, "a " + item + " b"), (211, item.replace(" ", "  ").upper()), (212, " ".join(item.split()[:-1] + ["changed"])), (213, " ".join(item.split()[:12]))]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "One"), (305, "é" * 900 + " ça"), (306, "ab" * 1500), (307, "the same line\nthe same line\nthe same line here now"), (308, "<|endoftext|> it's 12\x1cé x 中")]
    rows += [(400, texts[5]), (400, texts[5]), (None, prose(rng, 40)), (500, prose(rng, 20_000))]
    return rows, item


@pytest.fixture(scope="session")
def rows():
    return corpus()[0]


@pytest.fixture(scope="session")
def item():
    return corpus()[1]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Columns that clash with the operators' own are there too."""
    df = spark.createDataFrame([(i, t, "en", "s", 0, 1.0, "k", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_tokens long, score double, key string, cls long")
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
