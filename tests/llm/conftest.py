import random

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def split_words(text):
    out, word = [], []
    for ch in text or "":
        if ch in " \t\n\x0b\x0c\r":
            if word:
                out.append("".join(word))
                word = []
        else:
            word.append(ch)
    return out + (["".join(word)] if word else [])


def odd_texts():
    """Nulls, blanks, ties, repeats, very long and strange texts."""
    rng = random.Random(4)
    vocabulary = ["the", "of", "Élan", "x" * 300, "naïve", "漢字", "a%b$", "The", "OF", "end."] + [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))                    # noqa: E731
    passage = say(40)
    long = say(9000) + " " + passage
    rows = [None, "", " \t\n", "one", "two words", say(12), say(13), passage, passage, f"{say(30)}\n{passage}\t{say(5)}",
            f"{passage} {passage}", long, "same " * 400, "x" * 5000, "line one is here\nline one is here\n\nline one is here ",
            passage.upper(), passage.replace("the", "THE"), "   odd spaces \x00 nul", long.replace("w7", "w8")]
    return [(i * 3 if i != 5 else None, t) for i, t in enumerate(rows)] + [(21, passage)]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with extra columns, some with names that operators use for results."""
    rows = [(i, t, "xx", True, 5, "a") for i, t in odd_texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept boolean, n_words int, blob string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, kept boolean, n_words int, blob string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
