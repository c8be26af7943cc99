import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, **extra):
    """Documents with ids 0.. and the given texts; extra constant columns may clash with outputs."""
    rows = [(i, t, None, None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name, value in extra.items():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(value))
    return df


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
             for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = prose(160)
    texts = [None, "", " \n\t", "one", "One two", "one two", "é" * 40, prose(3000), base, base, base]
    for _ in range(12):  # near copies of one text, some chained
        words = base.split()
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words))
    passage = prose(60)
    texts += [f"{prose(20)} {passage} {prose(rng.randint(5, 60))}" for _ in range(8)]
    texts += ["The " * 300, "la la " * 120 + prose(20), "x" * 1000, "ab" * 500]
    texts += [prose(rng.randint(1, 60)) for _ in range(30)]
    return texts


@pytest.fixture(scope="package", autouse=True)
def few_partitions(spark):
    """Small tables: fewer tasks a shuffle, in this package only."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
