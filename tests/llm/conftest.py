import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    syll = "the of in er on th re at ion nd ha is to an st ou".split()
    return " ".join("".join(rng.choice(syll) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and white texts, a very long one, copies,
    near copies, repeated rows and repeated ids."""
    rng = random.Random(3)
    base = [prose(rng, 120) for _ in range(12)]
    texts = [None, "", "   \n\t ", "a", "one two", prose(rng, 30_000), "x" * 30_000, "Ünï cødé 🎉 中文字 " * 40]
    texts += base + base[:3] + [b.replace(" ", "  ", 3) for b in base[3:5]]
    texts += [base[5].rsplit(" ", 2)[0] + " quite other", base[6] + " tail", base[0] + "\n" + base[7]]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None if t is None else len(t))
            for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (9, prose(rng, 50), None, None, None), (None, base[1], "en", "s1", 3), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with more columns, whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("id", "row", "unit", "n", "score", "copies", "spans", "weight", "h", "size")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
