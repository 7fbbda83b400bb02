import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and near copies."""
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(12)]
    out = []
    for i, t in enumerate(base):
        out.append((i, t, "en", f"s{i % 3}", len(t)))
    out.append((20, base[0] + " tail", "en", "s0", 5))
    out.append((21, base[0].replace(" ", "\n\t"), "en", "s1", 5))
    out.append((22, base[1].upper(), "de", None, None))
    out.append((23, base[2] + " more words at the end", None, "s2", 1))
    out += [(30, None, "en", "s0", None), (31, "", "fr", "s1", 0), (32, " \n\t ", "fr", None, 4), (33, "one two", "en", "s2", 7),
            (34, "one two", "en", "s2", 7), (35, "!!! 123", None, "s1", 7)]
    out.append((40, words(rng, 9000), "en", "s0", 1))
    out += [(50, base[3], "en", "s0", 3), (50, base[3], "en", "s0", 3)]
    out.append((None, base[4] + " z", "en", "s0", 3))
    shared = "This line is long enough to count and is held by many documents."
    out += [(60 + i, f"{base[5 + i % 3]}\n  {shared.upper() if i % 2 else shared}\t\nend {i}", "en", "s1", 1) for i in range(7)]
    return out


@pytest.fixture()
def docs(spark, rows, tmp_path):
    """The rows as a stored table with columns whose names operators use too."""
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    extra = {n: n for n in ("_row", "size", "key", "node", "kept", "rank", "_words", "_language", "score")}
    from pyspark.sql import functions as F
    df.withColumns({k: F.lit(v) for k, v in extra.items()}).repartition(3).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


@pytest.fixture()
def no_docs(spark, tmp_path):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(str(tmp_path / "none"))
    return spark.read.schema(DOC_SCHEMA).parquet(str(tmp_path / "none"))
