"""Small documents with awkward rows, as tables in a folder."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split()) + r.choice(["", "", "s", "."])
                    for _ in range(n))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    """(doc_id, text): prose, near and exact copies, empty, null, odd and long texts, ties."""
    out = [(i, prose(i, 40 + 7 * i)) for i in range(1, 41)]
    base = prose(99, 120)
    words = base.split()
    for k in range(12):  # near copies of one text, at different distances
        changed = list(words)
        for j in range(k):
            changed[5 + 9 * j] = f"x{k}y{j}"
        out.append((100 + k, " ".join(changed)))
    out += [(120, base), (121, base.upper()), (121, base), (130, ""), (131, None), (132, " \n\t "), (133, "one two three"),
            (134, "One two  three"), (135, "é😀 a.b@c-d.org +1 (222) 333-4444 4111 1111 1111 1111 10.0.0.255 999.1.1.1\n"),
            (136, "licensed under the apache license, version 2.0. and GB82 WEST 1234 5698 7654 32 iban"),
            (137, "a \n b  İstanbul Σας don't 12345 \x1c|"), (138, "z" * 3000), (139, "ab " * 4000),
            (140, prose(7, 9000)), (None, "no id at all here in this row"), (141, prose(1, 47))]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows among columns that operators use names of."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("clash").alias(c) for c in ("node", "n", "ids", "score", "key", "spans", "bucket", "tail", "held_out", "doc id", "uid")))


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def folder(spark, docs, tmp_path_factory):
    """A folder with documents and labels."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    labels.write.parquet(f"{path}/labels.parquet")
    return path
