"""Small tables with every awkward case."""

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _tkey string, h string, stratum int, rate int"


def docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 1, 2) for i, t in rows], SCHEMA)


def awkward(seed: int = 0) -> list[tuple]:
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = [text(40) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "é漢😀 ▁ x\x00y"), (7, base[0]), (8, base[0]),
            (8, base[0]), (9, base[1] + "\n" + base[2]), (10, base[1]), (None, base[2]), (None, base[2]), (11, base[3] * 40),
            (12, base[3]), (12, base[4]), (13, "a" * 5000), (14, ("long " * 3000).strip()), (15, base[5].upper())]
    rows += [(20 + k, base[k % 6] + " " + text(3)) for k in range(12)]
    return rows
