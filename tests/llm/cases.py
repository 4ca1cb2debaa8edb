"""Documents with every awkward case: nulls, empty and very long texts, repeats, ties, clashing extra columns."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seq long, line string, h long, term string, a int"


def sentence(seed: int, words: int = 40) -> str:
    choose = random.Random(seed)
    return " ".join("".join(choose.choice("abcdefghij") for _ in range(choose.randint(2, 7))) for _ in range(words))


def documents(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows ``(doc_id, text[, source])`` with extra columns named as the operators name theirs."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 7, "x", 8, "y", 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward() -> list[tuple]:
    long = sentence(1, 30_000)
    base = sentence(2, 60)
    return [
        (None, None, None), (None, base, None), (1, None), (2, ""), (3, " \n\t "), (4, base), (4, base), (5, base),
        (6, long), (7, "x" * 200_000), (8, "Ünï   cödé 　 日本 😀 ▁ a▁b"), (9, "one"), (9, "two words"),
        (10, base + " tail"), (11, "\n\n\n"), (20, sentence(3)), (40, sentence(3)),
    ]
