import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

# NULLs, empty and blank texts, ties, repeated rows and ids, control characters, a text of 120,000 characters.
WORDS = [f"w{i * i % 97}x{i % 13}" for i in range(400)]
LONG = " ".join(WORDS[i % 400] + str(i // 7) for i in range(12_000))
ROWS = [
    (0, "The quick brown fox jumps over the lazy dog near the old stone bridge.\n" * 3),
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG[:9000] + " changed " + LONG[9000:]),
    (6, " ".join(WORDS)), (7, " ".join(WORDS)), (7, " ".join(WORDS)), (8, " ".join(WORDS[1:])),
    (9, "É ü 日本語 \u00a0 “quoted” <|im_end|> 🙂"), (None, "no id here"), (None, None), (10, "ab " * 400), (11, "12345"),
    (12, "Lead. " + " ".join(WORDS[100:220]) + " tail"), (13, "x"), (14, " ".join(WORDS[150:260]) + "\n" + "y" * 300),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    """Odd rows over several partitions, with more columns whose names an operator also uses inside."""
    from roompulse.llm.storage import importable

    importable(spark)
    clash = ", ".join(f"'{n}' AS `{n}`" for n in ("ids", "start", "rank", "class", "gram", "node", "size", "hits", "words", "block"))
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def empty(spark):
    from roompulse.llm.storage import importable

    importable(spark)
    return spark.createDataFrame([], SCHEMA)
