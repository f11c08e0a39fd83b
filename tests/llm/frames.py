"""Small tables with the odd cases that every operator has to stand."""

from __future__ import annotations

import random

VOCABULARY = "ab be co du el fi go hu in jo ka lu mo na op pi qu ri so tu".split()


def words(n: int, seed: int) -> str:
    """Invented prose of ``n`` words."""
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice(VOCABULARY) for _ in range(rng.randrange(1, 4))) for _ in range(n)
    )


def odd_texts() -> list[str | None]:
    """NULL, empty, short, very long, repeated and hard texts."""
    long = words(6_000, 1)
    edited = long.split()
    edited[3_000] = "changed"
    return [
        None, "", " ", "a", "é", "one two", words(40, 2), words(40, 2), words(40, 2) + " more",
        long, " ".join(edited), "a" * 3_000, "ab" * 1_500, "a" * 2_000 + "b" + "a" * 70,
        "x\t\ty\n\n z ,. !?", "日本語 " * 60, words(300, 3) + "\n" + long[:400],
        "(" + long[100:260] + ")", "<|endoftext|> " * 3, "0 " * 200,
    ]


def odd_documents(spark):
    """Documents with NULLs in all columns, repeated rows and columns with awkward names."""
    rows = [(n, t, "en" if n % 2 else None, n) for n, t in enumerate(odd_texts())]
    rows += [(None, "no id at all " * 10, "en", 5), (6, rows[6][1], None, 6), rows[9]]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n long")


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
