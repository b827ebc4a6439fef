"""Small tables of documents with awkward rows, for all corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns named like those that operators add or use inside.
CLASHES = (
    "kept", "stats", "rule", "base_failed", "copy", "rate", "salt", "digest", "fp", "near0", "way",
    "lost", "n_lines", "n_dropped", "encoded", "packed", "placed", "text_key", "place", "held_out",
    "score", "spans", "n", "gram", "target", "token", "verdict", "path",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, count: int) -> str:
    chosen = random.Random(seed)
    lexicon = ["".join(chosen.choices("abcdefghijklmnop", k=chosen.randint(2, 9))) for _ in range(300)]
    return " ".join(chosen.choice(lexicon) for _ in range(count))


def awkward_texts() -> list[str | None]:
    passage = words(7, 120)
    line = "A line that many of the documents have in common."
    return [
        None, None, "", "   \t\n\n", "one", "one two", "One  two\nTHREE",
        words(1, 200), words(1, 200), words(1, 200) + " and", words(2, 60),
        f"{words(3, 90)}\n{line}\n{passage}", f"{line}  \n{passage}\n{words(4, 90)}",
        f"\t{line.upper()}\n{words(5, 70)}\n{passage}", f"{line}\n{line}\nshort", "x" * 5000, "ab " * 3000,
        "été à la fenêtre, où l’on voit ½ des 12 îles\u00a0: ça\u2003va\u3000bien " * 20,
        "naïve 漢字かな交じり文 и русский текст 🙂🙃 \x1c\x1f\x85 end" * 30, "<|endoftext|> it's 've 12345 !?",
        "*** ### $$$ " * 40, "\r\n".join(words(k, 12) for k in range(8)), "1234 5678 ,.!",
    ]


def awkward_rows() -> list[tuple]:
    rows = [
        (10 * k, text, ["en", "fr", None][k % 3], ["hot", "hot", None, "rare"][k % 4], None)
        for k, text in enumerate(awkward_texts())
    ]
    # a wholly repeated row, and ids that are far apart or negative
    return [*rows, rows[8], (-5, words(1, 200), "en", "", 3), (1 << 40, words(9, 80), "de", "hot", 0)]


def table(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashes:
        docs = docs.selectExpr("*", *(f"'own' AS {c}" for c in CLASHES))
    return docs


def long_text(chars: int = 1_500_000) -> str:
    """Longer than any piece in which an operator takes a text."""
    return words(11, chars // 6) + "\n" + "é" * 50 + "\n" + words(12, 50)
