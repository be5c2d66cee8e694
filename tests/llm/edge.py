"""Rows that every operator must handle: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

LINE = "the quick brown fox jumps over the lazy dog near the old river bank while seven birds sing songs today again"
OTHER = "a b c d e f g h i j k l m n o p q r s t u v w x y z and then some more words follow until the end of it."
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))

ROWS = [
    (1, LINE + "\n" + OTHER),
    (2, LINE + "\n" + OTHER),          # exact copy
    (3, LINE.replace("fox", "cat") + "\n" + OTHER),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "one"),
    (9, "one"),                          # repeated row
    (10, "# * $ % & | < >\nHome | About | Contact | Help\nok"),
    (None, LINE),                        # null id
    (None, None),
    (11, "É ß 中文 😀   naïve <|endoftext|> x\x00y"),
    (12, (LINE + "\n") * 3),
    (13, "tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie"),
    (-5, OTHER),
]
#: Extra columns whose names operators might use themselves.
CLASH = ("lang", "source", "n_chars", "row", "doc", "key", "pos", "line", "fp", "sim", "hub", "grp", "node", "y", "x",
         "score", "label", "words", "family", "component_id", "digest", "first", "n", "ids", "decoded", "q", "kept")


def edge_docs(spark, rows=None):
    rows = ROWS if rows is None else rows
    ddl = "doc_id long, text string, " + ", ".join(f"{c} {'long' if c == 'n_chars' else 'string'}" for c in CLASH)
    data = [(i, t, *[(7 if c == "n_chars" else f"{c}-value") if k % 3 else None for c in CLASH])
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, ddl)


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
