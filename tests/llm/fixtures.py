"""Small awkward inputs, and plain versions of what the operators compute."""

from __future__ import annotations

import random

LETTERS = "the of and to in is that it was for on are as with his they at be this have".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(LETTERS) + str(draw.randint(0, 60)) for _ in range(words))


def documents() -> list[tuple]:
    """(doc_id, text, lang, score, n_chars): nulls, empties, copies, ties, long texts, odd characters."""
    base = prose(1, 120)
    texts = [
        base,
        base,
        base.replace("7", "8", 1),
        prose(2, 40) + "\n\n" + base[:300] + "\n" + prose(3, 30),
        None,
        "",
        "   \n\t ",
        "one two",
        "a " * 4000,
        "x" * 30000,
        "é日本 🙂 don't  ΣΑΣ\x00 <|endoftext|> \x85 ñ",
        "Mail a.b@c.de, +1 (988) 555-2485, 42.144.35.254 and 4041894974608795.",
        prose(4, 5000),
        prose(5, 12),
        prose(6, 13),
        prose(6, 13) + " tail",
    ]
    rows = [(i * 7 - 14, t, None if i % 3 else "en", float(i), 0 if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((None, base, "en", None, None))
    rows.append((None, None, None, None, None))
    rows.append(rows[3])
    return rows


SCHEMA = "doc_id long, text string, lang string, score double, n_chars long"


def frame(spark, rows=None, parts: int = 3):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)
