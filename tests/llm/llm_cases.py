"""Small tables that the tests of the training-data operators share."""

import random

# extra columns carry names that the operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rid string, rhash string, row int, "
          "score string, bucket string, cid string, place string, run int, y int, x string")
WORDS = ["the", "of", "and", "to", "in", "river", "stone", "cloud", "Harbour", "lantern", "écluse", "straße", "日本", "a1"]


def text(rng, n, lines=False):
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]))
        out.append("\n" if lines and rng.random() < 0.15 else " ")
    return "".join(out).strip(" ")


def rows(texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return [(i, t, "en", "s", None if t is None else len(t), "r", "h", 1, "s", "b", "c", "p", 2, 3, "x")
            for i, t in zip(ids, texts)]


def table(spark, texts, ids=None, parts=3):
    return spark.createDataFrame(rows(texts, ids), SCHEMA).repartition(parts)


def edge_texts():
    """Null, empty, blank, tiny, repeated, hostile and very long texts; ids with
    a null, a repeat and a tie."""
    rng = random.Random(5)
    long = text(rng, 60_000, lines=True)
    base = text(rng, 80, lines=True)
    texts = [None, "", " \n\t ", "one", "one two", base, base, base + " more", "of " * 300, " x　y ퟿ \U0001f600",
             long, "#*$%&|<>" * 20, "A\nA\nA\nA", base, base, "\x00\x01 b\x1c c", "<|endoftext|> x", "cc by", ""]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 6, None, 14, 15, 16, None]
    return texts, ids
