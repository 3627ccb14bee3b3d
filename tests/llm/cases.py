"""Awkward rows that every operator on documents must take."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, mark string, score string, label string, parts string, rank string")   # the last six clash with inner names

SYLLABLES = ["ta", "ri", "mo", "ne", "su", "ké", "lo", "pa", "vi", "du"]


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(rng, n):
    out = []
    for k, w in enumerate(words(rng, n)):
        out.append(w + ("\n" if k % 9 == 8 else "\t " if k % 17 == 16 else " "))
    return "".join(out)


def documents(seed=1, n=40):
    """Rows of SCHEMA: copies, near copies, shared passages and lines, empty, null and very long texts, repeated rows."""
    rng = random.Random(seed)
    shared = prose(rng, 70)
    texts = [prose(rng, rng.randint(5, 160)) for _ in range(n)]
    texts[3] = texts[2]
    texts[4] = texts[2] + "one more word"
    texts[5] = texts[6] + shared + texts[7]
    texts[8] = shared + texts[8]
    texts[9] = texts[9] + shared
    texts[10] = shared[: len(shared) // 2] + "cut" + shared[len(shared) // 2:]
    texts[11] = "same " * 120
    texts[12] = "same " * 130
    texts[13], texts[14], texts[15], texts[16] = "", None, " \n\t ", "word"
    texts[17] = prose(rng, 30_000)
    texts[18] = texts[17]
    texts[19] = " x y A B c\x1cd \x00e"
    rows = [(k, t, ["en", "de", None][k % 3], f"src{k % 5}" if k % 7 else None, None if t is None else len(t),
             1, "m", "s", "l", "p", "r") for k, t in enumerate(texts)]
    rows.append(rows[2])                                             # a repeated row
    rows.append((None, texts[20], "en", "src1", None, None, None, None, None, None, None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def unique(rows):
    """(doc_id, text) of the rows with an id, once each."""
    return sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda r: r[0])
