"""Small made tables with the cases that operators must stand."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, root string, token string"


def documents(seed: int = 1, n: int = 60):
    """Copies, near copies, repeated rows, nulls, empty and long texts, no ids."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("aeiounrstldm", k=r.randint(2, 7))) for _ in range(250)]
    vocabulary += ["naïve", "Straße", "日本", "Of", "THE"]
    line = lambda: " ".join(r.choices(vocabulary, k=r.randint(1, 30)))
    shared = [line() for _ in range(4)]
    rows, texts = [], []
    for i in range(n):
        kind = r.random()
        if kind < 0.2 and texts:
            text = r.choice(texts)
        elif kind < 0.5 and texts:
            words = r.choice(texts).split(" ")
            words[r.randrange(len(words))] = r.choice(vocabulary)
            text = " ".join(words)
        else:
            text = "\n".join(r.choice(shared) if r.random() < 0.2 else line() for _ in range(r.randint(1, 8)))
        texts.append(text)
        rows.append((i * 3, text, "en", "hot" if i % 3 else f"s{i}", len(text)))
    rows += [
        (500, None, None, None, None),
        (501, "", "en", "hot", 0),
        (502, " \n\t\n ", "en", "hot", 5),
        (None, texts[0], "en", "hot", 1),
        (None, line(), None, "hot", 1),
        (503, "\n".join(line() for _ in range(900)), "en", "hot", 1),
        (504, texts[3].upper(), "en", "hot", 1),
        rows[5],
        rows[5],
    ]
    return [(*row, "x", "y", None) for row in rows]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
