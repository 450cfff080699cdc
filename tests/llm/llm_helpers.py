"""Small tables and brute-force versions for the operators' tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def texts(seed=0, n=40):
    """Random texts with shared passages, exact and near copies, empty and null ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "Ab", "ab"]
    passage = [rng.choice(vocabulary) for _ in range(9)]
    out = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 4, 30, 60)))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        if i % 7 == 3 and out:
            w = list(words(out[-1]))
            if i % 2 and w:
                w[rng.randrange(len(w))] = "edited"
        out.append(rng.choice((" ", "\n", "\t ")).join(w))
    return [*out, "", "  \n", None, out[3], out[3]]


def docs(spark, rows=None, extra=""):
    rows = list(enumerate(texts())) if rows is None else rows
    return spark.createDataFrame(rows, f"doc_id long, text string{extra}")
