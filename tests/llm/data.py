"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo zu".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(r, size):
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(size))


def corpus(seed=5, size=60):
    """(id, text): copies, near copies, chains of near copies, a shared passage, and edge cases."""
    r = random.Random(seed)
    base = [sentence(r, r.randint(1, 120)) for _ in range(size)]
    passage = sentence(r, 40)
    rows = [(k, t) for k, t in enumerate(base)]
    for k in range(size, size + 30):
        w = r.choice(base).split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = sentence(r, 1)
        rows.append((k, " ".join(w)))
    for k in range(size + 30, size + 40):
        rows.append((k, f"{sentence(r, r.randint(5, 40))}\n{passage}\t{sentence(r, 10)}"))
    chain = sentence(r, 200).split()
    for k in range(size + 40, size + 48):
        chain = chain[:5] + [*chain[5:-12], *sentence(r, 12).split()]
        rows.append((k, " ".join(chain)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "Word"), (904, "WORD"), (905, "a b c d"), (906, "A  b\tc d")]
    rows += [(907, sentence(r, 30_000)), (908, "é ü 漢字 😀 " * 20), (909, "x" * 5000), (910, base[0]), (911, "one " * 300)]
    r.shuffle(rows)
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(k, t, "en", f"src{(k or 0) % 3}", len(t or "")) for k, t in rows], DOCS).repartition(3)
