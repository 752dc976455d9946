"""Small documents that hold what every operator must stand: nulls, empty and long texts, ties, repeats."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)]


def documents(seed=1, n=40):
    """Rows (doc_id, text, ...) with exact copies, near copies, shared lines and passages."""
    rng = random.Random(seed)
    shared = [" ".join(words(rng, 12)) for _ in range(3)]
    passage = words(rng, 30)
    out = []
    for i in range(n):
        w = words(rng, rng.randint(5, 120))
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = passage
        lines = [" ".join(w[a : a + 15]) for a in range(0, len(w), 15)]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), "  " + shared[i % 9 // 3].upper() + "\t")
        out.append("\n".join(lines))
    out += [out[1], out[1], out[2] + " zz", "", None, " \n\n ", "ä ö ü ß 漢字 👍", " ".join(words(rng, 3000))]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(out)]
    return rows + [rows[3], (None, out[4], None, None, None), (None, None, None, None, None)]
