"""Small tables with the cases every operator has to define."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, seed=7):
    """Nulls in every column, empty and long texts, copies, repeated rows, and columns named like results."""
    pick = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "é", "naïve", "日本語", "x1", "the", "of", "and"]
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    if rows is None:
        rows = [(i, text(pick.randint(1, 60))) for i in range(30)]
        rows += [(40, rows[3][1]), (41, rows[3][1]), (42, None), (43, ""), (44, text(4000)), (None, rows[5][1]), (45, "  \n ")]
        rows += [rows[8], rows[8], (46, rows[9][1] + " tail"), (47, text(300) + " " + rows[9][1])]
    full = [(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else "s", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS)


def plain(df):
    """(id, text) with a null text as an empty one."""
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def rows_of(df, *names):
    """The rows in an order that nulls do not disturb."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
