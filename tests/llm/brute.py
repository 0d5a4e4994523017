"""Tables of awkward rows that every operator must stand."""

from __future__ import annotations

#: Names that operators and stages use inside.
INSIDE = (
    "h k_h k_text k_doc_id k_own own root fp node label u v part key piece probe size spread range slot data spans kept "
    "removed a c start shape batch lo hi w l_h l_doc_id tox_score tox_predicted tox_text tox_features whole score row ids n"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, " + ", ".join(f"{c} string" for c in INSIDE)
SCHEMA += ", `a.b` array<int>, nest struct<`x y`:int>"


def awkward(spark, texts=()):
    """Null and empty texts, null and repeated ids, repeated rows, extra columns with names that operators use inside."""
    long = "alpha beta gamma delta " * 3000
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (4, "two words"), (None, "one"), (None, None), (5, long),
        (6, long), (7, "é ß 漢字 \U0001f600 é ß 漢字"), (-8, "ONE"), *texts,
    ]
    rows = [(i, t, None, "s", None, 3, *INSIDE, [1, None], (2,)) for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
