"""Small tables with the awkward rows that every operator must stand."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside, in place of more of the table's own.
CLASHING = (
    "content row key keys part bucket found shard size label labels features tree member words before after times "
    "target source_size class_id links n_links copies ids starts digest order number"
).split()

_random = random.Random(5)
SYLLABLES = "an the re tion es wh sh er ou ble é ñ ö in ing".split()


def words(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]


def text(n: int, seed: int) -> str:
    return " ".join(words(n, seed))


def documents() -> list[tuple]:
    """Normal, near and equal texts, NULL in each column, empty, blank, one-word and very long
    texts, ids that repeat with the same and another text, rows without an id."""
    near = words(60, 1)
    near[30] = "changed"
    rows = [
        (1, text(60, 1), "en", "a", 1),
        (2, " ".join(near), "en", "b", 1),
        (3, text(60, 1), "en", None, 1),
        (4, None, "fr", "a", 0),
        (5, "", "fr", "a", 0),
        (6, " \n\t ", "fr", "b", 4),
        (7, "Word", "fr", "c", 4),
        (8, "word. 12", None, "c", None),
        (9, text(40_000, 2), "fr", "a", 1),
        (10, "x" * 120_000, "fr", "c", 1),
        (11, text(50, 3), "de", "", 1),
        (11, text(50, 3), "de", "", 1),
        (11, text(50, 4), "de", "", 1),
        (None, text(50, 5), "de", "a", 1),
        (None, text(50, 5), "de", "a", 1),
        (None, None, None, None, None),
        (12, "Ünï 漢字 😀\r\n a  b \x1c c", "de", "a", 1),
        (13, "12345 !!", "en", "b", 1),
        (14, text(60, 1), "en", "a", 1),
    ]
    return rows


def frame(spark, rows=None, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(documents() if rows is None else rows, DOCUMENTS)
    return df.select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASHING)]) if clash else df


def duck(rows, name="documents", columns="doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT"):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    if rows:
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con


def plain(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])
