"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside; they must not disturb them.
EXTRA = "score double, key string, size long, copies int, batch long, tokens string, marks string, pool string"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng: random.Random, n: int, stock: int = 400) -> str:
    out = []
    for k in range(n):
        w = f"w{rng.randrange(stock)}"
        out.append(w + "." if k % 9 == 8 else w)
    return " ".join(out)


def awkward_rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randrange(1, 180)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 1)
            for i in range(n)]
    base = sentence(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows += [(100, base, "en", "a", 1), (101, base, "en", "b", 1), (102, " ".join(near), "de", "a", 1),
             (103, None, "en", "a", None), (104, "", None, None, 0), (105, " \t\n\r ", "en", "c", 5),
             (106, "one two", "en", "a", 7), (107, "one two", "en", "a", 7), (108, "A" * 400, "en", "a", 400),
             (109, "For " * 3000, "en", "b", 12000), (110, "äöü ñandú 中文字符 \U0001f600 é" * 40, "de", "c", 9),
             (111, sentence(rng, 20000), "en", "a", 1), (112, base + " " + sentence(rng, 40), "en", "a", 1),
             (106, "one two", "en", "a", 7), (None, base, "en", "a", 1), (None, sentence(rng, 70), None, None, None),
             (113, "line one here\n" * 30 + base, "en", "b", 1)]
    return rows


def frame(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for col in EXTRA.split(", "):
            name, kind = col.split(" ")
            df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return df
