"""Small tables for the tests: the columns of the real ones, and odd rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names the operators use themselves
CLASHING = SCHEMA + ", key string, size long, seq long, block int, fp long, score double, h long, rep long, word string"


def documents(spark, texts, ids=None, source=lambda i: f"src{i % 3}", clash=False):
    rows = []
    for i, t in enumerate(texts):
        d = ids[i] if ids is not None else i
        row = (d, t, "en", source(i), None if t is None else len(t))
        rows.append(row + (("k", 5, 1, 2, 3, 0.5, 4, 6, "w") if clash else ()))
    return spark.createDataFrame(rows, CLASHING if clash else SCHEMA)


def odd_texts(seed=5, n=80):
    """Passages shared by several texts, blanks of all kinds, empty, null, long and repeated texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    shared = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80))) for _ in range(25)]
    texts = []
    for _ in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.5
                 else " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 4))]
        ws = " ".join(parts).split()
        if ws and rnd.random() < 0.3:
            ws[rnd.randrange(len(ws))] = "Zz é"
        texts.append(rnd.choice([" ", "  ", "\n", "\x0b"]).join(ws))
    return texts + [None, "", "   ", "x " * 300, "ab" * 500, texts[3], texts[3].upper(), texts[5], "é" * 3000]


def odd_documents(spark, clash=False):
    """Odd texts; three rows without id, one id on two texts, one row twice."""
    texts = odd_texts()
    ids = list(range(len(texts)))
    texts += [texts[0], texts[1], texts[7], texts[9], texts[4]]
    ids += [None, None, 7, 2, None]
    return documents(spark, texts, ids, clash=clash), list(zip(ids, texts))


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
