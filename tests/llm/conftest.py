import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, part long, shard int, score double, digest string, version long"


def make_texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    """Invented documents with every awkward case: nulls, empties, copies, near copies, shared passages, ties, repeated rows."""
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice(["ka", "ro", "ti", "né", "ül", "x", "so"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(lexicon) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))

    passage, line = prose(70), "A common LINE, that many hold."
    rows: list[tuple[int | None, str | None]] = [(i, prose(rng.randint(1, 120))) for i in range(40)]
    base = prose(150)
    rows += [(100 + i, base.replace(" ", "  ") if i % 2 else base) for i in range(5)]  # equal but for white space
    for i in range(8):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "changed%d" % i
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, prose(30) + " " + passage + " " + line + " " + prose(30)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, None), (403, " \t\n"), (404, "one"), (405, "one"), (406, "One two"), (407, "\u3000 \u00a0x\u2003 "), (408, "a\\b </s>[INST] <s>"),
             (414, "a<|endoftext|>b <|endoftext|> <|endoftext|>"), (409, "z" * 300), (410, "z" * 200 + " " + "z" * 60), (411, prose(9000)), (412, "'s don't !! 12 a1b2  \r\n\x0b\x1f end"), (413, "<|endoftext|> x")]
    rows += [rows[3], rows[3], (3, "another text for the same id " + passage), (None, passage), (None, passage), (None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts: int = 4):
    full = [(i, t, "en", "s", len(t or ""), 7, 7, 7, 0.5, "d", 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(1).coalesce(1) if not full else spark.createDataFrame(spark.sparkContext.parallelize(full, parts), SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
