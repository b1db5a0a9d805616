import random

import pytest

EXTRA = "id long, key string, row string, part int, kind string, score string, component string, n_tokens string, text_hash int"


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empty and long texts, copies, near copies, shared passages, repeated rows and keys."""
    rng = random.Random(4)
    syllables = "the and er on re ing tion st ou le de é ç ß".split()

    def prose(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))

    base, passage, other = prose(120), prose(60), prose(200)
    near = base.split()
    near[60] = "changed"
    rows = [
        (10, base),
        (3, base),  # an exact copy under a smaller id
        (11, " ".join(near)),
        (12, prose(40) + " " + passage + " " + prose(40)),
        (7, passage + "\n" + prose(30)),
        (13, passage),
        (14, None),
        (15, ""),
        (16, " \t\n "),
        (17, "one"),
        (18, "ONE"),
        (19, "one two"),
        (20, "12 34 !!"),
        (21, prose(9000)),  # very long
        (22, "aa " * 300),
        (23, "ab" * 700),
        (24, other),
        (24, other),  # a repeated row
        (24, prose(50)),  # another text under the same id
        (None, other + " " + prose(3)),
        (None, base),
        (None, None),
        (25, "Ünïcode ΑΣ 日本語 🙂 <|endoftext|> don't " + passage.upper()),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The same as a table with the columns of documents and more, whose names clash with the operators' own."""
    rows = [(i, t, ("en", "fr", None)[k % 3], f"s{k % 2}", len(t) if t else 0) for k, (i, t) in enumerate(edge_rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return docs.selectExpr("*", "7L AS id", "'k' AS key", "'r' AS row", "1 AS part", "'x' AS kind", "'y' AS score", "'c' AS component", "'n' AS n_tokens")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def rows_of(frame, *columns):
    """Rows of some columns in one order, bytes as bytes."""
    plain = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in frame.select(*columns).collect()]
    return sorted(plain, key=repr)
