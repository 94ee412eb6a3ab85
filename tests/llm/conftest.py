import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def prose(seed: int, n: int) -> str:
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x >> 8 & 15] + WORDS[x >> 16 & 15])
    return " ".join(out)


def edge_rows():
    """Null, empty, wordless, short, long, equal, near equal and repeated rows."""
    base = prose(1, 120)
    rows = [(0, base), (1, base), (2, base.replace("alphabeta", "other", 1)), (3, None), (4, None), (5, ""), (6, ""),
            (7, " \n\t"), (8, "one two"), (9, "One two"), (10, prose(2, 30) + " " + base), (11, prose(3, 4000)),
            (12, "é" * 500), (13, "ab" * 600), (14, "!!! ???"), (15, prose(4, 60)), (15, prose(4, 60)), (None, prose(5, 40)),
            (16, prose(5, 40)), (17, "naïve café İstanbul ß " * 30)]
    return [(i, t, "en", "s", len(t) if t else None, "x") for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
