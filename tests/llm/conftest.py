import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]


def prose(seed, n):
    """Repeatable words: a small generator, so that fixtures need no randomness."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 50))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a long text, clashing names."""
    rows = [
        (0, prose(1, 60), "en", "a.org", 1),
        (1, prose(1, 60), "en", "a.org", 1),
        (2, prose(1, 59) + " changed", None, "a.org", 1),
        (3, None, "en", "a.org", 0),
        (4, "", "de", None, 0),
        (5, " \n\t \x0b", "de", "b.org", 0),
        (6, "one two", "en", "b.org", 0),
        (7, "ONE two", "en", "b.org", 0),
        (8, prose(8, 30_000), "en", "b.org", 0),
        (9, prose(9, 40), None, None, 0),
        (9, prose(9, 40), None, None, 0),
        (None, prose(10, 20), "en", "b.org", 0),
        (11, "déjà vu 梦 \U0001f600 \x00 <|endoftext|> <s>", "fr", "b.org", 0),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = {c: "source" for c in ("chunk", "row", "keys", "kept", "site", "class", "n", "arc", "order", "set_id")}
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *(df[v].alias(k) for k, v in clash.items()))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
