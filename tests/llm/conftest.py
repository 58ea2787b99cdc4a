import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts, or (doc_id, text) or (doc_id, text, lang) tuples."""
    def make(rows, schema=SCHEMA):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            full.append((row[0], row[1], row[2] if len(row) > 2 else "en", "s", len(row[1]) if row[1] is not None else None))
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def messy(docs_of):
    """Nulls, empty and blank texts, repeated rows, one very long text."""
    return docs_of([
        (1, "One two three four.\nFive six.\nSeven eight nine."), (2, None), (3, ""), (4, " \n\t "),
        (None, "A text without an id."), (1, "One two three four.\nFive six.\nSeven eight nine."),
        (None, None), (5, "word " * 30_000), (6, "x"), (7, "123 456 !!"), (8, "Žluťoučký kůň 漢字 ▁ K", None)])


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def odd_columns(messy):
    """The same rows with columns that bear the names of things the operators make."""
    from pyspark.sql import functions as F
    return messy.select("*", *[F.lit(1).alias(c) for c in (
        "row", "a", "b", "node", "root", "fingerprint", "start", "end", "lines", "ids", "score", "held_out", "words",
        "item_id", "name", "n", "word", "unit", "covered", "template", "llm__k9")])
