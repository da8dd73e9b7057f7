import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
EXTRA = ("key", "id", "n", "part", "hash", "words", "place", "form", "score", "lang_pred", "row_number", "component_id")


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang]) rows, with further columns of clashing names."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in EXTRA:
            df = df.withColumn(name, df["source"])
        return df

    return build


@pytest.fixture(scope="session")
def rows():
    """Collects a table as a list of tuples, sorted."""

    def read(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))

    return read
