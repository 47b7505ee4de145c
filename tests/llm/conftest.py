import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from a list of texts; an extra column with a clashing name."""

    def make(texts, ids=None, langs=None, sources=None, parts=3):
        rows = [
            (
                i if ids is None else ids[i],
                t,
                "en" if langs is None else langs[i],
                "s" if sources is None else sources[i],
                None if t is None else len(t),
                "x",
            )
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCS).repartition(parts) if rows else spark.createDataFrame([], DOCS)

    return make
