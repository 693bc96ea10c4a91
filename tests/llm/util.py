import pyarrow.parquet as pq

from tests.conftest import DATA

WORDS = "the of and river stone window paper le la maison jardin der die garten strasse el los camino ventana".split()


def texts_of_table(limit=None):
    rows = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    return rows[:limit] if limit else rows


def documents(spark, rows, extra=()):
    """(doc_id, text) rows, with columns whose names clash with those of results."""
    data = [(i, t, None, None, 1, "x", -1.0, 7) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars int, id string, score double, n_tokens int"
    return spark.createDataFrame(data, schema)
