"""Helpers for small frames with the awkward rows every operator must take."""

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows, extra=()):
        full = [(tuple(row) + (None,) * 4)[:4] + (len(row[1] or ""),) for row in rows]
        frame = spark.createDataFrame(full, DOCUMENTS).repartition(2)
        for name in extra:
            frame = frame.withColumn(name, F.lit("clash"))
        return frame

    return make
