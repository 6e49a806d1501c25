"""mime_quarantine reads past any number of leading spaces, as its SQL does."""

from pyspark.sql import functions as F

from quire.functions import text as T


def test_many_spaces(spark):
    rows = [(" " * n + page,) for n in (0, 49, 60, 64, 5000) for page in ("<!DOCTYPE html><p>", "<HTML><body>")]
    assert {r[0] for r in spark.createDataFrame(rows, "x string").select(T.mime_of(F.col("x"))).collect()} == {"text/html"}
