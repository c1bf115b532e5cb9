import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from coverloom.session import get_spark, tune  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
                                          "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return tune(s)


@pytest.fixture(scope="session")
def star(spark):
    from coverloom.catalog.star import Star

    return Star(spark, SF)


@pytest.fixture
def frame(spark):
    """``frame(schema, {...}, ...)``: rows by column name, missing ones NULL."""

    def make(schema, *rows):
        unknown = {c for r in rows for c in r} - set(schema.fieldNames())
        assert not unknown, unknown
        return spark.createDataFrame([tuple(_value(f.dataType, r.get(f.name)) for f in schema) for r in rows], schema)

    return make


def _value(kind, v):
    return Decimal(str(v)) if v is not None and isinstance(kind, T.DecimalType) else v


def rows(df, *cols):
    """Sorted value tuples, NULL lowest."""
    got = [tuple(r) for r in (df.select(*[f"`{c}`" for c in cols]) if cols else df).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
