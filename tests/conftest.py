from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerloom.session import configure  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.log.level", "ERROR").getOrCreate()
    )
    yield configure(s)
    s.stop()


@pytest.fixture(scope="session")
def house(spark):
    from parity.registry import warehouse

    return warehouse(spark, SF)


@pytest.fixture()
def frame(spark):
    """Small DataFrame from rows and a DDL schema; date and time texts are cast."""

    def make(rows, ddl):
        from pyspark.sql import functions as F
        from pyspark.sql.types import StructType

        target = StructType.fromDDL(ddl)
        text = ", ".join(f"{f.name} string" for f in target)
        raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], text)
        return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])

    return make
