import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lintel.session import build_session
    s = build_session("local[*]", app_name="lintel-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_records(spark):
    from lintel.sources import io
    return io.read_records(spark, os.path.join(FIXTURES, "clinical_records.csv"), "csv")


def record_rows(spark, rows):
    """Typed record DataFrame from tuples in RECORD column order (date as ISO text)."""
    from pyspark.sql import functions as F
    from lintel.schemas import RECORD_COLUMNS
    df = spark.createDataFrame(rows, "record_id string, patient_id string, source string, field_name string, "
                                     "value double, unit string, expected_unit string, ref_low double, "
                                     "ref_high double, data_received_date string")
    return df.withColumn("data_received_date", F.to_date("data_received_date")).select(*RECORD_COLUMNS)
