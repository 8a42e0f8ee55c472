import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart import schemas  # noqa: E402
from lakemart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def _line(invoice="1", code="P1", text="RED BAG", pieces=2, at="2011-01-05 10:00:00", price="2.50", who="17850",
          country="France"):
    return (invoice, code, text, pieces, at, price, who, country)


@pytest.fixture(scope="session")
def edge_lines(spark):
    """One line per rule of the cleansing, as text-dated rows."""
    rows = [
        _line(),
        _line(),                                              # exact duplicate
        _line(invoice="C2"),                                  # cancelled
        _line(invoice="3", pieces=-1), _line(invoice="3", pieces=0),
        _line(invoice="3", pieces=100001), _line(invoice="3", pieces=None),
        _line(invoice="4", pieces=100000),                    # upper bound stays
        _line(invoice="5", price="0.00"), _line(invoice="5", price="50000.01"), _line(invoice="5", price=None),
        _line(invoice="6", price="0.01"), _line(invoice="6", price="50000.00"),
        _line(invoice="7", at=None),                          # no date
        _line(invoice="8", who=None), _line(invoice="9", who="nan"), _line(invoice="10", who="17850.0"),
        _line(invoice="11", text="  "), _line(invoice="12", text=None),
        _line(invoice="13", country="Atlantis"),
    ]
    text = "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, " \
           "UnitPrice string, CustomerID string, Country string"
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, text).withColumn("UnitPrice", F.col("UnitPrice").cast("decimal(10,2)"))


@pytest.fixture(scope="session")
def raw_schema():
    return schemas.RAW
