import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventloom import schemas  # noqa: E402
from eventloom.session import local_session  # noqa: E402

BASE = "http://localhost:8080/rest"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Build canonical events from keyword rows."""
    from eventloom.operators.events import canonicalise

    def build(*rows):
        names = schemas.EVENT.fieldNames()
        data = [tuple(r.get(n) for n in names) for r in rows]
        return canonicalise(spark.createDataFrame(data, schemas.EVENT))

    return build


@pytest.fixture
def triples(spark):
    """Build triples from (subject, predicate, object, kind[, doc[, ord[, datatype]]])."""

    def build(*rows):
        data = []
        for n, row in enumerate(rows):
            s, p, o, kind, doc, ord_, datatype = (*row, *(None,) * (7 - len(row)))
            position = n if ord_ is None else ord_
            data.append((None, s, p, o, kind, datatype, None, doc or s.split("#")[0], position))
        return spark.createDataFrame(data, schemas.TRIPLE)

    return build
