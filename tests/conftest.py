import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    # Hundreds of tiny jobs: compiling each plan would take longer than running it.
    quick = {
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.shuffle.partitions": "2",
        # Tests of plans take those after a place in this list, which must not be shortened in between.
        "spark.sql.ui.retainedExecutions": "50000",
    }
    session = local_session(4, memory="4g", conf=quick)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema, with ISO strings turned into dates where the schema says date."""

    def build(rows, schema):
        kinds = [column.split()[1] for column in schema.split(", ")]
        typed = [
            tuple(date.fromisoformat(v) if k == "date" and v else v for k, v in zip(kinds, row))
            for row in rows
        ]
        return spark.createDataFrame(typed, schema)

    return build
