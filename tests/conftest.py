import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from normwerk.session import build_session

    # on a few rows, compiling a stage takes longer than running it
    quick = {"spark.sql.codegen.wholeStage": "false", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    session = build_session("local[4]", **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g"}, **quick)
    session.sparkContext.setLogLevel("ERROR")
    yield session
