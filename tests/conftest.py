import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripkit.session import get_session
    wh = tempfile.mkdtemp(prefix="tripkit-wh-")
    s = get_session("local[*]", 8, app_name="tripkit-tests",
                    extra={"spark.sql.warehouse.dir": wh,
                           "spark.driver.extraJavaOptions": f"-Dderby.system.home={wh}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tripkit-test-")
