import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from turnmeter.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", 4, extra={"spark.checkpoint.dir": ckpt,
                                            "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()
