import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assayframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "assayframe-tests")


@pytest.fixture
def values(spark):
    """Evaluate a column function on a list of inputs."""

    def run(fn, inputs, kind="string"):
        rows = [(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)]
        width = len(rows[0]) - 1
        schema = "i int, " + ", ".join(f"c{j} {kind}" for j in range(width))
        df = spark.createDataFrame(rows, schema)
        out = df.select("i", fn(*[df[f"c{j}"] for j in range(width)]).alias("out"))
        return [r["out"] for r in sorted(out.collect(), key=lambda r: r["i"])]

    return run
