import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallymark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def rows(spark):
    """DataFrame from a SQL VALUES text: rows("a int, b string", "(1, 'x')")."""

    def make(ddl: str, values: str):
        fields = [part.strip().split(" ", 1) for part in _split(ddl)]
        names = ", ".join(name for name, _ in fields)
        casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
        return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")

    return make


def _split(ddl: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for char in ddl:
        depth += (char in "<(") - (char in ">)")
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    return parts + [current]
