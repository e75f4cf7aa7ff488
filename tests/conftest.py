import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakestrata.session import build_session, work_folder  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.checkpoint.dir": f"/tmp/checkpoints/tests-{uuid.uuid4().hex}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh path in the shared work folder."""
    return work_folder(spark, "test")


@pytest.fixture
def files(tmp_path):
    """Writes text files into one fresh input folder; ``files.path`` names it."""
    class Files:
        path = str(tmp_path / f"input-{uuid.uuid4().hex}")

        def __call__(self, **contents):
            return self.write(contents)

        def write(self, contents):
            Path(self.path).mkdir(exist_ok=True)
            for name, text in contents.items():
                data = text if isinstance(text, bytes) else text.encode("utf-8")
                (Path(self.path) / name).write_bytes(data)
            return self.path

    return Files()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
