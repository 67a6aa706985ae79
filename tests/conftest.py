from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("TZ", "UTC")

from tillstream import session  # noqa: E402


def make_session():
    spark = session.build("tests", "local[8]", **{
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tillstream-tests-"),
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


_SEED: dict[str, str] = {}


def stored_seed(spark):
    """The sample rows as stored tables, written once per test run."""
    from tillstream.sources.seed import load_seed
    from tillstream.specs import spec
    if not _SEED:
        base = session.run_dir(spark, "seed")
        for name, df in load_seed(spark).items():
            df.coalesce(1).write.parquet(f"{base}/{name}")
            _SEED[name] = f"{base}/{name}"
    return {n: spark.read.schema(spec(n).schema()).parquet(p) for n, p in _SEED.items()}
