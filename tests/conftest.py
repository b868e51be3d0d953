from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from segmentry.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture(scope="session")
def sample_reviews():
    """Feedback on a few appliances; every text differs, with markup, addresses and accents here and there."""
    things, faults = ["kettle", "lamp", "vacuum", "fan", "radio"], ["<b>hums</b>", "café-proof", "write to a@b.org", "leaks   oil"]
    rng, out = np.random.default_rng(11), []
    for serial in rng.permutation(1000)[:100].tolist():
        thing, fault = things[serial % len(things)], faults[serial // 7 % len(faults)]
        text = f"Unit {serial}: my {thing} {fault}, used on {serial % 31} days."
        shelf, buyer = f"{thing}/{serial % 9}", f"b{serial // 40}"
        out.append({"id": f"{thing}-{serial}", "text": text, "rating": f"{rng.integers(1, 6)}", "product_id": shelf, "customer_id": buyer})
    return out


@pytest.fixture(scope="session")
def unit_vectors():
    """Three groups on a sphere and some stray points."""
    rng = np.random.default_rng(7)
    centres = np.eye(16)[:3]
    points = np.concatenate([c + rng.normal(0, 0.05, (60, 16)) for c in centres] + [rng.normal(0, 1, (20, 16))])
    return points / np.linalg.norm(points, axis=1, keepdims=True)


@pytest.fixture(scope="session")
def vectors(spark, unit_vectors):
    rows = [(f"r{i:03d}", [float(x) for x in v]) for i, v in enumerate(unit_vectors)]
    return spark.createDataFrame(rows, "record_id string, embedding array<double>")
