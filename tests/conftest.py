from __future__ import annotations

import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streammart.checks.views import Live  # noqa: E402
from streammart.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
FAR = pd.Timestamp("2040-01-01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=2)
    yield session
    session.stop()


@pytest.fixture
def small():
    return SMALL


def save_parts(frames: list[pd.DataFrame], folder: str) -> None:
    """Write files that a file stream reads in list order."""
    os.makedirs(folder, exist_ok=True)
    for i, pdf in enumerate(frames):
        path = f"{folder}/part-{i}.parquet"
        pdf.to_parquet(path, index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def chunks(pdf: pd.DataFrame, n: int) -> list[pd.DataFrame]:
    size = -(-len(pdf) // n)
    return [pdf.iloc[i : i + size] for i in range(0, len(pdf), size)]


@pytest.fixture(scope="session")
def live(tmp_path_factory):
    """The small tables cut into time-ordered files, closed by rows far in the future."""
    root = tmp_path_factory.mktemp("live")

    events = pd.read_parquet(f"{SMALL}/events.parquet").sort_values("ts")
    last = events.groupby("event_type").tail(1).assign(
        ts=FAR, user_id=10**6, event_id=10**6, value=1.5, props='{"k": 1}'
    )
    save_parts([*chunks(events, 3), last], f"{root}/events.parquet")

    orders = pd.read_parquet(f"{SMALL}/orders.parquet").sort_values("o_orderkey")
    lines = pd.read_parquet(f"{SMALL}/lineitem.parquet").sort_values("l_orderkey")
    end = 10**8  # as an order key: decades after all others
    late_orders = pd.concat(
        [orders.head(1).assign(o_orderkey=end, o_orderstatus=s) for s in ("F", "O", "P")]
    )
    late_lines = pd.concat(
        [
            lines.head(1).assign(l_orderkey=end, l_returnflag="R", l_linestatus="F", l_discount=d)
            for d in (0.0, 0.1)
        ]
    )
    step = orders["o_orderkey"].max() // 3 + 1
    for name, pdf, key, closing in (
        ("orders", orders, "o_orderkey", late_orders),
        ("lineitem", lines, "l_orderkey", late_lines),
    ):
        parts = [pdf[pdf[key] // step == i] for i in range(3)]
        save_parts([*parts, closing], f"{root}/{name}.parquet")

    documents = pd.read_parquet(f"{SMALL}/documents.parquet").sort_values("doc_id")
    closing = documents.head(1).assign(doc_id=10 * end, text="end")
    save_parts([*chunks(documents, 3), closing], f"{root}/documents.parquet")

    for name in ("nation", "region", "part", "supplier", "customer"):
        pd.read_parquet(f"{SMALL}/{name}.parquet").to_parquet(f"{root}/{name}.parquet")
    folder = Live(str(root))
    folder.options = {"maxFilesPerTrigger": "1"}
    return folder


def collect(df, order=None):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def rows():
    return collect
