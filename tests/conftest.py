import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loadsplit.session import checkpoint_root, get_spark
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    checkpoint_root(s)
    yield s


@pytest.fixture()
def scratch(spark):
    from loadsplit.session import scratch_path
    return lambda name: scratch_path(spark, name)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def write_meter_file(root: str, day: dt.date, rows: list[dict], columns: list[str] | None = None) -> str:
    """Plain-Python fixture writer for the reference file layout."""
    from loadsplit.constants import RAW_COLUMNS
    columns = columns or list(RAW_COLUMNS)
    d = os.path.join(root, f"{day:%Y}", f"{day:%m}")
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, f"{day:%Y%m%d}.csv")
    with open(path, "w") as f:
        f.write(",".join(columns) + "\n")
        for r in rows:
            f.write(",".join(str(r[c]) for c in columns) + "\n")
    return path


def day_rows(day: dt.date, esiid: str = "1234567890", kwh=None, n: int = 96) -> list[dict]:
    """n 15-minute rows of one day in the raw export format."""
    out = []
    for i in range(n):
        h0, m0 = divmod(i * 15, 60)
        h1, m1 = divmod((i + 1) * 15, 60)
        out.append({
            "ESIID": f"'{esiid}",
            "USAGE_DATE": f"{day:%m/%d/%Y}",
            "REVISION_DATE": f"{day + dt.timedelta(days=1):%m/%d/%Y} 07:40:29",
            "USAGE_START_TIME": f" {h0:02d}:{m0:02d}",
            "USAGE_END_TIME": f" {h1:02d}:{m1:02d}",
            "USAGE_KWH": kwh(i) if callable(kwh) else (kwh if kwh is not None else round(0.1 + i * 0.001, 3)),
            "ESTIMATED_ACTUAL": "A",
            "CONSUMPTION_SURPLUSGENERATION": "Consumption",
        })
    return out
