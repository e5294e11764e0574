from __future__ import annotations

import json
import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from linetally.env import build_session
from linetally.schemas import RAW_ORDER


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "16",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


LOADED = datetime(2011, 2, 1)


def raw_row(**changes):
    """One RAW row; the period follows the invoice date unless given."""
    row = {
        "invoice_no": "536365",
        "stock_code": "85123A",
        "description": "WHITE HANGING HEART",
        "quantity": 6,
        "invoice_date": datetime(2011, 1, 4, 10, 0),
        "unit_price": 2.55,
        "customer_id": "17850",
        "country": "United Kingdom",
        "source_system": "batch_historical",
        "ingested_at": datetime(2011, 1, 31),
        "source_file": "orders/year=2011/month=1/part-0.snappy.parquet",
        "loaded_at": LOADED,
    } | changes
    row.setdefault("partition_year", row["invoice_date"].year)
    row.setdefault("partition_month", row["invoice_date"].month)
    return tuple(row[f] for f in RAW_ORDER.fieldNames())


@pytest.fixture(scope="session")
def raw_frame(spark):
    return lambda *rows: spark.createDataFrame([raw_row(**r) for r in rows], RAW_ORDER)


def landed(**changes) -> str:
    """One landed line as JSON text."""
    record = {
        "invoice_no": "536365",
        "stock_code": "85123A",
        "description": "WHITE HANGING HEART",
        "quantity": 6,
        "invoice_date": "2011-01-04T10:00:00",
        "unit_price": 2.55,
        "customer_id": "17850",
        "country": "United Kingdom",
        "source_system": "batch_historical",
        "ingested_at": "2011-01-31T00:00:00+00:00",
    } | changes
    return json.dumps(record)


def write_day(root, day: str, *lines: str, name: str = "orders.json") -> None:
    folder = Path(root) / f"event_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")


def dicts(df, *sort: str) -> list[dict]:
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in sort)) if sort else rows
