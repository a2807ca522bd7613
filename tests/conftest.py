from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plumbline.session import builder  # noqa: E402

# The pilot extracts every expected result in these tests is worked out from.
PILOT = {
    "customers": """customer_id,customer_name,segment,status,created_date
c-001,Acme Retail,enterprise,active,2024/01/15
C002,Beacon Stores,SMB,Active,15-02-2024
c003,Cedar Health,Enterprise,ACTIVE,2024-03-01
C004,Delta Foods,mid-market,active,2024/04/20
""",
    "sales_orders": """order_id,customer_id,order_date,order_amount,currency,category
so-1001,c-001,2026/08/30,1000.00,usd,online
SO1002,C002,31-08-2026,250.50,USD,Wholesale
so-1003,c003,2026-09-01,99.99,usd,RETAIL
SO-1004,C004,2026/09/01,"1,200.00",USD,Online
""",
    "gl_controls": """control_date,source_system,order_count,order_amount,currency
2026-08-30,ERP,1,1000.00,USD
2026-08-31,ERP,1,250.50,USD
2026-09-01,ERP,2,1299.99,USD
""",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        builder("plumbline-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.showConsoleProgress", "false")
        # Compiling a plan takes far longer than running it on a few rows.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def pilot_dir(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in PILOT.items():
        (raw / f"{name}.csv").write_text(text, encoding="utf-8")
    return raw


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))
