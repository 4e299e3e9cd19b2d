"""Hand-made inputs: stores with versions, sales files, and a change log."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

STORE_IDS = ["SYD01", "MEL01", "MEL02", "BNE02", "PER01", "CBR01", "AKL01", "AKL02", "WLG01"]
ITEMS = [
    {"id": "Green", "size": "L", "notes": None, "cost": 4.5, "ingredients": ["Apple", "Kale"]},
    {"id": "Custom", "size": "S", "notes": "no ice", "cost": 6.25, "ingredients": []},
]


def stores(spark: SparkSession) -> DataFrame:
    rows = [
        (i, f"Store {i}", f"{i.lower()}@example.org", i[:3], f"{n} High St, Town, {i}", f"0{n}")
        for n, i in enumerate(STORE_IDS)
    ]
    return spark.createDataFrame(
        rows, "id string, name string, email string, city string, hq_address string, phone_number string"
    )


def sale(sale_id, ts=1640995200, store="SYD01", customer=1, state="COMPLETED", items=ITEMS, **more):
    """One sale as it is written to a file; ``items`` is stored as JSON text."""
    text = json.dumps(items) if isinstance(items, list) else items
    row = {
        "SaleID": sale_id,
        "ts": ts,
        "Location": store,
        "CustomerID": customer,
        "OrderSource": "online",
        "PaymentMethod": "cash",
        "STATE": state,
        "SaleItems": text,
        **more,
    }
    return {k: v for k, v in row.items() if v is not None}


def write_lines(path, rows) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


# seq, lsn, command, operation, id, plan, score: plans of members, six joining at once, then
# two renewals, one leaving and coming back, one leaving for good, one joining late
CAPTURE = [
    (1, 1, 1, 2, 11, "basic", "5.00"),
    (2, 1, 1, 2, 12, "basic", "7.25"),
    (3, 1, 1, 2, 13, "trial", "0.00"),
    (4, 1, 1, 2, 14, "team", "120.40"),
    (5, 1, 3, 2, 21, "trial", "1.10"),
    (6, 1, 3, 2, 22, " solo", "3.00"),
    (7, 2, 1, 3, 12, "basic", "7.25"),
    (7, 2, 1, 4, 12, "team", "8.25"),
    (8, 2, 2, 3, 11, "basic", "5.00"),
    (8, 2, 2, 4, 11, "solo", "5.50"),
    (9, 3, 1, 1, 13, "trial", "0.00"),
    (10, 3, 4, 3, 12, "team", "8.25"),
    (10, 3, 4, 4, 12, "team", "9.75"),
    (11, 4, 1, 2, 13, "basic", "2.20"),
    (12, 4, 2, 1, 22, " solo", "3.00"),
    (13, 5, 1, 2, 31, "team", "44.00"),
    (14, 5, 2, 3, 14, "team", "120.40"),
    (14, 5, 2, 4, 14, "solo", "99.99"),
]

SCD1 = {
    (11, "solo", "5.50"),
    (12, "team", "9.75"),
    (13, "basic", "2.20"),
    (14, "solo", "99.99"),
    (21, "trial", "1.10"),
    (31, "team", "44.00"),
}

SCD2 = {
    (11, "basic", "5.00", 1, 8),
    (11, "solo", "5.50", 8, None),
    (12, "basic", "7.25", 2, 7),
    (12, "team", "8.25", 7, 10),
    (12, "team", "9.75", 10, None),
    (13, "trial", "0.00", 3, 9),
    (13, "basic", "2.20", 11, None),
    (14, "team", "120.40", 4, 14),
    (14, "solo", "99.99", 14, None),
    (21, "trial", "1.10", 5, None),
    (22, " solo", "3.00", 6, 12),
    (31, "team", "44.00", 13, None),
}

CAPTURE_SCHEMA = (
    "`__$start_lsn` binary, `__$end_lsn` binary, `__$seqval` binary, `__$operation` int, "
    "`__$update_mask` binary, `__$command_id` int, Id int, Plan string, Score decimal(18,2)"
)


def capture(spark: SparkSession, rows=CAPTURE) -> DataFrame:
    def ten(n):
        return bytearray(n.to_bytes(10, "big"))

    return spark.createDataFrame(
        [
            (ten(lsn), None, ten(seq), op, None, cmd, i, plan, Decimal(score))
            for seq, lsn, cmd, op, i, plan, score in rows
        ],
        CAPTURE_SCHEMA,
    )


def scd1_set(df: DataFrame) -> set:
    return {(r["Id"], r["Plan"], str(r["Score"])) for r in df.collect()}


def scd2_set(df: DataFrame) -> set:
    def seq(bound):
        return None if bound is None else int.from_bytes(bound["__$seqval"], "big")

    return {
        (r["Id"], r["Plan"], str(r["Score"]), seq(r["valid_from"]), seq(r["valid_to"]))
        for r in df.collect()
    }
