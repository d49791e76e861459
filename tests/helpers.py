"""Small frames for tests."""

from __future__ import annotations

from datetime import date, timedelta

from daygrid.schemas import COINS, PRICE_SNAPSHOTS

TARGET = date(2025, 11, 24)

# Days before TARGET: {entity: (price, cap, volume)}. There are gaps before -14 and -6, the caps swap
# places between -14 and TARGET, and one entity is new on TARGET.
SCENARIO = {
    -30: {"alder": (40, 700, 61), "birch": (15, 900, 82)},
    -14: {"alder": (44, 950, 64), "birch": (16, 880, 80)},
    -6: {"alder": (47, 610, 66), "birch": (18, 905, 71)},
    -5: {"alder": (48, 620, 67), "birch": (17.5, 890, 73)},
    -4: {"alder": (46, 600, 69), "birch": (18.5, 915, 75)},
    -3: {"alder": (49, 640, 70), "birch": (19, 930, 74)},
    -2: {"alder": (51, 655, 72), "birch": (18, 900, 77)},
    -1: {"alder": (50, 650, 71), "birch": (20, 940, 79)},
    0: {"alder": (55, 720, 75), "birch": (19, 925, 78), "cedar": (2.5, 310, 12)},
}


def before_target(days: int) -> date:
    return TARGET - timedelta(days)


def panel_of(spark, rows):
    """Rows of (entity, day, price, cap, volume); the other measures are NULL."""

    def number(value):
        return None if value is None else float(value)

    data = [(e, d, number(p), number(c), number(v), None, None) for e, d, p, c, v in rows]
    return spark.createDataFrame(data, PRICE_SNAPSHOTS)


def scenario_panel(spark):
    return panel_of(
        spark, [(e, before_target(-k), *values) for k, entities in SCENARIO.items() for e, values in entities.items()]
    )


def scenario_coins(spark):
    return spark.createDataFrame(
        [
            ("alder", "ALD", "Alder", 8200000.0, 9000000.0),
            ("birch", "BIR", "Birch", 310000.0, None),
            ("cedar", "CED", "Cedar", 44000000.0, None),
        ],
        COINS,
    )


def by_key(df, *keys):
    keys = keys or ("coin_id", "snapshot_date")
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def days_from(start: date, count: int):
    return [start + timedelta(days=i) for i in range(count)]
