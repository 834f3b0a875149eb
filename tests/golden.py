"""A hand-sized set of staging tables with the marts they must give."""

import datetime as dt

from lanewise.plans.marts import Staging

D1, D2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)

REGIONS = [("world", None), ("europe", "world"), ("neu", "europe"), ("fjord", "neu"),
           ("asia", "world"), ("china", "asia")]
PORTS = [(1, "NOOSL", "fjord"), (2, "CNSHA", "china"), (3, "DEHAM", "neu"), (4, "XXUNK", None)]
RATES = [(D1, "USD", 1.0), (D2, "USD", 1.0), (D1, "EUR", 0.9)]
# d_id, origin, destination, from, to, company, supplier, equipment, active
DATAPOINTS = [
    (11, 1, 2, D1, D2, 1, 2, 1, True),
    (12, 1, 2, D1, D1, 2, 1, 1, True),
    (13, 1, 2, D1, D1, 3, 2, 1, True),
    (14, 1, 2, D1, D1, 4, 1, 1, True),
    (15, 1, 2, D1, D1, 5, 2, 1, True),
    (20, 3, 2, D1, D1, 1, 1, 1, True),
    (30, 1, 3, D1, D1, 1, 1, 1, True),
    (40, 1, 4, D1, D1, 1, 1, 1, True),
    (50, 9, 2, D2, D1, 1, 1, 1, True),
    (60, 1, 2, D1, D1, 6, 2, 1, False),
]
CHARGES = [(11, "USD", 100.0), (11, "EUR", 90.0), (12, "USD", 200.0), (12, "GBP", 7.0),
           (13, "USD", 300.0), (14, "USD", 400.0), (15, "USD", 500.0), (20, "USD", 1000.0),
           (30, "USD", 50.0), (50, "USD", 5.0), (60, "USD", 9999.0)]

CLOSURE = {("asia", "world"), ("china", "asia"), ("china", "world"), ("europe", "world"),
           ("fjord", "neu"), ("fjord", "europe"), ("fjord", "world"), ("neu", "europe"),
           ("neu", "world"), ("world", "world")}


def _rows(lines):
    return [(o, d, 1, day, med, avg, ok) for o, d, day, med, avg, ok in lines]


PORT_MART = _rows([
    ("DEHAM", "CNSHA", D1, 1000.0, 1000.0, 0),
    ("NOOSL", "CNSHA", D1, 300.0, 320.0, 1),
    ("NOOSL", "CNSHA", D2, 100.0, 100.0, 0),
    ("NOOSL", "DEHAM", D1, 50.0, 50.0, 0),
    ("NOOSL", "XXUNK", D1, None, None, 0),
    (None, "CNSHA", D2, 5.0, 5.0, 0),
])
REGION_MART = _rows([
    ("europe", "asia", D1, 350.0, 433.33, 1),
    ("europe", "asia", D2, 100.0, 100.0, 0),
    ("europe", "china", D1, 350.0, 433.33, 1),
    ("europe", "china", D2, 100.0, 100.0, 0),
    ("europe", "europe", D1, 50.0, 50.0, 0),
    ("europe", "neu", D1, 50.0, 50.0, 0),
    ("europe", None, D1, None, None, 0),
    ("fjord", "asia", D1, 300.0, 320.0, 1),
    ("fjord", "asia", D2, 100.0, 100.0, 0),
    ("fjord", "europe", D1, 50.0, 50.0, 0),
    ("fjord", None, D1, None, None, 0),
    ("neu", "asia", D1, 1000.0, 1000.0, 0),
    ("neu", "asia", D1, 300.0, 320.0, 1),
    ("neu", "asia", D2, 100.0, 100.0, 0),
    ("neu", "china", D1, 300.0, 320.0, 1),
    ("neu", "china", D2, 100.0, 100.0, 0),
    ("neu", None, D1, None, None, 0),
    ("world", None, D1, None, None, 0),
    (None, "asia", D2, 5.0, 5.0, 0),
    (None, "china", D2, 5.0, 5.0, 0),
    (None, "world", D2, 5.0, 5.0, 0),
])


def staging(spark) -> Staging:
    return Staging(
        datapoints=spark.createDataFrame(
            DATAPOINTS,
            "d_id bigint, origin_pid int, destination_pid int, valid_from date, valid_to date,"
            " company_id int, supplier_id int, equipment_id int, is_active boolean",
        ),
        charges=spark.createDataFrame(CHARGES, "d_id bigint, currency string, charge_value double"),
        exchange_rates=spark.createDataFrame(RATES, "day date, currency string, rate double"),
        ports=spark.createDataFrame(PORTS, "pid int, code string, slug string"),
        regions=spark.createDataFrame(REGIONS, "slug string, parent string"),
    )
