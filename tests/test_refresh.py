"""Marts that follow batches equal marts built anew, and leave other days alone."""

import datetime as dt
import random
from collections import Counter

from lanewise.operators.intervals import clip, clip_to, expand_days
from lanewise.plans import marts
from lanewise.plans.refresh import refresh, touched_days
from lanewise.streaming.deliveries import stage_pending
from test_stream import HEAD, Inbox

FIRST = dt.date(2021, 1, 1)


def day(n):
    return FIRST + dt.timedelta(days=n)


def datapoints(rng, ids):
    lines = [HEAD]
    for i in ids:
        start = rng.randint(0, 20)
        last = start + rng.choice([0, 1, 4])
        lines.append(
            f"{i},2021-01-01 00:00:00,{rng.randint(1, 3)},{rng.randint(4, 6)},{day(start)},{day(last)},"
            f"{rng.randint(1, 9)},{rng.randint(1, 9)},1"
        )
    return "\n".join(lines) + "\n"


def charges(rng, ids):
    lines = [f"{i},{rng.choice(['USD', 'EUR'])},{rng.randint(10, 900)}" for i in ids]
    return "\n".join(["d_id,currency,charge_value", *lines]) + "\n"


def files_by_day(root):
    out = {}
    for p in root.rglob("*.parquet"):
        out.setdefault(p.parent.name, set()).add((p.name, p.stat().st_mtime_ns))
    return out


def test_refreshed_marts_equal_rebuilt_ones(spark, tmp_path):
    rng = random.Random(5)
    inbox = Inbox(spark, tmp_path)
    wh, path = inbox.warehouse, str(tmp_path / "mart")

    def batch(**files):
        for name, text in files.items():
            inbox.put(f"{name}.csv", text)
        inbox.load()
        stage_pending(wh)
        before = files_by_day(tmp_path / "mart")
        days = refresh(wh, marts.prices_ds, path)
        after = files_by_day(tmp_path / "mart")
        rebuilt = marts.prices_ds(wh.tables())
        got = spark.read.schema(rebuilt.schema).parquet(path).select(*rebuilt.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rebuilt.collect()))
        if days is not None:
            within = {f"date={day(n)}" for n in range(60) for a, b in days if a and a <= day(n) <= b}
            assert {d: f for d, f in before.items() if d not in within} == {
                d: f for d, f in after.items() if d not in within
            }
        return days

    rates = [f"{day(n)},{c},{2 if c == 'EUR' else 1}" for n in range(26) for c in ("USD", "EUR") if (n, c) != (3, "EUR")]
    assert batch(
        regions_1="slug,name,parent\nw,W,\neu,,w\nas,,w\ne,E,eu\nf,F,as\ng,G,eu\n",
        ports_1="pid,code,slug,name,country,country_code\n" + "".join(f"{i},P{i},{'eg'[i % 2] if i < 4 else 'f'},n,,\n" for i in range(1, 6)),
        exchange_rates_1="\n".join(["day,currency,rate", *rates]) + "\n",
        charges_1=charges(rng, [*range(60)] * 2),
        datapoints_1=datapoints(rng, range(60)),
    ) is None
    assert refresh(wh, marts.prices_ds, path) == []
    days = batch(datapoints_2=datapoints(rng, [3, 61]) + f"4,2021-01-01 00:00:00,1,4,{day(40)},{day(41)},1,1,1\n", charges_2=charges(rng, [61]))
    assert days and (day(40), day(41)) in days
    assert batch(exchange_rates_2=f"day,currency,rate\n{day(3)},EUR,4\n") == [(day(3), day(3))]
    # The version of day 40 goes, and with it the days' last rows.
    batch(datapoints_3=f"{HEAD}\n4,2021-01-01 00:00:00,1,4,{day(0)},{day(0)},1,1,1\n", charges_3=charges(rng, [7]))
    assert f"date={day(40)}" not in files_by_day(tmp_path / "mart")
    late_port = batch(ports_2="pid,code,slug,name,country,country_code\n6,P6,f,n,,\n")
    assert late_port
    assert batch(regions_2="slug,name,parent\nh,H,as\n") is None
    assert touched_days(wh, wh.done(), wh.done()) == []


def test_clipping_to_stretches(spark):
    rng = random.Random(1)
    rows = [(i, day(a), day(a + rng.randint(-2, 12))) for i in range(80) for a in [rng.randint(0, 40)]]
    rows += [(100, None, day(3)), (101, day(4), None)]
    frame = spark.createDataFrame(rows, "d_id int, valid_from date, valid_to date")
    days = [(day(2), day(4)), (day(6), day(6)), (day(20), day(33))]
    every = [tuple(r) for r in expand_days(frame).collect()]
    for chosen in (days, [*days, (None, None)], [(None, None)], []):
        got = [tuple(r) for r in expand_days(clip_to(frame, chosen)).collect()]
        assert sorted(map(str, got)) == sorted(
            str((i, d)) for i, d in every
            if any((a is None and d is None) or (a and d and a <= d <= b) for a, b in chosen)
        )
    one = expand_days(clip(frame, day(2), day(4))).collect()
    assert sorted(map(str, one)) == sorted(map(str, expand_days(clip_to(frame, days[:1])).collect()))
