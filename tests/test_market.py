import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickframe.operators import bars as br
from tickframe.operators import gaps, indicators, integrity, liquidity, recurrence

NS = 10**9
DAY = 86_400 * NS
SCHEMA = "ticker string, sip_timestamp bigint, price double, size bigint"


def at(text: str) -> int:
    return int((dt.datetime.fromisoformat(text) - dt.datetime(1970, 1, 1)).total_seconds() * NS)


@pytest.fixture(scope="module")
def skewed(spark):
    """A ticker with most rows, many of them in one minute and some in one nanosecond, next to sparse ones."""
    rng = random.Random(5)
    start = at("2024-01-08T00:00:00")
    rows = [("HOT", start + 36_000 * NS + rng.randrange(60 * NS)) for _ in range(1500)]
    rows += [("HOT", start + 36_000 * NS)] * 20
    rows += [("HOT", start + rng.randrange(3 * DAY)) for _ in range(500)]
    rows += [(f"T{rng.randrange(40)}", start + rng.randrange(3 * DAY)) for _ in range(300)]
    frame = [(t, n, float(rng.randrange(1, 100)), rng.randrange(1, 9)) for t, n in rows]
    return spark.createDataFrame(frame, SCHEMA).cache()


@pytest.mark.parametrize("span", [60 * NS, DAY, 400 * DAY])
def test_gaps_equal_a_plain_window(skewed, span):
    day = F.col("sip_timestamp") - F.pmod("sip_timestamp", F.lit(span))
    rows = skewed.withColumn("day", day)
    counted = gaps.gap_counts(rows, ["ticker", "day"], "sip_timestamp", {"size": F.col("size")})
    got = counted.groupBy("ticker", "day", "gap_sec").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("ticker", "day").orderBy("sip_timestamp")
    step = F.call_function("div", F.col("sip_timestamp") - F.lag("sip_timestamp").over(w), F.lit(NS).cast("bigint"))
    want = rows.withColumn("gap_sec", step).groupBy("ticker", "day", "gap_sec").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert counted.agg(F.sum("size")).first()[0] == skewed.agg(F.sum("size")).first()[0]


def test_daily_liquidity_against_pandas(skewed):
    pdf = skewed.toPandas().sort_values("sip_timestamp", kind="stable")
    pdf["date"] = pd.to_datetime(pdf.sip_timestamp).dt.date
    want = {}
    for key, group in pdf.groupby(["ticker", "date"]):
        steps = (group.sip_timestamp.diff().dropna() // NS).astype(float)
        median = steps.median() if len(steps) else None
        want[key] = (len(group), float((group.price * group["size"]).sum()), median)
    got = {
        (r.ticker, r.date): (r.daily_trades, r.daily_dollar_volume, r.daily_mtbt_sec)
        for r in liquidity.daily_liquidity(skewed).collect()
    }
    assert got == want


def test_lag_over_buckets_equals_a_plain_window(spark):
    rng = random.Random(1)
    rows = [("K" if rng.random() < 0.8 else "L", i, rng.randrange(9), rng.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, b int, v int")
    got = gaps.lag_over_buckets(df, ["k"], "b", ["i"], "v", "before").collect()
    want = df.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy("b", "i"))).collect()
    assert sorted(got, key=lambda r: r.i) == sorted(want, key=lambda r: r.i)


def test_tiers(values):
    rows = [
        (25e6, 5000.0, 30.0),
        (25e6 - 1, 5000.0, 30.0),
        (25e6, 4999.0, 30.0),
        (25e6, 5000.0, 30.5),
        (5e6, 1000.0, 300.0),
        (5e6 - 1, 1000.0, 300.0),
        (5e6, 999.0, 300.0),
        (5e6, 1000.0, 301.0),
        (0.0, 1000.0, 1.0),
        (1e9, 0.0, 1.0),
        (1e9, 1e9, None),
        (None, 1e9, 1.0),
    ]
    tier = liquidity.classify(F.col("a"), F.col("n"), F.col("m"))
    got = [row["tier"] for row in values(rows, "a double, n double, m double", tier)]
    assert got == [1, 2, 2, 2, 2, 3, 3, 3, 99, 99, 99, 99]


def test_report_keeps_tickers_without_data(spark):
    trades = spark.createDataFrame(
        [("A", at("2024-01-30T10:00:00"), 10.0, 1), ("A", at("2024-01-30T10:00:10"), 10.0, 2), ("OLD", at("2020-01-01T10:00:00"), 1.0, 1)],
        SCHEMA,
    )
    recent = liquidity.within_lookback(trades, dt.date(2024, 1, 31))
    report = liquidity.liquidity_report(liquidity.liquidity_metrics(liquidity.daily_liquidity(recent)), trades)
    rows = [tuple(row) for row in report.collect()]
    assert rows == [
        ("A", 30.0, 2.0, 10.0, 3, "Remove (Illiquid)", None),
        ("OLD", 0.0, None, None, 99, None, "No data in lookback period"),
    ]
    counts = liquidity.value_counts(report, "Recommendation").collect()
    assert [(r.Recommendation, r.n) for r in counts] == [("Remove (Illiquid)", 1)]


def test_lookback_boundary(spark):
    cutoff = at("2022-01-31T00:00:00")
    trades = spark.createDataFrame([("A", cutoff, 1.0, 1), ("A", cutoff - 1, 1.0, 1), ("A", None, 1.0, 1)], SCHEMA)
    assert liquidity.within_lookback(trades, dt.date(2024, 1, 31)).count() == 1


def test_trades_are_exchanged_once(skewed):
    """Combined by second, then only the summaries of seconds move; the days need no exchange of their own."""
    plan = liquidity.daily_liquidity(skewed)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(exchanges) == 2 and gaps.SECOND not in exchanges[0] and gaps.SECOND in exchanges[1]
    assert plan.count("Window ") == 1 and "SortAggregate" not in plan


def test_lookback_reaches_the_parquet_scan(spark, tmp_path):
    rows = [(t, at("2024-01-30T10:00:00") + i, 1.0, 1, "x") for t in ("A", "B") for i in range(3)]
    path = str(tmp_path / "trades")
    spark.createDataFrame(rows, SCHEMA + ", unused string").write.partitionBy("ticker").parquet(path)
    plan = liquidity.daily_liquidity(
        liquidity.within_lookback(spark.read.parquet(path), dt.date(2024, 1, 31)).filter("ticker = 'A'")
    )._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(sip_timestamp," in plan and "unused" not in plan.split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(ticker" in plan


def integrity_rows(spark, *clocks: str, ticker: str = "A"):
    return spark.createDataFrame([(ticker, at(c), 1.0, 1) for c in clocks], SCHEMA)


def test_gap_threshold_is_strict_in_whole_seconds(spark):
    base = at("2024-01-10T15:00:00")
    for nanos, significant in ((900 * NS, 0), (900 * NS + 900_000_000, 0), (901 * NS, 1)):
        df = spark.createDataFrame([("A", base, 1.0, 1), ("A", base + nanos, 1.0, 1)], SCHEMA)
        row = integrity.daily_integrity(df).first()
        assert (row.daily_rth_trades, row.significant_gaps_count, row.max_gap_sec) == (2, significant, nanos // NS)


def test_integrity_summary(spark):
    df = (
        integrity_rows(spark, "2024-01-10T12:00:00", "2024-01-10T15:00:00", "2024-01-10T15:20:00", "2024-01-11T15:00:00")
        .union(integrity_rows(spark, "2024-01-10T15:00:00", "2024-01-10T15:10:00", ticker="GOOD"))
        .union(integrity_rows(spark, "2024-01-10T03:00:00", ticker="NIGHT"))
    )
    rows = [tuple(map(str, r)) for r in integrity.order_integrity_report(integrity.integrity_summary(df)).collect()]
    assert rows == [
        ("A", "Anomalies Detected", "2024-01-10", "2024-01-11", "2", "0", "1", "1200.0"),
        ("NIGHT", "No RTH Data Found", "None", "None", "None", "0", "0", "0.0"),
        ("GOOD", "Healthy", "2024-01-10", "2024-01-10", "1", "0", "0", "0.0"),
    ]


def test_integrity_with_calendar(spark):
    df = integrity_rows(spark, "2024-01-08T15:00:00", "2024-01-10T15:00:00")
    sessions = spark.sql("SELECT explode(sequence(date'2024-01-05', date'2024-01-12')) AS date").filter("weekday(date) < 5")
    row = integrity.integrity_summary(df, calendar=sessions).first()
    assert (row.status, row.days_zero_rth_volume, row.total_trading_days_rth) == ("Anomalies Detected", 1, 2)


def test_sessions_against_a_loop(spark):
    """Sessions before, between and beyond the trades of a ticker, over words of days, before 1970 too."""
    rng = random.Random(4)
    first = dt.date(1969, 6, 1)
    sessions = sorted(rng.sample([first + dt.timedelta(d) for d in range(900)], 300))
    calendar = spark.createDataFrame([(d,) for d in sessions * 2] + [(None,)], "date date")
    rows, days = [], {}
    for name in ("A", "B", "C", "D"):
        days[name] = sorted(rng.sample(range(-100, 1100), rng.choice([1, 5, 40])))
        rows += [(name, at(f"{first + dt.timedelta(d)}T16:00:00"), 1.0, 1) for d in days[name]]
    got = {r.ticker: r.days_zero_rth_volume for r in integrity.integrity_summary(spark.createDataFrame(rows, SCHEMA), calendar=calendar).collect()}
    for name, own in days.items():
        traded = {first + dt.timedelta(d) for d in own}
        assert got[name] == sum(min(traded) <= s <= max(traded) and s not in traded for s in sessions)
    none = integrity.integrity_summary(spark.createDataFrame(rows, SCHEMA), calendar=calendar.limit(0)).collect()
    assert {r.days_zero_rth_volume for r in none} == {0}


def test_sessions_need_one_scan(spark):
    df = integrity_rows(spark, "2024-01-08T15:00:00", "2024-01-10T15:00:00")
    calendar = spark.sql("SELECT explode(sequence(date'2024-01-05', date'2024-01-12')) AS date")
    plan = integrity.integrity_summary(df, calendar=calendar)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Window ") == 1 and "Join" not in plan


def test_bars_and_ties(spark):
    t = at("2024-01-10T15:00:00")
    df = spark.createDataFrame(
        [("A", t, 2, 10.0, 1), ("A", t, 1, 11.0, 3), ("A", t + 59 * NS, 3, 9.0, 1), ("A", t + 60 * NS, 4, 8.0, 0)],
        "ticker string, sip_timestamp bigint, seq bigint, price double, size bigint",
    )
    rows = [tuple(r) for r in br.bars(df, 1, "minute", sequence="seq").orderBy("t").collect()]
    ms = t // 10**6
    assert rows == [("A", ms, 11.0, 11.0, 9.0, 9.0, 5.0, 10.4, 3), ("A", ms + 60_000, 8.0, 8.0, 8.0, 8.0, 0.0, None, 1)]
    assert br.bars(df, 1, "month").first().t == at("2024-01-01T00:00:00") // 10**6
    assert br.bars(df, 1, "week").first().t == at("2024-01-08T00:00:00") // 10**6
    with pytest.raises(ValueError):
        br.bars(df, 2, "month")


def closes(spark, n: int, tickers: int = 2):
    rng = random.Random(3)
    data = {f"T{k}": [rng.uniform(1, 100) for _ in range(n)] for k in range(tickers)}
    rows = [(name, i, price) for name, prices in data.items() for i, price in enumerate(prices)]
    return data, spark.createDataFrame(rows, "ticker string, t bigint, c double")


def collected(df, column: str) -> dict[str, list]:
    out: dict[str, list] = {}
    for row in df.orderBy("ticker", "t").collect():
        out.setdefault(row.ticker, []).append(row[column])
    return out


@pytest.mark.parametrize("block_rows", [1, 7, 4096])
def test_ema_and_macd_against_a_loop(spark, block_rows):
    data, df = closes(spark, 60)

    def loop(prices, window):
        out = []
        for price in prices:
            out.append(price if not out else out[-1] + 2 / (window + 1) * (price - out[-1]))
        return out

    got = collected(indicators.ema(df, 10, block_rows=block_rows), "ema")
    for name, prices in data.items():
        assert got[name] == pytest.approx(loop(prices, 10))
    macd = indicators.macd(df, block_rows=block_rows)
    lines, signals = collected(macd, "macd"), collected(macd, "signal")
    for name, prices in data.items():
        want = [a - b for a, b in zip(loop(prices, 12), loop(prices, 26))]
        assert lines[name] == pytest.approx(want)
        assert signals[name] == pytest.approx(loop(want, 9))


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_rsi_against_a_loop(spark, block_rows):
    data, df = closes(spark, 40)
    got = collected(indicators.rsi(df, 14, block_rows=block_rows), "rsi")
    for name, prices in data.items():
        steps = [b - a for a, b in zip(prices, prices[1:])]
        gain = sum(max(s, 0) for s in steps[:14]) / 14
        loss = sum(max(-s, 0) for s in steps[:14]) / 14
        want = [100 - 100 / (1 + gain / loss)]
        for s in steps[14:]:
            gain, loss = (gain * 13 + max(s, 0)) / 14, (loss * 13 + max(-s, 0)) / 14
            want.append(100 - 100 / (1 + gain / loss))
        assert got[name][:14] == [None] * 14
        assert got[name][14:] == pytest.approx(want)


def test_rsi_without_losses_and_sma_warm_up(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in range(20)], "ticker string, t bigint, c double")
    assert collected(indicators.rsi(df), "rsi")["A"] == [None] * 14 + [100.0] * 6
    assert collected(indicators.sma(df, 3), "sma")["A"][:4] == [None, None, 1.0, 2.0]


def test_recurrences_over_blocks_of_time(spark, monkeypatch):
    """Blocks of any span, hot and null series, rows of one instant, batches that cut a block: as one loop over each series."""
    rng = random.Random(12)
    rows = [(rng.choice(["H", "H", "H", "T", None]), rng.randrange(9_000_000), round(rng.uniform(-5, 5), 3)) for _ in range(900)]
    rows += [("H", 5_000_000, float(i)) for i in range(40)] + [("ONE", 1, 2.0)]
    df = spark.createDataFrame(rows, "ticker string, t bigint, c double").repartition(6)
    want = {}
    for name in {r[0] for r in rows}:
        fast = slow = signal = None
        for _, t, c in sorted(r for r in rows if r[0] == name):
            if fast is None:
                fast, slow, signal = c, c, 0.0
            else:
                fast, slow = fast + 2 / 13 * (c - fast), slow + 2 / 27 * (c - slow)
                signal += 0.2 * (fast - slow - signal)
            want.setdefault((name, t, c), []).append((fast - slow, signal))
    for block_ms in (10_000, 1_000_000, 10**12):
        monkeypatch.setattr(recurrence, "BLOCK_MS", block_ms)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
        try:
            got = indicators.macd(df, block_rows=11).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == len(rows)
        for r in got:
            assert any((r.macd, r.signal) == pytest.approx(w, abs=1e-9) for w in want[r.ticker, r.t, r.c])


def test_averages_share_one_exchange_of_bars(spark):
    """MACD's three averages: rows are dealt once, three Arrow steps, no window, no aggregate."""
    rows = [("A", i, float(i)) for i in range(9)]
    made = indicators.macd(spark.createDataFrame(rows, "ticker string, t bigint, c double"))
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert plan.count("MapInArrow") == 3 and "Window" not in plan and "Aggregate" not in plan
    assert sum("ReusedExchange" in line for line in plan.splitlines()) == 1 and len(dealt) <= 3


def test_split_adjustment(spark):
    day = lambda d: at(f"2024-01-{d:02d}T00:00:00") // 10**6
    rows = [("A", day(d), 8.0, 8.0, 8.0, 8.0, 10.0, 8.0, 1) for d in (9, 10, 20)] + [("B", day(9), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "ticker string, t bigint, o double, h double, l double, c double, v double, vw double, n bigint")
    splits = spark.createDataFrame(
        [("A", "2024-01-10", 2.0, 1.0), ("A", "2024-01-15", 1.0, 4.0), ("A", "2024-01-15", 1.0, 1.0)],
        "ticker string, execution_date string, split_to double, split_from double",
    )
    got = {(r.ticker, r.t): (r.c, r.v, r.n) for r in br.split_adjusted(df, splits).collect()}
    assert got == {
        ("A", day(9)): (16.0, 5.0, 1),
        ("A", day(10)): (32.0, 2.5, 1),
        ("A", day(20)): (8.0, 10.0, 1),
        ("B", day(9)): (1.0, 1.0, 1),
    }


def test_target_bars_keep_targets_apart(spark):
    t = at("2024-01-10T00:00:00")
    df = spark.createDataFrame([("A", t + i * 30 * NS, float(i), 1) for i in range(4)] + [("A", t + DAY, 9.0, 1), ("B", t, 1.0, 1)], SCHEMA)
    jobs = spark.createDataFrame(
        [("A", 1, "minute", "2024-01-10", "2024-01-10"), ("A", 1, "day", "2024-01-10", "2024-01-11"), ("A", 1, "day", "2024-01-11", "2024-01-11"),
         ("A", 1, "day", "2024-01-11", "2024-01-11"), ("A", 1, "foo", "2024-01-10", "2024-01-11"), ("A", 2, "week", "2024-01-10", "2024-01-11")],
        "ticker string, multiplier bigint, timespan string, s string, e string",
    ).select("ticker", "multiplier", "timespan", F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"))
    got = [(r.timespan, str(r.start_date), r.o, r.c, r.n) for r in br.target_bars(df, jobs).orderBy("timespan", "start_date", "t").collect()]
    assert got == [
        ("day", "2024-01-10", 0.0, 3.0, 4),
        ("day", "2024-01-10", 9.0, 9.0, 1),
        ("day", "2024-01-11", 9.0, 9.0, 1),
        ("minute", "2024-01-10", 0.0, 1.0, 2),
        ("minute", "2024-01-10", 2.0, 3.0, 2),
    ]


def bars_of(rows, width_ms):
    """OHLC, volume and count of (instant, sequence, price, size) rows by a loop."""
    out = {}
    for ns, seq, price, size in sorted(rows):
        t = width_ms(ns)
        o, h, l, _, v, n = out.get(t, (price, price, price, price, 0, 0))  # noqa: E741
        out[t] = (o, max(h, price), min(l, price), price, v + size, n + 1)
    return out


def test_overlapping_targets_against_a_loop(spark):
    """Random targets over hot instants; ranges nest, touch, repeat and leave holes."""
    rng = random.Random(8)
    start = at("2024-01-01T00:00:00")
    ticks = {name: [(start + rng.choice([rng.randrange(40 * DAY), 5 * DAY + rng.randrange(3) * NS]), i, float(rng.randrange(1, 50)), rng.randrange(9)) for i in range(300)] for name in ("A", "B")}
    df = spark.createDataFrame([(name, *r) for name, rows in ticks.items() for r in rows], "ticker string, sip_timestamp bigint, seq bigint, price double, size bigint")
    spans = {"minute": 60, "hour": 3600, "day": 86_400}
    jobs = []
    for _ in range(25):
        a = rng.randrange(36)
        jobs.append((rng.choice("AAAB"), *rng.choice([(15, "minute"), (7, "minute"), (36, "hour"), (1, "day"), (5, "day"), (1, "week"), (1, "month")]), a, a + rng.randrange(-1, 9)))
    jobs += jobs[:3]
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    targets = spark.createDataFrame([(*j[:3], day(j[3]), day(j[4])) for j in jobs], "ticker string, multiplier bigint, timespan string, start_date date, end_date date")
    got = {}
    for r in br.target_bars(df, targets, sequence="seq").collect():
        got.setdefault((r.ticker, r.multiplier, r.timespan, r.start_date, r.end_date), {})[r.t] = (r.o, r.h, r.l, r.c, r.v, r.n)
    want = {}
    for name, multiplier, span, a, b in jobs:
        def bar(ns):
            if span in spans:
                width = multiplier * spans[span] * NS
                return ns // width * width // 10**6
            moment = dt.datetime(1970, 1, 1) + dt.timedelta(days=ns // DAY)
            moment = moment - dt.timedelta(days=moment.weekday()) if span == "week" else moment.replace(day=1)
            return int((moment - dt.datetime(1970, 1, 1)).total_seconds()) * 1000

        rows = [r for r in ticks[name] if start + a * DAY <= r[0] < start + (b + 1) * DAY]
        if rows:
            want[name, multiplier, span, day(a), day(b)] = bars_of(rows, bar)
    assert got == want
    segments = br.target_segments(targets).orderBy("ticker", "_from").collect()
    for one, other in zip(segments, segments[1:]):
        assert one.ticker != other.ticker or one._until <= other._from


def above(plan: str, mark: str) -> list[str]:
    """Names of the operators over the one line of a physical plan that holds ``mark``, from the bottom."""
    lines = [line for line in plan.splitlines() if re.search("[A-Z]", line)]
    found = [i for i, line in enumerate(lines) if mark in line and "Scan" in line]
    assert len(found) == 1
    depth = lambda line: re.search("[A-Za-z*(]", line).start()
    out, least = [], depth(lines[found[0]])
    for line in reversed(lines[: found[0]]):
        if depth(line) < least:
            least = depth(line)
            out.append(re.search(r"[A-Z]\w+", line).group())
    return out


def test_a_trade_meets_one_segment(spark):
    """Trades are scanned once and added up, in hash aggregates, below the join with the targets."""
    df = spark.createDataFrame([("A", at("2024-01-10T10:00:00"), 1, 1.0, 1)], "ticker string, sip_timestamp bigint, seq bigint, price double, size bigint")
    jobs = spark.createDataFrame([("A", 1, "minute", dt.date(2024, 1, 1 + i), dt.date(2024, 1, 20 + i % 9)) for i in range(20)], "ticker string, multiplier bigint, timespan string, start_date date, end_date date")
    cells = br._cells(df, jobs, "sip_timestamp", "price", "size", "seq")
    assert cells.count() == 1 and cells.first().n == 1
    made = br.target_bars(df, jobs, sequence="seq")
    assert made.count() == 10
    nodes = above(made._jdf.queryExecution().sparkPlan().toString(), "sip_timestamp")
    steps = [n for n in nodes if "Join" in n or "Aggregate" in n]
    assert "Join" in steps[0] and steps[1:3] == ["HashAggregate"] * 2 and "Join" in steps[3] and steps[4:] == ["HashAggregate"] * 2


def test_large_money_sums_are_exact(spark):
    from tickframe.functions.money import micro_dollars, total_dollars

    rows = [("A", 1.1, 4_000_000_000_000)] * 8 + [("B", -2.25, 3), ("B", 0.25, 1), ("C", None, 1)]
    df = spark.createDataFrame(rows, "k string, price double, size bigint")
    got = dict(df.groupBy("k").agg(total_dollars(micro_dollars(F.col("price"), F.col("size")))).collect())
    assert got == {"A": 35_200_000_000_000.0, "B": -6.5, "C": None}


def test_series_of_one_ticker_stay_apart(spark):
    rows = [("A", f, i * 60_000 * step, c) for f, step, c in (("hour", 60, 10.0), ("15 minute", 15, 100.0)) for i in range(60)]
    df = spark.createDataFrame(rows, "ticker string, fidelity string, t bigint, c double")
    keys = ["ticker", "fidelity"]
    for name, made in (("sma", indicators.sma(df, 5, keys, block_rows=7)), ("ema", indicators.ema(df, 5, keys, block_rows=7))):
        assert {(r.fidelity, round(r[name], 9)) for r in made.collect() if r[name] is not None} == {("hour", 10.0), ("15 minute", 100.0)}


def test_targets_without_bars_come_back(spark):
    jobs = spark.createDataFrame(
        [("A", 1, "day", "d"), ("A", 2, "week", "d"), ("A", 3, "foo", "d"), ("A", None, None, "d"), (None, 1, "day", "d"), ("A", 0, "day", "d")],
        "ticker string, multiplier bigint, timespan string, start_date string",
    ).withColumn("end_date", F.col("start_date"))
    got = sorted(r.reject_reason for r in br.rejected_bar_targets(jobs).collect())
    assert got == ["missing ticker", "multiple below one", "multiple of a calendar span", "unknown span", "unreadable fidelity"]
