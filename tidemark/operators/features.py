"""Features over bars, market sessions, alerts, reconciliation and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["symbol", "source", "feed"]


def _series():
    return Window.partitionBy(*SERIES).orderBy("bar_start")


def returns(bars: DataFrame, steps: tuple[int, ...] = (1, 5), width: int = 60) -> DataFrame:
    """bars with return_<k>: the change of close against the bar exactly k widths (in seconds) before, null if there is
    none. A gap so never turns into a return over a longer time."""
    by_time = Window.partitionBy(*SERIES).orderBy(F.unix_seconds("bar_start"))
    for k in steps:
        past = F.max("close").over(by_time.rangeBetween(-k * width, -k * width)).cast("double")
        bars = bars.withColumn(f"return_{k}", F.col("close").cast("double") / past - 1)
    return bars


def moving_average(bars: DataFrame, n: int, reach: int = 4) -> Column:
    """Exponential average of close over the last n * reach bars, weight 2 / (n + 1), from the oldest one on."""
    a = 2.0 / (n + 1)
    seen = F.collect_list(F.col("close").cast("double")).over(_series().rowsBetween(-(n * reach - 1), 0))
    return F.aggregate(F.slice(seen, 2, n * reach), F.element_at(seen, 1), lambda acc, x: acc * (1 - a) + x * a)


def technical(bars: DataFrame, n: int = 14) -> DataFrame:
    """bars with rsi, atr (plain means of n changes), sample_count, is_ready and reason; null as long as not ready."""
    change = F.col("close").cast("double") - F.lag("close").over(_series()).cast("double")
    past = F.lag("close").over(_series()).cast("double")
    high, low = F.col("high").cast("double"), F.col("low").cast("double")
    span = F.greatest(high - low, F.abs(high - past), F.abs(low - past))
    last = _series().rowsBetween(-(n - 1), 0)
    out = bars.withColumn("__change", change).withColumn("__range", span).withColumn("sample_count", F.count("__change").over(last))
    up, down = (F.avg(F.greatest(F.lit(0.0), s * F.col("__change"))).over(last) for s in (1, -1))
    out = out.withColumn("is_ready", F.col("sample_count") == n).withColumn("__up", up).withColumn("__down", down)
    rsi = F.when(F.col("__down") == 0, F.when(F.col("__up") == 0, 50.0).otherwise(100.0)).otherwise(100 - 100 / (1 + F.try_divide("__up", "__down")))
    return out.withColumn("rsi", F.when(F.col("is_ready"), rsi)).withColumn("atr", F.when(F.col("is_ready"), F.avg("__range").over(last))).withColumn("reason", F.when(~F.col("is_ready"), "INSUFFICIENT_WARMUP")).drop("__change", "__range", "__up", "__down")


def new_york(time: str) -> Column:
    return F.from_utc_timestamp(time, "America/New_York")


def session(time: str) -> Column:
    """PRE_MARKET, REGULAR (09:30 to 16:00 in New York), AFTER_HOURS or CLOSED; holidays are the calendar's to add."""
    local = new_york(time)
    minute = F.hour(local) * 60 + F.minute(local)
    open_day = F.dayofweek(local).between(2, 6)
    return F.when(~open_day, "CLOSED").when(minute.between(240, 569), "PRE_MARKET").when(minute.between(570, 959), "REGULAR").when(minute.between(960, 1199), "AFTER_HOURS").otherwise("CLOSED")


def with_session(bars: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """bars with session and session_date; on a date of `holidays` (session_date) everything is closed. A calendar has
    some hundred rows for each market and is broadcast."""
    out = bars.withColumn("session_date", F.to_date(new_york("bar_start"))).withColumn("session", session("bar_start"))
    if holidays is None:
        return out
    shut = F.broadcast(holidays.select("session_date", F.lit(True).alias("__shut")))
    return out.join(shut, "session_date", "left").withColumn("session", F.when(F.col("__shut"), "CLOSED").otherwise(F.col("session"))).drop("__shut")


def session_vwap(bars: DataFrame) -> DataFrame:
    """bars with session_vwap: sum of vwap * volume over sum of volume since the session's start."""
    since = Window.partitionBy(*SERIES, "session_date", "session").orderBy("bar_start").rowsBetween(Window.unboundedPreceding, 0)
    worth = F.sum(F.coalesce(F.col("vwap").cast("double") * F.col("volume"), F.lit(0.0))).over(since)
    return bars.withColumn("session_vwap", F.try_divide(worth, F.sum("volume").over(since).cast("double")))


def volume_scores(bars: DataFrame, days: int = 20, unit: Column | None = None) -> DataFrame:
    """bars with volume_change (against the bar before) and volume_zscore: against the same minute of the day over the
    `days` bars of it before, by sample deviation; null with fewer than two of them or without any spread."""
    local = new_york("bar_start")
    same = Window.partitionBy(*SERIES, "__slot").orderBy("bar_start").rowsBetween(-days, -1)
    out = bars.withColumn("__slot", F.hour(local) * 60 + F.minute(local) if unit is None else unit)
    past = F.lag("volume").over(_series())
    out = out.withColumn("volume_change", F.try_divide(F.col("volume").cast("double"), past.cast("double")) - 1)
    spread = F.stddev_samp("volume").over(same)
    return out.withColumn("volume_zscore", F.when(spread > 0, (F.col("volume") - F.avg("volume").over(same)) / spread)).drop("__slot")


def atr_move(bars: DataFrame) -> Column:
    """How many average ranges (`atr` of the bar before) a bar's close lies from the one before; null without both."""
    past, span = F.lag("close").over(_series()).cast("double"), F.lag("atr").over(_series())
    return F.try_divide(F.abs(F.col("close").cast("double") - past), span)


def alerts(bars: DataFrame, max_return: float, max_zscore: float, rule_version: str, max_atr: float | None = None) -> DataFrame:
    """Bars whose return_1, volume_zscore or (with a limit) atr_move goes beyond the caller's limits, with reasons, the
    observations that were judged, and an id that reruns keep."""
    limits = {"RETURN_SPIKE": (F.abs("return_1"), max_return), "VOLUME_SPIKE": (F.col("volume_zscore"), max_zscore)}
    if max_atr is not None:
        limits["ATR_MOVE"] = (F.col("atr_move"), max_atr)
    reasons = F.filter(F.array(*[F.when(value > limit, name) for name, (value, limit) in limits.items()]), lambda x: x.isNotNull())
    found = bars.withColumn("reasons", reasons).filter(F.size("reasons") > 0)
    ident = F.concat_ws("|", *SERIES, F.unix_micros("bar_start").cast("string"), F.lit(rule_version))
    status = F.when(F.col("feed") == "iex", "PRELIMINARY_IEX").otherwise("CONFIRMED")
    seen = F.create_map(*[x for name, (value, _) in limits.items() for x in (F.lit(name), value)])
    return found.withColumn("observations", seen).withColumn("alert_id", F.sha2(ident.cast("binary"), 256)).withColumn("status", status).withColumn("rule_version", F.lit(rule_version))


def reconcile(one: DataFrame, two: DataFrame, tolerance_bps: float, settled_before: Column) -> DataFrame:
    """Bars of two feeds side by side: status, close_diff_bps, volume_ratio; only bars from before `settled_before`."""
    key = ["symbol", "bar_start", "timeframe"]
    a, b = (df.filter(F.col("bar_start") < settled_before).select(*key, F.col("close").cast("double").alias(f"{n}_close"), F.col("volume").alias(f"{n}_volume")) for df, n in ((one, "iex"), (two, "sip")))
    return judged_feeds(a.join(b, key, "full"), tolerance_bps)


def judged_feeds(both: DataFrame, tolerance_bps: float) -> DataFrame:
    """Pairs of bars (iex_close, iex_volume, sip_close, sip_volume) with status, close_diff_bps and volume_ratio."""
    diff = F.abs(F.col("iex_close") - F.col("sip_close")) / F.col("sip_close") * 10_000
    status = F.when(F.col("sip_close").isNull(), "MISSING_SIP").when(F.col("iex_close").isNull(), "MISSING_IEX").when(diff <= tolerance_bps, "MATCHED").otherwise("DIVERGED")
    return both.withColumn("close_diff_bps", diff).withColumn("volume_ratio", F.try_divide(F.col("iex_volume").cast("double"), F.col("sip_volume").cast("double"))).withColumn("status", status)


def settle_alerts(found: DataFrame, reconciled: DataFrame, rule_version: str) -> DataFrame:
    """Preliminary alerts judged by the other feed: CONFIRMED where bars match, REJECTED where they diverge, as they
    were where the other feed has none. One row for each (alert_id, rule_version), whatever the number of runs."""
    judged = found.join(reconciled.select("symbol", "bar_start", "timeframe", F.col("status").alias("match")), ["symbol", "bar_start", "timeframe"], "left")
    status = F.when(F.col("match") == "MATCHED", "CONFIRMED").when(F.col("match") == "DIVERGED", "REJECTED").otherwise(F.col("status"))
    return judged.withColumn("status", status).withColumn("rule_version", F.lit(rule_version)).dropDuplicates(["alert_id", "rule_version"])


def transitions(history: DataFrame, settled: DataFrame) -> DataFrame:
    """alert_id, rule_version, from_status, status: what a settlement adds to the history of alerts (alert_id,
    rule_version, status). Statuses that an alert has had are not added again, so repeated runs add nothing."""
    key = ["alert_id", "rule_version"]
    had = history.groupBy(*key).agg(F.collect_set("status").alias("had"))
    fresh = settled.select(*key, "status").join(had, key, "left").filter(~F.coalesce(F.array_contains("had", F.col("status")), F.lit(False)))
    return fresh.select(*key, F.array_min("had").alias("from_status"), "status")


def latencies(events: DataFrame, event: str, stored: str, by: list[str], now: Column) -> DataFrame:
    """By group: events, p50 and p95 of the milliseconds from event to store, last_event and the seconds since it.

    Milliseconds are counted before percentiles are taken, so that a hot group adds up early.
    """
    delay = F.floor((F.unix_micros(stored) - F.unix_micros(event)) / 1000)
    counted = events.groupBy(*by, delay.alias("__ms")).agg(F.count(F.lit(1)).alias("__n"), F.max(event).alias("__last"))
    out = counted.groupBy(*by).agg(
        F.sum("__n").alias("events"), F.percentile("__ms", 0.5, F.col("__n")).alias("p50_ms"), F.percentile("__ms", 0.95, F.col("__n")).alias("p95_ms"), F.max("__last").alias("last_event")
    )
    return out.withColumn("freshness_seconds", (F.unix_micros(now) - F.unix_micros("last_event")) / 1_000_000)


def stale(fresh: DataFrame, limit: float) -> DataFrame:
    """Groups of latencies() that have been silent for longer than `limit` seconds, with the code SOURCE_STALE."""
    return fresh.filter(F.col("freshness_seconds") > limit).withColumn("code", F.lit("SOURCE_STALE"))


def surprises(releases: DataFrame, actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """releases with `surprise`, actual less forecast; null unless both are known."""
    return releases.withColumn("surprise", F.col(actual) - F.col(forecast))


def spread(seen: DataFrame, one: str, two: str) -> DataFrame:
    """date, realtime_start, spread: value of series `one` less that of `two` on the same date and in the same vintage;
    null unless both are known."""
    pair = seen.filter(F.col("series").isin(one, two)).groupBy("date", "realtime_start")
    both = pair.agg(*[F.max(F.when(F.col("series") == name, F.col("value"))).alias(side) for name, side in ((one, "one"), (two, "two"))])
    return both.select("date", "realtime_start", (F.col("one") - F.col("two")).alias("spread"))


def rates(events: DataFrame, time: str, payload: str, by: list[str]) -> DataFrame:
    """events a group, most in a second, 95th percentile of events in ten seconds, mean and 95th percentile of bytes.

    Percentiles are over the windows that have events. Windows are counted first, so that a hot group adds up early.
    """
    sized = events.withColumn("__bytes", F.octet_length(payload))
    per_second = sized.groupBy(*by, F.floor(F.unix_micros(time) / 1_000_000).alias("__s")).agg(F.count(F.lit(1)).alias("__n"), F.sum("__bytes").alias("__b"))
    peak = per_second.groupBy(*by).agg(F.sum("__n").alias("events"), F.max("__n").alias("max_per_second"), (F.sum("__b") / F.sum("__n")).alias("mean_bytes"))
    tens = per_second.groupBy(*by, F.floor(F.col("__s") / 10).alias("__t")).agg(F.sum("__n").alias("__n")).groupBy(*by).agg(F.percentile("__n", 0.95).alias("p95_per_ten_seconds"))
    sizes = sized.groupBy(*by).agg(F.percentile("__bytes", 0.95).alias("p95_bytes"))
    return peak.join(tens, by).join(sizes, by)


def composite(parts: DataFrame, weights: dict[str, float], cut: float = 0.25) -> DataFrame:
    """parts with `score`, the weighted mean of the components at hand (missing ones leave their weight to the others),
    `weight_present`, and the regime by the cut."""
    present = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in weights.items()), F.lit(0.0))
    total = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    score = F.when(present > 0, total / present)
    return parts.withColumn("weight_present", present).withColumn("score", score).withColumn("regime", F.when(score >= cut, "RISK_ON").when(score <= -cut, "RISK_OFF").when(score.isNotNull(), "NEUTRAL"))


def observations(raw: DataFrame) -> DataFrame:
    """Vintages of a series: `.` means no value; one row for each (series, date, realtime_start), values as decimals,
    and the change against the observation before."""
    clean = raw.withColumn("value", F.when(F.trim("value") != ".", F.col("value").try_cast("decimal(18,6)"))).dropDuplicates(["series", "date", "realtime_start"])
    return clean.withColumn("change", F.col("value") - F.lag("value").over(Window.partitionBy("series", "realtime_start").orderBy("date")))


def expired(bars: DataFrame, now: Column, days: int, kept: DataFrame) -> DataFrame:
    """Bars older than `days`, but for those inside [start, end) of `kept` (symbol, start, end): what retention drops."""
    return by_windows(bars.filter(F.col("bar_start") < now - F.make_interval(days=F.lit(days))), kept, "left_anti")


def by_windows(bars: DataFrame, windows: DataFrame, how: str) -> DataFrame:
    """Bars inside (left_semi) or outside (left_anti) [start, end) of the windows (symbol, start, end), joined by the
    days that these touch."""
    dated = bars.withColumn("__day", F.to_date("bar_start"))
    spans = windows.select("symbol", "start", "end", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))).alias("__day"))
    held = (dated["symbol"] == spans["symbol"]) & (dated["__day"] == spans["__day"]) & (dated["bar_start"] >= spans["start"]) & (dated["bar_start"] < spans["end"])
    return dated.join(spans, held, how).drop("__day")


def news_keys(items: DataFrame, headline: str, source: str, time: str, content: str) -> DataFrame:
    """items with headline_key (the headline in lower case with single spaces, with source and minute) and content_key,
    both as digests; null where a part is."""
    said = F.concat_ws("|", F.trim(F.regexp_replace(F.lower(headline), r"\s+", " ")), source, F.floor(F.unix_micros(time) / 60_000_000).cast("string"))
    whole = F.col(headline).isNotNull() & F.col(source).isNotNull() & F.col(time).isNotNull()
    return items.withColumn("headline_key", F.when(whole, F.sha2(said.cast("binary"), 256))).withColumn("content_key", F.sha2(F.col(content).cast("binary"), 256))


def first_of_each(rows: DataFrame, keys: list[list[str]], order: list[str]) -> DataFrame:
    """Exact deduplication by one key after another: a row goes if an earlier one has the same key. Null keys match
    nothing. `order` must tell rows apart.

    A key is one grouping that keeps the earliest row as a whole, so every step reads its input once; a row with a null
    in its key is a group of its own. Rows are combined before the shuffle: a hot key is a row for each task.
    """
    columns, place = rows.columns, F.struct(*order)
    for key in keys:
        known = F.lit(True)
        for c in key:
            known = known & F.col(c).isNotNull()
        told = rows.groupBy(F.when(known, F.struct(*key)).alias("__key"), F.when(~known, place).alias("__alone"))
        rows = told.agg(F.min_by(F.struct(*columns), place).alias("__row")).select("__row.*")
    return rows


def late_codes(trades: DataFrame, arrival: str, event: str, tolerance: float, cell: int = 300) -> DataFrame:
    """trades with `delay_codes`: FUTURE_TIMESTAMP beyond the tolerance in seconds, OUT_OF_ORDER_EVENT behind an event
    of its symbol that arrived before, DUPLICATE_EVENT for a repeated event_id.

    The running maximum is taken inside cells of `cell` seconds of arrival and carried over from the cells before, so
    that no task orders a whole symbol.
    """
    trades = trades.withColumn("__cell", F.floor(F.unix_micros(arrival) / (cell * 1_000_000)))
    before = Window.partitionBy("symbol").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    earlier = trades.groupBy("symbol", "__cell").agg(F.max(event).alias("__most")).select("symbol", "__cell", F.max("__most").over(before).alias("__most"))
    inside = Window.partitionBy("symbol", "__cell").orderBy(arrival, "id").rowsBetween(Window.unboundedPreceding, -1)
    again = F.row_number().over(Window.partitionBy("event_id").orderBy(arrival, "id")) > 1
    ahead = (F.unix_micros(event) - F.unix_micros(arrival)) > tolerance * 1_000_000
    behind = F.col(event) < F.greatest(F.max(event).over(inside), F.col("__most"))
    codes = F.array(F.when(ahead, "FUTURE_TIMESTAMP"), F.when(behind, "OUT_OF_ORDER_EVENT"), F.when(again, "DUPLICATE_EVENT"))
    told = trades.join(earlier, ["symbol", "__cell"]).withColumn("delay_codes", F.filter(codes, lambda x: x.isNotNull()))
    return told.drop("__cell", "__most")
