"""What bars do around events: windows as differences of running sums, matched control times, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import timeline
from .joins import without_near

MINUTES = (5, 30, 60)
#: Running sums must be exact, or a window without any change would seem to have one.
SQUARE = "decimal(34,22)"


def events_between(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events of the half-open period, to be taken before impacts are worked out."""
    return events.filter((F.col("event_time") >= F.lit(start).cast("timestamp")) & (F.col("event_time") < F.lit(end).cast("timestamp")))


def grid_of(bars: DataFrame) -> int:
    """Microseconds of a grid on which all bars begin: a minute, or one where any begins beside the minute."""
    beside = bars.filter(F.pmod(F.unix_micros("bar_start"), F.lit(60_000_000)) != 0)
    return 1 if beside.head(1) else 60_000_000


def moment(time: str, grid: int) -> Column:
    """The first point of the grid at or after a time: no bar begins between the two, so their windows hold the same bars."""
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros + F.pmod(-micros, F.lit(grid)))


def bars_read(bars: DataFrame) -> DataFrame:
    """What impacts read of bars, as a written table."""
    return timeline.written(bars.select("symbol", "bar_start", "open", "close", "volume"))


def _states(asked: DataFrame, bars: DataFrame, symbols: list[str]) -> DataFrame:
    """at, values: for each time `at` that is asked for, in the order of symbols, the running sums and last close of the
    bars before it, and the next open. A border stands before a bar that begins there."""
    step = F.log(F.col("close").cast("double") / F.col("open").cast("double"))
    bar = bars.select("symbol", F.col("bar_start").alias("at"), F.lit(1).alias("side"), F.lit(1).cast("long").alias("bars"), F.col("volume").cast("long").alias("volume"), (step * step).cast(SQUARE).alias("squares"), F.col("open").cast("double").alias("open"), F.col("close").cast("double").alias("close"))
    border = asked.select("at").distinct().select("at", F.lit(0).alias("side"), F.posexplode(F.array(*map(F.lit, symbols))).alias("place", "symbol"))
    by, order = ["symbol"], ["at", "side"]
    line = timeline.running(timeline.in_ranges(bar.unionByName(border, allowMissingColumns=True), by, order), by, order, sums=["bars", "volume", "squares"], lasts=["close"], nexts=["open"])
    value = F.struct(*[F.coalesce(f"sum_{c}", F.lit(0)).alias(c) for c in ("bars", "volume", "squares")], F.col("last_close").alias("close"), F.col("next_open").alias("open"))
    listed = F.sort_array(F.collect_list(F.struct("place", value.alias("value"))))  # a row for each symbol
    return line.filter("side = 0").groupBy("at").agg(F.transform(listed, lambda x: x["value"]).alias("values"))


def at_moments(moments: DataFrame, bars: DataFrame, symbols: list[str], minutes: tuple[int, ...] = MINUTES, market: str | None = None) -> DataFrame:
    """What impact() tells, for each moment (distinct times), symbol and window.

    Bars are read once: volume, bars and squares are summed along each symbol's time line, and every window is the
    difference between two of its places. Places that windows of several moments share are worked out once.
    """
    offsets = sorted({0, *minutes, *(-m for m in minutes)})
    asked = moments.filter(F.col("moment").isNotNull()).select("moment", F.explode(F.array(*map(F.lit, offsets))).alias("offset"))
    asked = asked.withColumn("at", F.timestamp_micros(F.unix_micros("moment") + F.col("offset").cast("long") * 60_000_000))
    places = asked.join(_states(asked, bars, symbols), "at").groupBy("moment").agg(F.map_from_entries(F.collect_list(F.struct("offset", "values"))).alias("at"))  # 2 * windows + 1

    def of_symbol(place: Column) -> Column:
        return F.transform_values("at", lambda _, values: F.get(values, place))

    own = places.select("moment", "at", F.posexplode(F.array(*map(F.lit, symbols))).alias("place", "symbol"))
    own = own.select("moment", "symbol", of_symbol(F.col("place")).alias("own"), of_symbol(F.lit(symbols.index(market) if market in symbols else -1)).alias("market"))
    out = own.withColumn("minutes", F.explode(F.array(*map(F.lit, minutes))))

    def change(start: Column, end: Column) -> Column:
        return F.when(end["bars"] > start["bars"], end["close"] / start["open"] - 1)

    def side(name: str, start: Column, end: Column) -> list[Column]:
        there = end["bars"] > start["bars"]
        return [
            (end["volume"] - start["volume"]).alias(f"{name}_volume"), (end["bars"] - start["bars"]).alias(f"{name}_bars"), change(start, end).alias(f"{name}_return"),
            F.when(there, F.sqrt((end["squares"] - start["squares"]).cast("double"))).alias(f"{name}_volatility"),
        ]

    before, now, after = F.col("own")[-F.col("minutes")], F.col("own")[F.lit(0)], F.col("own")[F.col("minutes")]
    of_market = change(F.col("market")[F.lit(0)], F.col("market")[F.col("minutes")]).alias("of_market")
    out = out.select("moment", "symbol", "minutes", *side("pre", before, now), *side("post", now, after), of_market).filter("pre_bars + post_bars > 0")
    coverage = (F.col("pre_bars") + F.col("post_bars")) / (2 * F.col("minutes"))
    out = out.withColumn("volume_ratio", F.try_divide(F.col("post_volume").cast("double"), F.col("pre_volume").cast("double"))).withColumn("coverage", coverage.cast("double"))
    return out.withColumn("volatility_ratio", F.try_divide("post_volatility", "pre_volatility")).withColumn("excess_return", F.col("post_return") - F.col("of_market")).drop("of_market")


def impact(events: DataFrame, bars: DataFrame, symbols: list[str], minutes: tuple[int, ...] = MINUTES, market: str | None = None) -> DataFrame:
    """For each event (id, event_time), symbol and window: bars, volume, return and realised volatility before and
    after, ratios of after to before, and the return beyond that of the symbol `market`.

    Return is last close over first open; volatility the root of the sum of squared log returns of the bars. Coverage is
    the share of minutes that have a bar. excess_return is null where the market symbol has no return. Windows without
    bars on both sides give no row. `symbols` names those to look at; ids tell events apart.

    Events between the same two minutes have the same bars in their windows, so these are worked out once for a minute.
    """
    bars = bars_read(bars)
    own = events.select("id", moment("event_time", grid_of(bars)).alias("moment"))
    return own.join(at_moments(own.select("moment").distinct(), bars, symbols, minutes, market), "moment").drop("moment")


def counted(events: DataFrame, grid: int) -> DataFrame:
    """kind, moment, events: how many events (id, event_time, kind) have their windows at a moment, as a written table."""
    return timeline.written(events.filter(F.col("id").isNotNull()).groupBy("kind", moment("event_time", grid).alias("moment")).agg(F.count(F.lit(1)).alias("events")))


def quantiles(values: DataFrame, by: list[str], value: str, shares: dict[str, float], weight: str | None = None) -> DataFrame:
    """By group the exact quantiles of a column, nulls left out, between two values in proportion; a column for each of
    `shares`. `weight` names a column that tells how many times a row counts. Equal values are counted first and ranked
    in ranges, so a group of any size has no task of its own."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    there = values.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(n.alias("__n"))
    ranked = timeline.running(timeline.in_ranges(there, by, ["__v"]), by, ["__v"], sums=["__n"]).withColumnRenamed("sum___n", "__rank")
    sizes = ranked.groupBy(*by).agg(F.max("__rank").alias("__size"))
    met = ranked.join(sizes.select(*[F.col(c).alias(f"__of_{c}") for c in by], "__size"), _null_safe(ranked, by))

    def at(share: float) -> Column:
        place = (F.col("__size") - 1) * F.lit(float(share))
        low = F.min(F.when(F.col("__rank") >= F.floor(place) + 1, F.col("__v")))  # the rank of the last of equal values
        high = F.min(F.when(F.col("__rank") >= F.ceil(place) + 1, F.col("__v")))
        part = F.max(place - F.floor(place))
        return low + (high - low) * part

    return met.groupBy(*by).agg(*[at(share).alias(name) for name, share in shares.items()])


def _null_safe(left: DataFrame, by: list[str]) -> Column:
    same = F.lit(True)
    for c in by:
        same = same & left[c].eqNullSafe(F.col(f"__of_{c}"))
    return same


def impact_report(impacts: DataFrame, events: DataFrame, least_events: int) -> DataFrame:
    """By kind of event and window: events, mean and median return after, mean coverage, and reason codes. impacts:
    at_moments(); events: counted()."""
    by = ["kind", "minutes"]
    sums = impacts.groupBy("moment", "minutes").agg(F.sum("post_return").alias("r"), F.count("post_return").alias("n_r"), F.sum("coverage").alias("c"), F.count(F.lit(1)).alias("n_c"))
    total = lambda c: F.sum(F.col(c) * F.col("events"))
    mean = lambda c: F.try_divide(total(c), total(f"n_{c}"))
    out = sums.join(events, "moment").groupBy(*by).agg(F.sum("events").alias("events"), mean("r").alias("mean_return"), mean("c").alias("coverage"))
    medians = quantiles(impacts.join(events, "moment"), by, "post_return", {"median_return": 0.5}, "events").select(*[F.col(c).alias(f"__of_{c}") for c in by], "median_return")
    reasons = F.filter(F.array(F.when(F.col("coverage") < 1, "PARTIAL_MARKET_COVERAGE"), F.when(F.col("events") < least_events, "INSUFFICIENT_EVENT_SAMPLES")), lambda x: x.isNotNull())
    return out.join(medians, _null_safe(out, by), "left").drop(*[f"__of_{c}" for c in by]).withColumn("reasons", reasons)


def controls(events: DataFrame, k: int, weeks: int, before: int, after: int, seed: str, first: Column, last: Column, zone: str = "America/New_York") -> DataFrame:
    """event_id, id, event_time: up to k control times for each event (id, event_time), `id` naming each of them.

    A control has the event's minute of the day and weekday in `zone`, up to `weeks` weeks before or behind, lies in
    [first, last], and no event is near it: none from `before` seconds ahead of an event until `after` seconds behind.
    Of those that are left, the k with the smallest digests of seed, event and week are drawn; reruns draw the same.
    """
    local = F.from_utc_timestamp("event_time", zone)
    steps = F.array(*[F.lit(n) for n in range(-weeks, weeks + 1) if n])
    drawn = events.select(F.col("id").alias("event_id"), local.alias("__local"), F.explode(steps).alias("__week"))
    at = F.to_utc_timestamp(F.col("__local") + F.make_interval(weeks=F.col("__week")), zone)
    named = F.concat_ws("#", F.col("event_id").cast("string"), F.col("__week").cast("string"))
    drawn = drawn.select("event_id", named.alias("id"), at.alias("event_time")).filter((F.col("event_time") >= first) & (F.col("event_time") <= last))
    clear = without_near(drawn.withColumn("__one", F.lit(1)), events.select(F.lit(1).alias("__one"), F.col("event_time").alias("__event")), ["__one"], "event_time", "__event", before, after).drop("__one")
    rank = F.row_number().over(Window.partitionBy("event_id").orderBy(F.sha2(F.concat_ws("|", F.lit(seed), "id").cast("binary"), 256)))  # 2 * weeks rows
    return clear.withColumn("__rank", rank).filter(F.col("__rank") <= k).drop("__rank")


MEASURES = ("post_return", "volume_ratio", "volatility_ratio", "excess_return")


def against_controls(impacts: DataFrame, events: DataFrame, controls: DataFrame) -> DataFrame:
    """By kind of event, symbol and window: how many events and controls, the means of the measures over events and over
    controls, and the events' return beyond the controls'. Events without any control count among the events only.
    impacts: at_moments() of both; events, controls: counted(), controls by the kind of their event."""
    by = ["kind", "symbol", "minutes"]

    def means(own: DataFrame, side: str) -> DataFrame:
        met = impacts.join(own.select("kind", "moment", F.col("events").alias("__n")), "moment")
        mean = lambda m: F.sum(F.col(m) * F.col("__n")) / F.sum(F.when(F.col(m).isNotNull(), F.col("__n")))
        return met.groupBy(*by).agg(F.sum("__n").alias(side), *[mean(m).alias(f"{side}_{m}") for m in MEASURES])

    both = means(events, "events").join(means(controls, "controls"), by, "left").withColumn("controls", F.coalesce("controls", F.lit(0)))
    return both.withColumn("return_beyond", F.col("events_post_return") - F.col("controls_post_return"))
