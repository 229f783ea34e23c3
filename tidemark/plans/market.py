"""Queries over the market-event operators, each beside the SQL that it must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schemas import BAR_COLUMNS, PRICE
from tidemark.operators import bars as bar_ops
from tidemark.operators import envelope, parse, quality, validate
from tidemark.session import shared_dir
from tidemark.sources.events import replay_stream
from tidemark.streaming.processor import build_streams
from tidemark.streaming.sinks import current_bars, with_epoch_micros

from . import mapping

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, prices: str = ""):
    """Register a query, and `sql` after the common table of trades; prices: its decimal columns, compared as doubles."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            text = "with " + TRADE + sql
            swap = ", ".join(f'"{c}"::double as "{c}"' for c in prices.split())
            SQL[f.__name__] = f"select * replace ({swap}) from ({text})" if prices else text
        return f

    return register


TRADE = """trade as (select *, 'sha256:' || sha256('["driver","iex","market.trade.raw","' || symbol || '","' || id || '","' || time_text || '"]') event_id from (
  select event_id id, upper(event_type) symbol, value::decimal(18,6) price, (props->>'$.k')::bigint size, ts time, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') time_text, user_id from events)),
"""
PAYLOAD = """'{"T":"t","S":"' || symbol || '","i":' || id || ',"x":"V","p":' || price || ',"s":' || size || ',"c":["@"],"t":"' || time_text || '","z":"C"}'"""


def envelope_sql(ingested: str) -> str:
    return f"""'{{"event_id":"' || event_id || '","event_type":"market.trade.raw","schema_version":1,"source":"driver","feed":"iex","source_event_id":"' || id || '","event_timestamp":"' || time_text || '","ingested_at":"' || {ingested} || '","trace_id":null,"payload":' || {PAYLOAD} || '}}'"""


def vwap_sql(n: str, v: str) -> str:
    """Exact quotient of the decimal sum n and the count v, half up at six digits."""
    return f"case when {v} > 0 then ((((({n}) * 1000000)::hugeint * 2 + {v}) // (2 * {v}))::decimal(24,0) * 0.000001)::decimal(18,6) end"


def bars_sql(width: str = "1 minute", frame: str = "1m", source: str = "select * from trade where price > 0") -> str:
    return f"""bar as (select symbol, bar_start, '{frame}' timeframe, open, high, low, close, volume, trade_count, {vwap_sql('n', 'volume')} vwap, 'driver' source, 'iex' feed, true is_final, 'all_valid_trades_v1' condition_policy
  from (select symbol, time_bucket(interval {width}, time) bar_start, arg_min(price, row(time, event_id)) open, max(price) high, min(price) low, arg_max(price, row(time, event_id)) close, sum(size)::bigint volume, count(*) trade_count, sum(price * size)::decimal(38,6) n from ({source}) group by all))
"""


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone and decimals as doubles, as the SQL side has them."""
    kinds = {"timestamp": "timestamp_ntz", "decimal": "double"}
    return df.select(*[F.col(f.name).cast(kinds[f.dataType.typeName()]).alias(f.name) if f.dataType.typeName() in kinds else F.col(f.name) for f in df.schema])


# scans, parsing, envelopes


@query(f"x as (select {envelope_sql('time_text')} as value, id \"offset\" from trade) select * from x")
def scan_raw_events(spark, sf_dir):
    return mapping.records(spark, sf_dir)


@query("""x as (select id::bigint kafka_offset, false is_malformed, event_id, 'market.trade.raw' event_type, 1::bigint schema_version, 'driver' source, 'iex' feed, id::varchar source_event_id, time event_timestamp, 't' message_type, symbol, id provider_trade_id, 'V' exchange, price, size, '@' conditions, time provider_timestamp, 'C' tape from trade) select * from x""", prices="price")
def parse_events(spark, sf_dir):
    parsed = parse.parse_events(mapping.records(spark, sf_dir))
    return parsed.select("kafka_offset", "is_malformed", "event_id", "event_type", "schema_version", "source", "feed", "source_event_id", "event_timestamp", "message_type", "symbol", "provider_trade_id", "exchange", "price", "size", F.array_join("conditions", ",").alias("conditions"), "provider_timestamp", "tape")


FAULT_TIME = "case when id % 20 = 16 then 'yesterday' when id % 20 = 17 then strftime(time + interval 1 second, '%Y-%m-%dT%H:%M:%S.%fZ') else time_text end"


@query(f"x as (select id kafka_offset, case when id % 20 <> 1 then {FAULT_TIME} end provider_timestamp_raw, case when id % 20 not in (1, 16) then time + case when id % 20 = 17 then interval 1 second else interval 0 second end end provider_timestamp from trade) select * from x")
def parse_timestamps(spark, sf_dir):
    return parse.parse_events(mapping.faulty_records(spark, sf_dir)).select("kafka_offset", "provider_timestamp_raw", "provider_timestamp")


@query("x as (select id % 20 = 1 is_malformed, count(*) \"rows\" from trade group by 1) select * from x")
def malformed_flag(spark, sf_dir):
    return mapping.faulty_records(spark, sf_dir).groupBy(parse.is_malformed(F.col("value")).alias("is_malformed")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"x as (select symbol as key, event_id, {envelope_sql('time_text')} as value from trade) select * from x")
def build_envelopes(spark, sf_dir):
    trades = mapping.trades(spark, sf_dir)
    sent = trades.select(F.to_json(F.struct(*mapping._payload())).alias("value"), "time", F.col("time_text").alias("seen"))
    built = envelope.build_envelopes(sent, "driver", "iex", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    # every trade is taken in at its own time, which its payload carries
    return built.select("key", "event_id", F.replace("value", F.lit('"ingested_at":"2024-01-01T00:00:00Z"'), F.concat(F.lit('"ingested_at":"'), F.get_json_object("value", "$.payload.t"), F.lit('"'))).alias("value"))


@query("x as (select id, event_id from trade) select * from x")
def event_ids(spark, sf_dir):
    return mapping.trades(spark, sf_dir).select("id", "event_id")


@query(f"x as (select symbol as key, sha256({envelope_sql(chr(39) + '2024-02-01T00:00:00Z' + chr(39))}) value_sha256 from trade) select * from x")
def publish_records(spark, sf_dir):
    sent = mapping.trades(spark, sf_dir).select(F.to_json(F.struct(*mapping._payload())).alias("value"))
    out = envelope.publish_records(envelope.build_envelopes(sent, "driver", "iex", F.lit("2024-02-01 00:00:00").cast("timestamp")))
    return out.select(F.col("key").cast("string").alias("key"), F.sha2("value", 256).alias("value_sha256"))


PAGES = "page as (select *, id // 500 + 1 page_no, max(id // 500 + 1) over (partition by symbol) last from trade), landed as (select * from page where not (symbol = 'ERROR' and page_no = last)),"


@query(PAGES + "x as (select symbol, page_no::int page_no, (row_number() over (partition by symbol, page_no order by id) - 1)::int \"position\", 't' message_type, symbol trade_symbol, time_text trade_time, price p, size, id i from landed) select * from x", prices="p")
def historical_pages_to_trades(spark, sf_dir):
    found = envelope.pages_to_trades(mapping.pages(spark, sf_dir))
    return found.select("symbol", "page_no", "position", F.col("T").alias("message_type"), F.col("S").alias("trade_symbol"), F.col("t").alias("trade_time"), "p", F.col("s").alias("size"), "i")


@query(PAGES + "x as (select symbol, page_no, id, time_text, price, size from landed where symbol <> 'ERROR') select symbol, count(*) trades, sum(size)::bigint size, min(time_text) first_time, max(time_text) last_time from x group by 1")
def normalize_historical(spark, sf_dir):
    whole = envelope.complete_pages_only(mapping.pages(spark, sf_dir).filter("symbol <> 'ERROR'"))
    return envelope.pages_to_trades(whole).groupBy(F.col("S").alias("symbol")).agg(F.count(F.lit(1)).alias("trades"), F.sum("s").alias("size"), F.min("t").alias("first_time"), F.max("t").alias("last_time"))


@query(PAGES + "x as (select symbol, count(distinct page_no) pages, count(*) trades, max(page_no)::int last_page, symbol <> 'ERROR' and max(page_no) = count(distinct page_no) is_complete from landed group by 1) select * from x")
def historical_page_completeness(spark, sf_dir):
    return envelope.page_completeness(mapping.pages(spark, sf_dir))


@query("x as (select id, symbol from trade where id % 10 > 1) select * from x")
def filter_trade_messages(spark, sf_dir):
    return envelope.trade_messages(mapping.messages(spark, sf_dir)).select("id", F.get_json_object("value", "$.S").alias("symbol"))


@query("x as (select id, id % 10 > 1 and id % 7 <> 0 is_complete from trade) select * from x")
def complete_trades(spark, sf_dir):
    return mapping.messages(spark, sf_dir).select("id", envelope.is_complete_trade(F.col("value")).alias("is_complete"))


@query("x as (select (400 + id % 3)::bigint code, 'limit' message, count(*) count from trade where id % 10 = 1 group by 1) select * from x")
def control_errors(spark, sf_dir):
    return envelope.control_errors(mapping.messages(spark, sf_dir))


@query("x as (select event_id, time event_timestamp, price from trade where price > 0 order by time, event_id limit 100) select * from x", prices="price")
def first_n_trades(spark, sf_dir):
    return envelope.first_trades(mapping.valid(spark, sf_dir), 100).select("event_id", "event_timestamp", "price")


# validation

REASONS = """judged as (select *, case id % 20
  when 1 then ['MALFORMED_JSON','INVALID_EVENT_TYPE','UNSUPPORTED_SCHEMA_VERSION','MISSING_EVENT_ID','MISSING_SOURCE_EVENT_ID','MISSING_SOURCE','MISSING_FEED','SYMBOL_NOT_ALLOWED','INVALID_PROVIDER_TRADE_ID','INVALID_EXCHANGE','INVALID_CONDITIONS','INVALID_TAPE','INVALID_PRICE','INVALID_SIZE','INVALID_TIMESTAMP']
  else list_filter([case when id % 20 = 2 then 'INVALID_EVENT_TYPE' end, case when id % 20 = 3 then 'UNSUPPORTED_SCHEMA_VERSION' end, case when id % 20 = 4 then 'MISSING_EVENT_ID' end, case when id % 20 = 5 then 'MISSING_SOURCE_EVENT_ID' end, case when id % 20 = 6 then 'MISSING_SOURCE' end, case when id % 20 = 7 then 'MISSING_FEED' end,
    case when id % 20 in (5, 8) then 'SOURCE_EVENT_ID_MISMATCH' end, case when id % 20 = 9 or symbol = 'VIEW' then 'SYMBOL_NOT_ALLOWED' end, case when id % 20 = 10 then 'INVALID_PROVIDER_TRADE_ID' end, case when id % 20 = 11 then 'INVALID_EXCHANGE' end, case when id % 20 = 12 then 'INVALID_CONDITIONS' end, case when id % 20 = 13 then 'INVALID_TAPE' end,
    case when id % 20 = 14 or price <= 0 then 'INVALID_PRICE' end, case when id % 20 = 15 then 'INVALID_SIZE' end, case when id % 20 = 16 then 'INVALID_TIMESTAMP' end, case when id % 20 = 17 then 'TIMESTAMP_MISMATCH' end], lambda c: c is not null) end codes from trade),
"""


def judged(spark, sf_dir):
    """Faulty records under an allow-list without VIEW."""
    return validate.validate_trades(parse.parse_events(mapping.faulty_records(spark, sf_dir)), [s for s in mapping.SYMBOLS if s != "VIEW"])


@query(REASONS + "x as (select id kafka_offset, array_to_string(codes, ',') reason_codes from judged) select * from x")
def validation_reasons(spark, sf_dir):
    return judged(spark, sf_dir).select("kafka_offset", F.array_join("reason_codes", ",").alias("reason_codes"))


@query(REASONS + "x as (select id kafka_offset, event_id, symbol, price, size from judged where len(codes) = 0) select * from x", prices="price")
def valid_trades(spark, sf_dir):
    return validate.split_valid_invalid(judged(spark, sf_dir))[0].select("kafka_offset", "event_id", "symbol", "price", "size")


@query(REASONS + "x as (select id kafka_offset, len(codes)::int n_codes from judged where len(codes) > 0) select * from x")
def invalid_trades(spark, sf_dir):
    return validate.split_valid_invalid(judged(spark, sf_dir))[1].select("kafka_offset", F.size("reason_codes").alias("n_codes"))


@query(REASONS + "x as (select unnest(codes) reason_code from judged) select reason_code, count(*) count from x group by 1")
def invalid_reason_counts(spark, sf_dir):
    return validate.reason_counts(validate.split_valid_invalid(judged(spark, sf_dir))[1])


@query(REASONS + "x as (select case when id % 20 in (1) then null when id % 20 = 9 then lower(symbol) else symbol end as key, count(*) \"rows\", sum(len(codes))::bigint codes from judged where len(codes) > 0 group by 1) select * from x")
def dead_letter_records(spark, sf_dir):
    letters = validate.dead_letters(validate.split_valid_invalid(judged(spark, sf_dir))[1])
    return letters.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.json_array_length(F.get_json_object("value", "$.reason_codes")).cast("long")).alias("codes"))


@query("x as (select event_id, symbol, price, size from trade where price > 0) select * from x", prices="price")
def dedup_batch(spark, sf_dir):
    good = mapping.valid(spark, sf_dir)
    again = good.filter(F.col("provider_trade_id") % 50 == 0)
    return parse.dedup_batch(good.unionByName(again)).select("event_id", "symbol", "price", "size")


# bars


@query(bars_sql() + " select * from bar", prices="open high low close vwap")
def minute_bars(spark, sf_dir):
    return mapping.bars(spark, sf_dir)


@query(bars_sql("1 hour", "1h") + " select * from bar", prices="open high low close vwap")
def hour_bars(spark, sf_dir):
    return mapping.bars(spark, sf_dir, "1 hour", "1h")


@query("day as (select l_returnflag || l_linestatus symbol, l_shipdate bar_start, l_extendedprice::decimal(18,6) price, l_orderkey || '-' || l_linenumber event_id from lineitem) select symbol, bar_start, arg_min(price, event_id) open, max(price) high, min(price) low, arg_max(price, event_id) \"close\", count(*) trade_count from day group by all", prices="open high low close")
def bar_open_close_ties(spark, sf_dir):
    """Line items of a day, all at one time: only the id settles open and close."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ticks = items.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"), F.lit("driver").alias("source"), F.lit("iex").alias("feed"), F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("event_id"), F.col("l_extendedprice").cast(PRICE).alias("price"), F.col("l_quantity").cast("long").alias("size"),
    )
    return bar_ops.aggregate_bars(ticks, "1 day", "1d").select("symbol", "bar_start", "open", "high", "low", "close", "trade_count")


@query("x as (select * from trade where price > 0 and size = 0), " + bars_sql(source="select * from x") + " select symbol, bar_start, volume, vwap from bar", prices="vwap")
def zero_volume_vwap(spark, sf_dir):
    empty = bar_ops.aggregate_bars(parse.dedup_batch(mapping.valid(spark, sf_dir).filter("size = 0")))
    return empty.select("symbol", "bar_start", "volume", "vwap")


@query(bars_sql() + " select symbol, epoch_us(bar_start) bar_start_micros from bar")
def bar_epoch_micros(spark, sf_dir):
    return with_epoch_micros(mapping.bars(spark, sf_dir)).select("symbol", "bar_start_micros")


CLOSED = " select * from bar where bar_start + interval 1 minute <= (select max(time) from trade where price > 0) - interval 2 minute"


def streamed(records, spark):
    """Land the records as text, stream them through the processor until all is read, and read the finished bars."""
    root = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    records.select("value").write.text(f"{root}/landed")
    bars, _ = build_streams(replay_stream(spark, f"{root}/landed"), mapping.SYMBOLS)
    run = bars.writeStream.outputMode("append").format("parquet").option("path", f"{root}/bars").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(bars.schema).parquet(f"{root}/bars")


@query(bars_sql() + CLOSED, prices="open high low close vwap")
def finalized_bars(spark, sf_dir):
    return streamed(mapping.records(spark, sf_dir), spark)


@query(bars_sql() + CLOSED, prices="open high low close vwap")
def replay_stream_bars(spark, sf_dir):
    return streamed(mapping.records(spark, sf_dir).repartition("value"), spark)


# bar tables


@query(bars_sql() + " select * from bar where symbol = 'CLICK' and bar_start >= '2024-01-05' and bar_start < '2024-01-12'", prices="open high low close vwap")
def bars_range_scan(spark, sf_dir):
    near = bar_ops.trades_between(mapping.valid(spark, sf_dir), "2024-01-05", "2024-01-12")  # bars of whole minutes: the same range of trades
    return bar_ops.bars_range(bar_ops.aggregate_bars(parse.dedup_batch(near)), "CLICK", "driver", "iex", "2024-01-05", "2024-01-12")


@query(bars_sql() + " select symbol, bar_start, \"close\" from bar order by bar_start, symbol", prices="close")
def bars_ordered(spark, sf_dir):
    return mapping.bars(spark, sf_dir).orderBy("bar_start", "symbol").select("symbol", "bar_start", "close")


@query(bars_sql() + " select count(*) \"rows\", count(distinct (symbol, bar_start, timeframe, source, feed)) distinct_keys, min(bar_start) first_bar, max(bar_start) last_bar, sum(volume)::bigint volume, sum(trade_count)::bigint trades from bar")
def bars_evidence_summary(spark, sf_dir):
    return quality.summary(mapping.bars(spark, sf_dir))


DOUBLED = bars_sql() + ", twice as (select * from bar union all select * from bar where trade_count > 1)"


def doubled(spark, sf_dir):
    bars = mapping.bars(spark, sf_dir)
    return bars.unionByName(bars.filter("trade_count > 1"))


@query(DOUBLED + " select count(*) \"rows\", count(distinct (symbol, bar_start, timeframe, source, feed)) distinct_keys from twice")
def bars_key_counts(spark, sf_dir):
    return quality.key_counts(doubled(spark, sf_dir))


@query(DOUBLED + " select symbol, bar_start, timeframe, source, feed, count(*) \"rows\" from twice group by all having count(*) > 1")
def duplicate_bar_keys(spark, sf_dir):
    return quality.duplicate_keys(doubled(spark, sf_dir))


@query(bars_sql() + """, broken as (select * replace (case when volume % 7 = 0 then low - 1 else high end as high, case when volume % 5 = 1 then 0::decimal(18,6) else "close" end as "close", volume % 11 <> 3 as is_final) from bar),
named as (select symbol, bar_start, list_filter([case when open <= 0 then 'OPEN_NOT_POSITIVE' end, case when high <= 0 then 'HIGH_NOT_POSITIVE' end, case when low <= 0 then 'LOW_NOT_POSITIVE' end, case when "close" <= 0 then 'CLOSE_NOT_POSITIVE' end, case when not is_final then 'NOT_FINAL' end, case when high < greatest(open, low, "close") then 'HIGH_BELOW_OTHERS' end, case when low > least(open, high, "close") then 'LOW_ABOVE_OTHERS' end], lambda c: c is not null) v from broken)
select symbol, bar_start, array_to_string(v, ',') violations from named where len(v) > 0""")
def bar_constraint_violations(spark, sf_dir):
    broken = mapping.bars(spark, sf_dir).withColumns({
        "high": F.when(F.col("volume") % 7 == 0, (F.col("low") - 1).cast(PRICE)).otherwise(F.col("high")),
        "close": F.when(F.col("volume") % 5 == 1, F.lit(0).cast(PRICE)).otherwise(F.col("close")),
        "is_final": F.col("volume") % 11 != 3,
    })
    return quality.constraint_violations(broken).select("symbol", "bar_start", F.array_join("violations", ",").alias("violations"))


LINES = """, line as (select symbol, bar_start, bar_start::date as "day", concat_ws(',', symbol, strftime(bar_start, '%Y-%m-%dT%H:%M:%S+00:00'), timeframe, open, high, low, "close", volume, trade_count, coalesce(vwap::varchar, ''), source, feed, is_final) s from bar)"""


@query(bars_sql() + LINES + " select symbol, \"day\", count(*) \"rows\", sha256(string_agg(s, chr(10) order by bar_start)) sha256 from line group by all")
def bars_digest(spark, sf_dir):
    return quality.digest(mapping.bars(spark, sf_dir).withColumn("day", F.to_date("bar_start")), "symbol", "day")


@query()  # the sum of a hash that SQL lacks; tests compare it with one worked out row by row
def bars_unordered_digest(spark, sf_dir):
    return quality.unordered_digest(mapping.bars(spark, sf_dir))


@query(bars_sql() + " select count(*) \"rows\", min(bar_start) first_bar, max(bar_start) last_bar, 'symbol,bar_start,timeframe,open,high,low,close,volume,trade_count,vwap,source,feed,is_final' fields from bar")
def export_manifest(spark, sf_dir):
    return quality.export_manifest(mapping.bars(spark, sf_dir))


@query(bars_sql() + """, log as (select *, 1 seq from bar union all select * replace ("close" + 1 as "close"), 2 from bar where volume % 2 = 0 union all select * replace ("close" + 2 as "close"), 3 from bar where volume % 3 = 0)
select symbol, bar_start, "close"::decimal(18,6) "close", seq::bigint spark_batch_id from log qualify row_number() over (partition by symbol, bar_start, timeframe, source, feed order by seq desc) = 1""", prices="close")
def upsert_latest_bars(spark, sf_dir):
    bars = mapping.bars(spark, sf_dir).select(BAR_COLUMNS)
    log = None
    for seq in (1, 2, 3):
        part = bars.filter(F.col("volume") % seq == 0).withColumn("close", (F.col("close") + (seq - 1)).cast(PRICE))
        part = part.withColumn("spark_batch_id", F.lit(seq).cast("long")).withColumn("commit_seq", F.lit(seq).cast("long"))
        log = part if log is None else log.unionByName(part)
    return current_bars(log).select("symbol", "bar_start", "close", "spark_batch_id")
