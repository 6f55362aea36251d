"""Queries for ingest, cleaning, history, gold keys and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import as_double, surrogate_key
from tidemart.operators import history
from tidemart.oracle import marts as sql_marts
from tidemart.oracle.star import star_sql
from tidemart.plans import marts
from tidemart.registry import over_star
from tidemart.session import shared_dir
from tidemart.sources.star import read_gold, write_gold
from tidemart.sources.tables import write_version
from tidemart.streaming import ingest, state, windows
from tidemart.streaming.drain import drain, drain_updates


def _stream(t, name: str) -> DataFrame:
    return ingest.autoload(t.spark, t.root, t.raw(name).schema, pattern=f"{name}.parquet")


def bronze_ingest(t) -> DataFrame:
    out = shared_dir(t.spark, "bronze")
    ingest.bronze_append(_stream(t, "events"), f"{out}/data", f"{out}/checkpoint")
    landed = t.spark.read.parquet(f"{out}/data")
    return landed.select(
        "event_id", "user_id", "event_type", "value",
        F.substring_index("source_file", "/", -1).alias("source_file"),
        F.col("ingested_at").isNotNull().alias("stamped"),
    )


over_star("bronze_ingest", bronze_ingest,
          "select event_id, user_id, event_type, value, 'events.parquet' as source_file, "
          "true as stamped from events")


def autoload_stream(t) -> DataFrame:
    return drain(_stream(t, "orders").select("o_orderkey", "o_custkey"), "autoload")


over_star("autoload", autoload_stream, "select o_orderkey, o_custkey from orders")


def incremental_runs(t) -> DataFrame:
    """The same load twice: the second run adds nothing."""
    out = shared_dir(t.spark, "increments")
    schema = t.raw("events").schema
    runs = [
        ingest.incremental_load(
            t.spark, t.root, schema, f"{out}/data", f"{out}/checkpoint",
            pattern="events.parquet",
        )
        for _ in range(2)
    ]
    return t.spark.createDataFrame(
        [(i + 1, run.rows, run.total) for i, run in enumerate(runs)],
        "run int, rows_added long, rows_total long",
    )


over_star("incremental_load", incremental_runs,
          "select 1 as run, count(*) as rows_added, count(*) as rows_total from events "
          "union all select 2, 0, count(*) from events")


def silver_events(t) -> DataFrame:
    """Events cast and trimmed, properties parsed, one row per (user, type, hour)."""
    parsed = ingest.parse_rescued(windows.timed(t.raw("events")), "props", "k int")
    return ingest.silver_clean(
        parsed,
        {"event_type": F.lower(F.trim("event_type")), "hour": F.date_trunc("hour", "ts"),
         "k": F.col("parsed.k")},
        {"value_set": F.col("value") >= 0, "parsed": F.col("rescued").isNull()},
        ["user_id", "event_type", "hour"], ["ts", "event_id"],
    ).passed.select("user_id", "event_type", "hour", "event_id", "k", "value")


over_star("silver_clean", silver_events,
          "select user_id, lower(trim(event_type)) as event_type, "
          "date_trunc('hour', ts) as hour, event_id, "
          "cast(json_extract_string(props, '$.k') as int) as k, value from events "
          "where value >= 0 qualify row_number() over (partition by user_id, "
          "lower(trim(event_type)), date_trunc('hour', ts) order by ts desc, event_id desc) = 1")


def silver_stream(t) -> DataFrame:
    """Streaming clean: one event per (user, type, hour) key within the watermark."""
    clean = ingest.silver_clean_stream(
        windows.timed(_stream(t, "events")),
        {"event_type": F.lower(F.trim("event_type")), "hour": F.date_trunc("hour", "ts")},
        {"value_set": F.col("value") >= 0}, ["user_id", "event_type", "hour"], "ts", "1 hour",
    )
    return drain(clean.select("user_id", "event_type", "hour"), "silver-stream")


over_star("silver_clean_stream", silver_stream,
          "select distinct user_id, lower(trim(event_type)) as event_type, "
          "date_trunc('hour', ts) as hour from events where value >= 0")


def _order_versions(t) -> DataFrame:
    return t.raw("orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderkey",
        F.col("o_orderdate").cast("date").alias("seen_on"),
        F.col("o_orderpriority").alias("priority"),
    )


def scd1_orders(t) -> DataFrame:
    """Latest order per customer, loaded in two overlapping batches, a table version each."""
    versions = _order_versions(t).withColumn(
        "at", F.concat_ws("-", F.col("seen_on"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    )
    root = shared_dir(t.spark, "scd1")
    held = versions.limit(0)
    for version, batch in enumerate(("o_orderkey % 3 <> 0", "o_orderkey % 3 <> 1"), 1):
        merged = history.scd1_upsert(held, versions.filter(batch), ["customer_key"], "at")
        held = write_version(merged, root, version)
    return held.drop("at")


over_star("scd1_upsert", scd1_orders,
          "select o_custkey as customer_key, o_orderkey, cast(o_orderdate as date) as seen_on, "
          "o_orderpriority as priority from orders qualify row_number() over (partition by "
          "o_custkey order by o_orderdate desc, o_orderkey desc) = 1")


def _address_log(t) -> DataFrame:
    """Dated address observations per person: one for every order, the city moves by year."""
    return t.raw("orders").join(
        t.customers, F.col("o_custkey") == F.col("customer_key")
    ).select(
        "customer_unique_id", "o_orderkey",
        F.concat(
            F.lit("city_"), (F.col("customer_key") + F.year("o_orderdate")) % 40
        ).alias("customer_city"),
        "customer_state", F.col("o_orderdate").cast("date").alias("seen_on"),
    )


_LOG = (
    "select customer_unique_id, o_orderkey, "
    "'city_' || ((customer_key + year(o_orderdate)) % 40) as customer_city, customer_state, "
    "cast(o_orderdate as date) as seen_on from orders join s_customers "
    "on o_custkey = customer_key"
)


def _history_sql(daily: str) -> str:
    return (
        "select customer_unique_id, seen.customer_city as customer_city, "
        "seen.customer_state as customer_state, seen_on as start_date, "
        "lead(seen_on) over w as end_date, lead(seen_on) over w is null as is_current "
        "from (select *, lag(seen) over (partition by customer_unique_id order by seen_on) "
        f"as before from ({daily})) where before is distinct from seen "
        "window w as (partition by customer_unique_id order by seen_on)"
    )


def _daily_sql(where: str = "true") -> str:
    return (
        "select customer_unique_id, seen_on, max({'customer_city': customer_city, "
        f"'customer_state': customer_state}}) as seen from log where {where} group by all"
    )


_SCD = (["customer_unique_id"], ["customer_city", "customer_state"], "seen_on")

over_star(
    "scd2_history", lambda t: history.scd2_history(_address_log(t), *_SCD),
    star_sql(_history_sql(_daily_sql()), log=_LOG),
)


def scd2_in_batches(t) -> DataFrame:
    """History from a first batch, then a batch that holds later and late observations."""
    log = _address_log(t)
    first = history.scd2_history(log.filter("o_orderkey % 5 <> 0"), *_SCD)
    return history.scd2_merge(first, log.filter("o_orderkey % 5 = 0"), *_SCD)


over_star(
    "scd2_merge", scd2_in_batches,
    star_sql(
        _history_sql(
            "select customer_unique_id, seen_on, arg_max(seen, {'b': b, 's': seen}) as seen "
            "from (select customer_unique_id, start_date as seen_on, {'customer_city': "
            "customer_city, 'customer_state': customer_state} as seen, 0 as b from held "
            "union all select customer_unique_id, seen_on, {'customer_city': customer_city, "
            "'customer_state': customer_state}, 1 from log where o_orderkey % 5 = 0) "
            "group by all"
        ),
        log=_LOG, held=_history_sql(_daily_sql("o_orderkey % 5 <> 0")),
    ),
)


def gold_customers(t) -> DataFrame:
    """Historised customers under keys made from person and start date."""
    versions = history.scd2_history(_address_log(t), *_SCD)
    return ingest.gold_dimension(
        versions, "customer_key", ["customer_unique_id", F.col("start_date").cast("string")]
    )


_KEY_SQL = "('0x' || substr(md5({}), 1, 15))::bigint"
over_star(
    "gold_star", gold_customers,
    star_sql(
        f"select {_KEY_SQL.format(chr(39).join(['customer_unique_id || ', '|', ' || start_date']))} "
        "as customer_key, * from versions",
        log=_LOG, versions=_history_sql(_daily_sql()),
    ),
)


def gold_facts(t) -> DataFrame:
    """Orders keyed to the version of the customer that held on the day of purchase.

    Dimension and facts are written as gold tables and read back.
    """
    root = shared_dir(t.spark, "gold")
    gold_customers(t).write.parquet(f"{root}/customers")
    people = t.customers.select("customer_key", "customer_unique_id")
    spent = t.lines.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("spent"))
    facts = t.raw("orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").cast("date").alias("bought"),
    ).join(people, "customer_key").drop("customer_key").join(spent, "order_key", "left")
    versions = t.spark.read.parquet(f"{root}/customers")
    history.as_of_join(
        facts, versions, ["customer_unique_id"], "bought", ["customer_key", "customer_city"]
    ).write.parquet(f"{root}/facts")
    return t.spark.read.parquet(f"{root}/facts").select(
        "order_key", "bought", "customer_key", "customer_city",
        F.coalesce("n_items", F.lit(0)).alias("n_items"), as_double(F.col("spent")).alias("spent"))


over_star("gold_facts", gold_facts, star_sql(
    "select o_orderkey as order_key, cast(o_orderdate as date) as bought, v.customer_key, "
    "v.customer_city, coalesce(n_items, 0) as n_items, spent::double as spent from orders "
    "join s_customers c on o_custkey = c.customer_key join keyed v on "
    "v.customer_unique_id = c.customer_unique_id and cast(o_orderdate as date) >= start_date "
    "and (end_date is null or cast(o_orderdate as date) < end_date) left join ("
    "select order_key, count(*) as n_items, sum(price) as spent from s_items group by all) s "
    "on s.order_key = o_orderkey",
    log=_LOG, versions=_history_sql(_daily_sql()),
    keyed=f"select {_KEY_SQL.format(chr(39).join(['customer_unique_id || ', '|', ' || start_date']))} "
    "as customer_key, * from versions",
))


def gold_round_trip(t) -> DataFrame:
    """Revenue by month from the star written as gold tables and read back."""
    root = shared_dir(t.spark, "star")
    write_gold(t, root)
    return marts.revenue_by_month(read_gold(t.spark, root))


over_star("gold_round_trip", gold_round_trip, sql_marts.MARTS["revenue_by_month"])


def gold_dates(t) -> DataFrame:
    """Every calendar day with the orders placed on it."""
    placed = t.orders.groupBy(F.col("order_purchase_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return t.dates.join(placed, "date_key", "left").select(
        *t.dates.columns, F.coalesce("n_orders", F.lit(0)).alias("n_orders")
    )


def gold_times(t) -> DataFrame:
    """Every second of the day that saw an order, with its bucket and order count."""
    clock = F.broadcast(t.times.withColumnRenamed("time_key", "order_purchase_time_key"))
    return t.orders.groupBy("order_purchase_time_key").agg(
        F.count(F.lit(1)).alias("n_orders")
    ).join(clock, "order_purchase_time_key").select(
        F.col("order_purchase_time_key").alias("time_key"), "time_of_day_bucket", "full_time",
        "n_orders",
    )


over_star("gold_date_dim", gold_dates, star_sql(
    "select s_dates.*, count(order_key) as n_orders from s_dates left join s_orders "
    "on date_key = order_purchase_date_key group by all"
))
over_star("gold_time_dim", gold_times, star_sql(
    "select time_key, time_of_day_bucket, full_time, count(*) as n_orders from s_times "
    "join s_orders on time_key = order_purchase_time_key group by all"
))
over_star(
    "surrogate_keys",
    lambda t: t.customers.select("customer_key", surrogate_key("customer_unique_id").alias("sk")),
    star_sql(f"select customer_key, {_KEY_SQL.format('customer_unique_id')} as sk from s_customers"),
)

# --- event windows ----------------------------------------------------------------------

_MONEY = "sum(value::decimal(12,2))::double as total"
_TUMBLING = (
    "select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour "
    f"as window_end, event_type, count(*) as n_events, {_MONEY} from events group by all"
)
over_star("event_windows", lambda t: windows.event_windows(windows.timed(t.raw("events"))), _TUMBLING)
over_star(
    "event_windows_sliding",
    lambda t: windows.event_windows(windows.timed(t.raw("events")), "1 hour", "30 minutes"),
    "select window_start, window_start + interval 1 hour as window_end, event_type, "
    f"count(*) as n_events, {_MONEY} from (select *, unnest([time_bucket(interval 30 minute, ts), "
    "time_bucket(interval 30 minute, ts) - interval 30 minute]) as window_start from events) "
    "group by all",
)
_SESSIONS = (
    "select user_id, min(ts) as session_start, max(ts) as last_event, count(*) as n_events, "
    f"{_MONEY} from (select *, sum(opens) over (partition by user_id order by ts, event_id) "
    "as session from (select *, case when ts - lag(ts) over (partition by user_id order by ts, "
    "event_id) >= interval 30 minute then 1 else 0 end as opens from events)) "
    "group by user_id, session"
)
over_star("event_sessions", lambda t: windows.event_sessions(windows.timed(t.raw("events"))), _SESSIONS)

# Watermarks keep milliseconds, so the closing time is cut to them.
_CLOSED = "(select date_trunc('millisecond', max(ts)) - interval 1 hour from events)"


def stream_event_windows(t) -> DataFrame:
    """Windows that the watermark has closed at the end of the input."""
    events = windows.timed(_stream(t, "events"))
    return drain(windows.event_windows(events, delay="1 hour"), "windows")


over_star("stream_event_windows", stream_event_windows,
          f"select * from ({_TUMBLING}) where window_end <= {_CLOSED}")


def stream_event_sessions(t) -> DataFrame:
    """Sessions that the watermark has closed at the end of the input."""
    t.spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return drain(windows.stream_sessions(windows.timed(_stream(t, "events"))), "sessions")


over_star("stream_sessions", stream_event_sessions,
          "select user_id, session_start, last_event + interval 30 minute as session_end, "
          f"n_events, total from ({_SESSIONS}) where last_event + interval 30 minute <= {_CLOSED}")


def stream_running_totals(t) -> DataFrame:
    totals = state.running_totals(windows.timed(_stream(t, "events")))
    updates = drain_updates(totals, "totals")
    newest = updates.groupBy("user_id").agg(F.max_by(
        F.struct("n_events", "total", "last_event"), "batch_id").alias("s"))
    return newest.select("user_id", "s.*")


_TOTALS = (
    f"select user_id, count(*) as n_events, {_MONEY}, max(ts) as last_event "
    "from events group by all"
)
over_star("stream_running_totals", stream_running_totals, _TOTALS)


def stream_stateful(t) -> DataFrame:
    updates = drain_updates(
        state.stateful_totals(windows.timed(_stream(t, "events"))), "stateful"
    )
    return state.fold_parts(updates)


over_star("stream_stateful", stream_stateful, _TOTALS)
