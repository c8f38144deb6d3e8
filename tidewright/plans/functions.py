"""One query per scalar function, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import dates, keys, numbers, text, web
from tidewright.plans.registry import query

c = F.col


@query("f1_concat", "select c_custkey, c_name || nullif(c_mktsegment, 'HOUSEHOLD') as joined from customer")
def _(t):
    return t.customer.select(
        "c_custkey", text.concat(c("c_name"), F.nullif(c("c_mktsegment"), F.lit("HOUSEHOLD"))).alias("joined")
    )


@query("f2_hash", "select o_orderkey, md5(cast(o_orderkey as varchar)) as hashed from orders")
def _(t):
    return t.orders.select("o_orderkey", keys.hash_text(c("o_orderkey")).alias("hashed"))


@query(
    "f3_surrogate_key",
    """select o_orderkey, md5(cast(o_orderkey as varchar) || '-' || coalesce(nullif(o_orderstatus, 'P'), '') || '-'
       || o_orderpriority) as order_key from orders""",
)
def _(t):
    parts = [c("o_orderkey"), F.nullif(c("o_orderstatus"), F.lit("P")), c("o_orderpriority")]
    return t.orders.select("o_orderkey", keys.surrogate_key(parts).alias("order_key"))


@query(
    "f4_sha256_key",
    """select o_orderkey, sha256(cast(o_orderkey as varchar) || nullif(o_orderstatus, 'P')) as pk,
       sha256(cast(o_orderkey as varchar) || coalesce(nullif(o_orderstatus, 'P'), '')) as pk_blank_nulls
       from orders""",
)
def _(t):
    parts = [c("o_orderkey"), F.nullif(c("o_orderstatus"), F.lit("P"))]
    return t.orders.select(
        "o_orderkey",
        keys.sha256_key(*parts).alias("pk"),
        keys.sha256_key_blank_nulls(*parts).alias("pk_blank_nulls"),
    )


@query("f5_length", "select doc_id, cast(length(text) as integer) as n from documents")
def _(t):
    return t.documents.select("doc_id", text.length(c("text")).alias("n"))


@query("f6_position", "select doc_id, cast(position('and' in text) as integer) as at_char from documents")
def _(t):
    return t.documents.select("doc_id", text.position(F.lit("and"), c("text")).alias("at_char"))


@query("f7_replace", "select page_id, replace(url, 'example', 'sample') as url from pages")
def _(t):
    return t.pages.select("page_id", text.replace(c("url"), "example", "sample").alias("url"))


@query(
    "f8_right",
    """select c_custkey, right(c_name, 4) as last_4, right(c_name, 0) as last_0, right(c_mktsegment, 50) as all_of_it
       from customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        text.right(c("c_name"), 4).alias("last_4"),
        text.right(c("c_name"), 0).alias("last_0"),
        text.right(c("c_mktsegment"), 50).alias("all_of_it"),
    )


@query(
    "f9_split_part",
    """select p_partkey, split_part(p_name, ' ', 1) as part_1, split_part(p_name, ' ', 2) as part_2,
       split_part(p_name, ' ', 3) as part_3 from part""",
)
def _(t):
    return t.part.select("p_partkey", *[text.split_part(c("p_name"), " ", i).alias(f"part_{i}") for i in (1, 2, 3)])


@query(
    "f10_safe_cast",
    """select o_orderkey, try_cast(left(o_orderpriority, 1) as integer) as level,
       try_cast(o_orderpriority as integer) as not_a_number from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        text.safe_cast(F.left(c("o_orderpriority"), F.lit(1)), "int").alias("level"),
        text.safe_cast(c("o_orderpriority"), "int").alias("not_a_number"),
    )


@query(
    "f11_bool_to_text",
    """select o_orderkey, case when nullif(o_orderstatus, 'P') = 'F' then 'true' when o_orderstatus <> 'P' then 'false'
       end as is_final from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", text.as_text(F.nullif(c("o_orderstatus"), F.lit("P")) == "F").alias("is_final")
    )


@query(
    "f13_safe_add",
    """select l_orderkey, l_linenumber,
       cast(coalesce(nullif(l_linenumber, 1), 0) + coalesce(nullif(l_suppkey, 2), 0) as bigint) as added
       from lineitem""",
)
def _(t):
    parts = F.nullif(c("l_linenumber"), F.lit(1)), F.nullif(c("l_suppkey"), F.lit(2))
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.safe_add(*parts).cast("bigint").alias("added"))


@query(
    "f14_width_bucket",
    """select c_custkey, cast(case when c_acctbal < 1000 then 0 when c_acctbal >= 9000 then 5
       else floor((c_acctbal - 1000) / 2000) + 1 end as bigint) as bucket from customer""",
)
def _(t):
    return t.customer.select("c_custkey", numbers.width_bucket(c("c_acctbal"), 1000, 9000, 4).alias("bucket"))


_PLACE = "c_acctbal / 200 as lat, cast(c_custkey % 360 - 180 as double) as lon"


@query(
    "f15_haversine",
    f"""with p as (select c_custkey, {_PLACE} from customer)
    select c_custkey,
      round(2 * 3961 * asin(sqrt(power(sin(radians((48.864716 - lat) / 2)), 2) + cos(radians(lat))
        * cos(radians(48.864716)) * power(sin(radians((2.349014 - lon) / 2)), 2))), 4) as miles,
      round(2 * 3961 * asin(sqrt(power(sin(radians((48.864716 - lat) / 2)), 2) + cos(radians(lat))
        * cos(radians(48.864716)) * power(sin(radians((2.349014 - lon) / 2)), 2))) * 1.60934, 4) as km
    from p""",
)
def _(t):
    p = t.customer.select("c_custkey", F.expr("c_acctbal / 200").alias("lat"), F.expr("cast(c_custkey % 360 - 180 as double)").alias("lon"))
    to = F.lit(48.864716), F.lit(2.349014)
    return p.select(
        "c_custkey",
        F.round(numbers.haversine(c("lat"), c("lon"), *to), 4).alias("miles"),
        F.round(numbers.haversine(c("lat"), c("lon"), *to, unit="km"), 4).alias("km"),
    )


@query("f16_degrees_to_radians", "select c_custkey, round(radians(c_custkey % 360), 9) as rad from customer")
def _(t):
    return t.customer.select(
        "c_custkey", F.round(numbers.degrees_to_radians(c("c_custkey") % 360), 9).alias("rad")
    )


@query(
    "f17_cents_to_dollars",
    """select o_orderkey, round(cast(round(o_totalprice * 100) as bigint) / 100.0::double, 2) as dollars from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", numbers.cents_to_dollars(numbers.to_cents(c("o_totalprice"))).alias("dollars")
    )


@query("f18_log10", "select l_orderkey, l_linenumber, l_partkey, round(log10(l_quantity), 9) as log_quantity from lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.log10("l_quantity"), 9).alias("log_quantity")
    )


@query(
    "f19_current_timestamp",
    "select event_type, count(*) as n_past from events where ts <= current_timestamp at time zone 'UTC' group by event_type",
)
def _(t):
    past = t.events.where(c("ts") <= dates.now_utc().cast("timestamp_ntz"))
    return past.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_past"))


@query(
    "f20_date_trunc",
    """select event_id, cast(date_trunc('day', ts) as date) as day, cast(date_trunc('month', ts) as date) as month,
       cast(date_trunc('hour', ts) as timestamp) as hour from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        dates.date_trunc("day", c("ts")).cast("date").alias("day"),
        dates.date_trunc("month", c("ts")).cast("date").alias("month"),
        dates.date_trunc("hour", c("ts")).cast("timestamp_ntz").alias("hour"),
    )


@query(
    "f21_dateadd",
    """select event_id, ts + interval 1 day as d1, ts + interval 1 month as m1, ts + interval 1 year as y1,
       ts + interval 1 hour as h1, ts - to_days(cast(user_id as integer)) as back from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        dates.dateadd("day", 1, c("ts")).alias("d1"),
        dates.dateadd("month", 1, c("ts")).alias("m1"),
        dates.dateadd("year", 1, c("ts")).alias("y1"),
        dates.dateadd("hour", 1, c("ts")).alias("h1"),
        dates.dateadd("day", -c("user_id").cast("int"), c("ts")).alias("back"),
    )


_PARTS = ["year", "quarter", "month", "day", "hour", "minute", "second", "millisecond", "microsecond"]


@query(
    "f22_datediff",
    "select event_id, "
    + ", ".join(f"date_diff('{p}', timestamp '2024-01-10 12:30:15.5', ts) as {p}s" for p in _PARTS)
    + """, cast(date_diff('day', date_trunc('week', timestamp '2024-01-10 12:30:15.5' + interval 1 day),
      date_trunc('week', ts + interval 1 day)) / 7 as bigint) as weeks from events""",
)
def _(t):
    start = F.lit("2024-01-10 12:30:15.5").cast("timestamp_ntz")
    return t.events.select("event_id", *[dates.datediff(start, c("ts"), p).alias(f"{p}s") for p in [*_PARTS, "week"]])


@query(
    "f23_last_day",
    """select o_orderkey, last_day(o_orderdate) as month_end,
       cast(date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day as date) as quarter_end,
       cast(date_trunc('year', o_orderdate) + interval 1 year - interval 1 day as date) as year_end from orders""",
)
def _(t):
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", *[dates.last_day(day, p).alias(f"{p}_end") for p in ("month", "quarter", "year")])


@query(
    "f24_epoch_seconds",
    """select event_type, cast(floor(epoch(min(ts))) as bigint) as min_ts, cast(floor(epoch(max(ts))) as bigint) as max_ts
       from events group by event_type""",
)
def _(t):
    return t.events.groupBy("event_type").agg(
        dates.epoch_seconds(F.min("ts")).alias("min_ts"), dates.epoch_seconds(F.max("ts")).alias("max_ts")
    )


@query(
    "f25_parse_timestamp",
    """select o_orderkey, try_cast(case when o_orderstatus = 'P' then 'soon' else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       end as timestamp) as parsed from orders""",
)
def _(t):
    raw = F.when(c("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return t.orders.select("o_orderkey", dates.parse_timestamp(raw).alias("parsed"))


@query(
    "f26_julian_date",
    """select o_orderkey, date '1920-01-01' + cast(o_orderkey % 40000 as integer) as day,
       date_diff('day', date '1920-01-01', cast(o_orderdate as date)) + 2415020 as day_key from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        dates.julian_to_date(c("o_orderkey") % 40000 + dates.JULIAN_OFFSET).alias("day"),
        dates.date_to_julian(F.to_date("o_orderdate")).cast("bigint").alias("day_key"),
    )


@query("f27_weekday_name", "select o_orderkey, dayname(o_orderdate) as weekday from orders")
def _(t):
    return t.orders.select("o_orderkey", dates.weekday_name(c("o_orderdate")).alias("weekday"))


_BARE = "replace(replace({0}, 'http://', ''), 'https://', '')"


@query(
    "f28_url_host",
    f"""select page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),
       'https://', ''), '/', 1), '?', 1) as host from pages""",
)
def _(t):
    return t.pages.select("page_id", web.url_host(c("url")).alias("host"))


@query(
    "f29_url_path",
    f"""with b as (select page_id, {_BARE.format('url')} as u from pages)
    select page_id, split_part(right(u, cast(length(u) - coalesce(nullif(position('/' in u), 0), position('?' in u) - 1)
      as bigint)), '?', 1) as path from b""",
)
def _(t):
    return t.pages.select("page_id", web.url_path(c("url")).alias("path"))


@query(
    "f30_url_parameter",
    "select page_id, "
    + ", ".join(
        f"nullif(split_part(split_part(url, '{p}=', 2), '&', 1), '') as {p}" for p in ("utm_source", "page", "ref")
    )
    + " from pages",
)
def _(t):
    return t.pages.select("page_id", *[web.url_parameter(c("url"), p).alias(p) for p in ("utm_source", "page", "ref")])


@query(
    "f31_slugify",
    """select o_orderkey, regexp_replace(regexp_replace(lower('!' || o_orderpriority), '[ -]+', '_', 'g'),
       '[^a-z0-9_]+', '', 'g') as slug from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", text.slugify(F.concat(F.lit("!"), c("o_orderpriority"))).alias("slug")
    )


@query(
    "f32_names",
    """select c_custkey, split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) as full_name,
       coalesce(cast(nullif(c_nationkey, 3) as varchar), 'None') as nation, lower(c_mktsegment) as low,
       upper(c_name) as up from customer""",
)
def _(t):
    first, last = text.split_part(c("c_name"), "#", 1), text.split_part(c("c_name"), "#", 2)
    return t.customer.select(
        "c_custkey",
        text.full_name(first, last).alias("full_name"),
        text.text_or(F.nullif(c("c_nationkey"), F.lit(3))).alias("nation"),
        F.lower("c_mktsegment").alias("low"),
        F.upper("c_name").alias("up"),
    )


@query(
    "f33_json_field",
    """select event_id, coalesce(json_extract_string(props, '$.k'), 'none') as k,
       coalesce(value > 50 and event_type <> 'view', false) as flag from events""",
)
def _(t):
    payload = F.when(
        c("event_type") != "view", F.to_json(F.struct((c("value") > 50).alias("use_flag")))
    ).otherwise(c("props"))
    return t.events.select(
        "event_id",
        F.coalesce(F.get_json_object("props", "$.k"), F.lit("none")).alias("k"),
        text.json_flag(payload, "$.use_flag").alias("flag"),
    )


@query(
    "f34_check_name_parts",
    """select event_id, event_type as model, 'not_null' as check_kind,
       case when value > 30 then 'user_id' else '_loaded' end as column_name from events""",
)
def _(t):
    node = F.concat(F.lit("model.shop."), c("event_type"))
    name = F.concat(
        F.lit("not_null_"),
        c("event_type"),
        F.when(c("value") > 30, "_user_id").otherwise("__loaded"),
        F.lit("__"),
        F.substring(F.md5(c("event_id").cast("string")), 1, 8),
    )
    rows = t.events.select("event_id", text.check_target(node).alias("model"), name.alias("name"))
    return rows.select(
        "event_id",
        "model",
        text.check_kind(c("name"), c("model")).alias("check_kind"),
        text.check_column(c("name"), c("model")).alias("column_name"),
    )
