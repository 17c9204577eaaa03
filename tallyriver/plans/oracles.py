"""The same queries as SQL for a second engine, written from the rules."""

from __future__ import annotations

from tallyriver.plans.fixtures import AS_OF, CAMPAIGNS, DEMOGRAPHICS_SQL, EVENTS_SQL

ORACLES: dict[str, str] = {}


def when(expr: str) -> str:
    """A time as text with microseconds."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def on(expr: str) -> str:
    """A date as text."""
    return f"strftime({expr}, '%Y-%m-%d')"


AS_OF_SQL = f"timestamp '{AS_OF}'"

AGE_GROUP = """case when age < 25 then '18-24' when age < 35 then '25-34' when age < 45 then '35-44'
     when age < 55 then '45-54' else '55+' end"""
REGION = """case when country in ('US', 'CA') then 'North America' when country in ('UK', 'DE', 'FR') then 'Europe'
     when country in ('JP', 'IN') then 'Asia' when country = 'AU' then 'Oceania' else 'Other' end"""
CATEGORY = """case when event_type in ('click', 'cart_add', 'view') then 'engagement'
     when event_type = 'purchase' then 'conversion' else 'other' end"""
CAMPAIGN_TYPE = """case when contains(campaign_id, 'SUMMER') or contains(campaign_id, 'WINTER') then 'seasonal'
     when contains(campaign_id, 'BLACK') or contains(campaign_id, 'CYBER') then 'promotional' else 'regular' end"""
TIME_OF_DAY = """case when hour(event_time) < 6 then 'night' when hour(event_time) < 12 then 'morning'
     when hour(event_time) < 18 then 'afternoon' else 'evening' end"""
WEEKDAY = "cast(dayofweek(event_time) + 1 as int)"

_campaign_rows = ",\n".join(
    f"('{i}', '{n}', '{t}', date '{s}', date '{e}', cast({b} as decimal(10,2)), '{a}')" for i, n, t, s, e, b, a in CAMPAIGNS
)

EVENTS = f"ue as ({EVENTS_SQL.format(events='events')})"
USERS = f"ud as ({DEMOGRAPHICS_SQL.format(customer='customer')})"
CAMPAIGN_TABLE = f"ca(id, name, type, start_date, end_date, budget, target_audience) as (values {_campaign_rows})"
ENRICHED = f"""{EVENTS}, {USERS},
en as (
  select ue.*, ud.age, ud.gender, ud.state, ud.country, ud.registration_date, ud.income_bracket,
         case when ud.id is not null then {AGE_GROUP} end as age_group,
         cast(date_diff('day', registration_date, cast(event_time as date)) as int) as days_since_registration,
         {REGION} as region
  from ue left join ud on ue.user_id = ud.id)"""
SHAPED = f"""{ENRICHED},
sh as (
  select *, {CATEGORY} as event_category,
         cast(event_type = 'purchase' as int) as is_conversion,
         case when total_amount > 100 then 1 else 0 end as is_high_value,
         {WEEKDAY} as day_of_week, cast(hour(event_time) as int) as hour_of_day,
         case when {WEEKDAY} in (1, 7) then 1 else 0 end as is_weekend,
         {TIME_OF_DAY} as time_of_day, cast(quarter(event_time) as int) as quarter,
         case when event_type = 'purchase' then total_amount else 0 end as revenue,
         case when event_type = 'purchase' then units else 0 end as quantity,
         {CAMPAIGN_TYPE} as campaign_type,
         case when country is not null then 1 else 0 end as has_demographics,
         (3 + case when country is not null then 1 else 0 end) / 4.0::double as data_quality_score
  from en)"""
SESSIONS = """ss as (
  select event_id, session_id,
         case when session_id is not null
              then row_number() over (partition by session_id order by event_time, event_id) end as session_event_number
  from ue)"""


def rollup(source: str, event_type: str = "event_type", extra: str = "") -> str:
    """Hourly cells of ``source``; money in cents so that every step is exact."""
    return f"""
  select date, hour, {event_type} as event_type, campaign_id, country, {extra}
         total_events, unique_users, cents,
         -- half-up division of non-negative whole numbers
         (2 * cents + greatest(total_events, 1)) // (2 * greatest(total_events, 1)) as avg_cents,
         case when clicks > 0 then (2 * 10000 * purchases + clicks) // (2 * clicks) else 0 end as rate_units
  from (
    select *, sum(case when event_type = 'click' then total_events else 0 end) over g as clicks,
           sum(case when event_type = 'purchase' then total_events else 0 end) over g as purchases
    from (
      select cast(event_time as date) as date, cast(hour(event_time) as int) as hour, event_type, campaign_id, country,
             count(*) as total_events, count(distinct user_id) as unique_users,
             cast(sum(cast(revenue as decimal(18,2))) * 100 as hugeint) as cents
      from {source} group by all) cells
    window g as (partition by date, hour, campaign_id, country)) r"""


SUMMARY = f"{SHAPED},\nsu as ({rollup('sh')})"


def money(cents: str) -> str:
    return f"cast(cast({cents} as decimal(36,0)) / 100 as double)"


def rate(units: str) -> str:
    return f"cast(cast({units} as decimal(36,0)) / 10000 as double)"


def summary_columns(prefix: str = "") -> str:
    return f"""{on(prefix + 'date')} as date, {prefix}hour, {prefix}event_type, {prefix}campaign_id, {prefix}country,
       cast({prefix}total_events as bigint) as total_events, cast({prefix}unique_users as bigint) as unique_users,
       {money(prefix + 'cents')} as total_revenue, {money(prefix + 'avg_cents')} as avg_order_value,
       {rate(prefix + 'rate_units')} as conversion_rate"""


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = (f"with {', '.join(ctes)}\n" if ctes else "") + body.strip()


EVENT_COLUMNS = f"""event_id, {when('event_time')} as "timestamp", user_id, event_type, campaign_id, session_id,
       product_id, order_id, units, total_amount"""
ENRICHED_COLUMNS = f"""{EVENT_COLUMNS}, age, gender, state, country, {on('registration_date')} as registration_date,
       income_bracket, age_group, days_since_registration, region"""
USER_COLUMNS = f"""id, age, gender, state, country, {on('registration_date')} as registration_date, income_bracket,
       {on('last_login')} as last_login"""

# --- sources ---------------------------------------------------------------

oracle(
    "decode_envelope",
    f"""select cast(user_id as varchar) as key, 'user_events' as topic, cast(user_id % 6 as int) as partition,
               event_id as "offset", {when('event_time')} as kafka_timestamp, true as has_value from ue""",
    EVENTS,
)
oracle(
    "decode_json_events",
    f"""select cast(user_id as varchar) as key, event_type, user_id, campaign_id, {when('event_time')} as "timestamp",
               session_id, product_id, order_id, units, total_amount as unit_price, total_amount,
               case when event_type = 'purchase' then 'USD' end as currency, '/p/' || product_id as page_url,
               'agent "' || user_id % 3 || '"' as user_agent, '10.0.0.' || user_id % 250 as ip_address,
               case when event_type = 'purchase' then 'card' end as payment_method,
               case when event_type = 'purchase' then 'US' end as to_country,
               case when event_type = 'purchase' then 'State_' || user_id % 10 end as to_state,
               cast(null as varchar) as to_city,
               case when event_type = 'purchase' then cast(user_id as varchar) end as to_postal_code,
               product_id as meta_product, cast(2 as int) as meta_size,
               cast(user_id % 6 as int) as partition, event_id as "offset" from ue""",
    EVENTS,
)
oracle(
    "parse_event_time",
    f"""select event_id as "offset", {when('event_time')} as "timestamp", true as has_processing_time from ue""",
    EVENTS,
)
DATE_PARTS = """cast(year(event_time) as int) as year, cast(month(event_time) as int) as month,
       cast(day(event_time) as int) as day, cast(hour(event_time) as int) as hour"""
oracle("date_parts", f"select event_id, {DATE_PARTS} from ue", EVENTS)
oracle(
    "drop_null_events",
    f"""select event_id as "offset", event_type, user_id, {DATE_PARTS} from ue
        where event_type not in ('error', 'signup', 'view')""",
    EVENTS,
)
oracle(
    "lookup_by_ids",
    f"select {USER_COLUMNS} from ud where id in (select cast(user_id as int) from events)",
    USERS,
)
oracle("get_user", f"select {USER_COLUMNS} from ud where id = 42", USERS)
oracle("table_row_count", "select count(*) as row_count from events")
oracle(
    "table_catalog_check",
    """select 'tr_user_events' as table_name, true as table_exists, (select count(*) from events) as row_count
       union all select 'tr_user_demographics', true, (select count(*) from customer)
       union all select 'tr_no_such_table', false, null""",
)
oracle(
    "incremental_read",
    f"select {EVENT_COLUMNS} from ue where event_time > timestamp '2024-01-15 12:00:00'",
    EVENTS,
)
oracle(
    "high_water_mark",
    f"select {when('''greatest(max(event_time), timestamp '2024-01-15 12:00:00')''')} as high_water from ue",
    EVENTS,
)

# --- sinks -----------------------------------------------------------------

oracle(
    "debug_projection",
    f"""select user_id, event_type, campaign_id, country, age_group, {when('event_time')} as "timestamp" from en""",
    ENRICHED,
)
oracle(
    "kafka_json_sink",
    "select cast(user_id as varchar) as key, event_id, user_id, event_type, total_amount from ue",
    EVENTS,
)
oracle("kafka_json_full", f"select cast(user_id as varchar) as key, {EVENT_COLUMNS} from ue", EVENTS)
oracle(
    "insert_if_absent",
    """select id, age, gender, country from ud
       union all
       select distinct user_id, 30, 'Other', 'US' from ue where user_id not in (select id from ud)""",
    EVENTS,
    USERS,
)
oracle("csv_write", f"select {USER_COLUMNS} from ud", USERS)
oracle("refresh_demographics", f"select {USER_COLUMNS} from ud", USERS)
oracle("overwrite_load", f"select {USER_COLUMNS}, true as created_at, true as updated_at from ud", USERS)
oracle(
    "append_rows",
    f"select {summary_columns()} from (select * from su union all ({rollup('al')})) x",
    SUMMARY,
    "al as (select * replace ('all' as event_type) from sh)",
)

# --- event columns ---------------------------------------------------------

oracle("age_group", f"select id, age, {AGE_GROUP} as age_group from ud", USERS)
oracle("region", "select event_id, country, region from en", ENRICHED)
oracle(
    "days_since_registration",
    f"select event_id, {on('registration_date')} as registration_date, days_since_registration from en",
    ENRICHED,
)
oracle("event_category", "select event_id, event_type, event_category, is_conversion, is_high_value from sh", SHAPED)
oracle("time_features", "select event_id, day_of_week, hour_of_day, is_weekend, time_of_day, quarter from sh", SHAPED)
oracle("business_metrics", "select event_id, revenue, quantity, campaign_type from sh", SHAPED)
TRANSFORMED_COLUMNS = f"""{ENRICHED_COLUMNS}, event_category, is_conversion, is_high_value, day_of_week, hour_of_day,
       is_weekend, time_of_day, quarter, revenue, quantity, campaign_type, session_event_number,
       case when session_event_number = 1 then 1 else 0 end as is_session_start, has_demographics, data_quality_score"""
oracle(
    "transform_all",
    f"select {TRANSFORMED_COLUMNS} from sh join (select event_id, session_event_number from ss) using (event_id)",
    SHAPED,
    SESSIONS,
)
oracle("stream_enriched_events", ORACLES["transform_all"])
oracle(
    "clean_filter",
    f"""select event_id as "offset", user_id, event_type, {when('event_time')} as "timestamp" from ue
        where event_type in ('click', 'purchase')""",
    EVENTS,
)
oracle("quality_flags", "select event_id, has_demographics, data_quality_score from sh", SHAPED)
oracle("processing_metadata", "select event_id, true as is_stamped, '1.0' as processing_version from ue", EVENTS)
oracle(
    "processing_delay",
    """select event_id, case when event_type = 'error' then 0.0::double
         else cast(regexp_extract(props, '([0-9]+)', 1) as double) end as processing_delay from events""",
)
oracle(
    "safe_json_map",
    """select event_id, case when event_type in ('error', 'view') then 0 else 1 end as entries,
              case when event_type not in ('error', 'view') then json_extract_string(props, '$.k') end as k from events""",
)
oracle(
    "normalise_time",
    f"""select event_id, {when(f'''case when event_type = 'error' then {AS_OF_SQL}
          when event_type = 'click' then date_trunc('second', ts) else ts end''')} as event_time from events""",
)
oracle(
    "demographics_view",
    f"""select id, age, {AGE_GROUP} as age_group, gender, state, country, {REGION} as region,
               {on('registration_date')} as registration_date, income_bracket, {on('last_login')} as last_login,
               cast(date_diff('day', registration_date, date '2024-01-31') as int) as days_since_registration from ud""",
    USERS,
)
oracle("late_data_filter", f"select {EVENT_COLUMNS} from ue where event_time > {AS_OF_SQL} - interval 7 days", EVENTS)
oracle("retention_prune", f"select {EVENT_COLUMNS} from ue where event_time >= {AS_OF_SQL} - interval 7 days", EVENTS)

# --- joins -----------------------------------------------------------------

oracle("enrich_left_join", f"select {ENRICHED_COLUMNS} from en", ENRICHED)
oracle("enrich_salted", ORACLES["enrich_left_join"])
oracle(
    "refreshable_lookup", "select country, age_group, count(*) as event_count from en group by all", ENRICHED
)
CAMPAIGN_COLUMNS = f"""ca.id, ca.name, ca.type, {on('ca.start_date')} as start_date, {on('ca.end_date')} as end_date,
       cast(ca.budget as double) as budget, ca.target_audience"""
oracle(
    "campaign_left_join",
    f"select {CAMPAIGN_COLUMNS}, {summary_columns('su.')} from ca left join su on ca.id = su.campaign_id",
    SUMMARY,
    CAMPAIGN_TABLE,
)

# --- aggregations ----------------------------------------------------------

AMOUNT = "cast(sum(cast(total_amount as decimal(18,2))) as double)"


def minute(start: str, end: str) -> str:
    return f"""{when(start)} as window_start, {when(end)} as window_end, event_type,
       count(*) as event_count, count(distinct user_id) as unique_users,
       {AMOUNT} / nullif(count(total_amount), 0) as avg_amount, {AMOUNT} as total_revenue"""


def tumbling(unit: str) -> str:
    start = f"date_trunc('{unit}', event_time)"
    return f"select {minute(start, f'{start} + interval 1 {unit}')} from ue group by {start}, event_type"


def sliding(step: int) -> str:
    """Windows of 60 seconds that start every ``step`` seconds."""
    return f"""from (select *, time_bucket(interval '{step} seconds', event_time) - to_seconds(n * {step}) as w
          from ue cross join range({60 // step}) r(n)) x"""


oracle("minute_metrics", tumbling("minute"), EVENTS)
oracle("exact_distinct_window", tumbling("day"), EVENTS)
oracle("stream_metrics_update", tumbling("hour"), EVENTS)
oracle(
    "stream_minute_metrics",
    tumbling("minute").replace(
        " group by",
        """ where date_trunc('minute', event_time) + interval 1 minute
             <= (select date_trunc('millisecond', max(event_time)) - interval 10 seconds from ue) group by""",
    ),
    EVENTS,
)
oracle(
    "sliding_metrics", f"select {minute('w', 'w + interval 60 seconds')} {sliding(10)} group by w, event_type", EVENTS
)
oracle("stream_sliding_metrics", ORACLES["sliding_metrics"])
oracle(
    "approx_distinct_window",
    f"select * exclude (unique_users), true as within_bound from ({tumbling('day')}) x",
    EVENTS,
)
FIVE = "time_bucket(interval '5 minutes', event_time)"
CAMPAIGN_METRICS = f"""select {when('w')} as window_start, {when('w + interval 5 minutes')} as window_end, campaign_id,
       country, total_events, unique_users, clicks, purchases, revenue,
       case when clicks > 0 then purchases / clicks else 0.0::double end as conversion_rate,
       case when unique_users > 0 then revenue / unique_users else 0.0::double end as revenue_per_user
  from (select {FIVE} as w, campaign_id, country, count(*) as total_events, count(distinct user_id) as unique_users,
               count(*) filter (event_type = 'click') as clicks, count(*) filter (event_type = 'purchase') as purchases,
               {AMOUNT} as revenue from en group by all) x"""
oracle("campaign_analytics", CAMPAIGN_METRICS, ENRICHED)
oracle("stream_campaign_analytics", CAMPAIGN_METRICS, ENRICHED)
oracle(
    "configurable_aggs",
    """select event_type, campaign_id, count(amount) as amount_count, cast(sum(amount) as double) as amount_sum,
              cast(min(amount) as double) as amount_min, cast(max(amount) as double) as amount_max,
              count(units) as units_count, cast(sum(units) as bigint) as units_sum, min(units) as units_min,
              max(units) as units_max, cast(sum(units) as double) / nullif(count(units), 0) as units_avg
       from (select *, cast(total_amount as decimal(18,2)) as amount from ue) x group by event_type, campaign_id""",
    EVENTS,
)
STATS = """select count(*) as total_users, count(distinct country) as countries, count(distinct state) as states,
       coalesce(round(avg(age), 1), 0) as avg_age, min(registration_date) as earliest_registration,
       max(registration_date) as latest_registration from ud"""
oracle(
    "load_statistics",
    f"""select * replace ({on('earliest_registration')} as earliest_registration,
                          {on('latest_registration')} as latest_registration) from ({STATS}) s""",
    USERS,
)
oracle(
    "verify_load",
    """select 'total_records' as statistic, count(*) as value from ud
       union all select 'countries', count(distinct country) from ud
       union all select 'min_age', min(age) from ud
       union all select 'max_age', max(age) from ud
       union all select 'gender ' || coalesce(gender, 'unknown'), count(*) from ud group by gender""",
    USERS,
)
oracle(
    "campaign_summary",
    f"""select {CAMPAIGN_COLUMNS}, cast(coalesce(sum(su.total_events), 0) as bigint) as total_events,
               {money('coalesce(sum(su.cents), 0)')} as total_revenue,
               -- mean of four-digit rates, half up at eight digits
               cast(cast(coalesce((2 * sum(su.rate_units) * 10000 + count(su.rate_units))
                 // (2 * count(su.rate_units)), 0) as decimal(36,0)) / 100000000 as double) as avg_conversion_rate
        from ca left join su on ca.id = su.campaign_id group by ca.id, ca.name, ca.type, ca.start_date, ca.end_date,
             ca.budget, ca.target_audience""",
    SUMMARY,
    CAMPAIGN_TABLE,
)
oracle(
    "profile",
    """select 'age' as "column", key, round(value, 6) as value from (
         select 'count' as key, cast(count(age) as double) as value from ud
         union all select 'mean', avg(age) from ud union all select 'std', stddev_samp(age) from ud
         union all select 'min', min(age) from ud union all select 'max', max(age) from ud
         union all select '25%', quantile_cont(age, 0.25) from ud
         union all select '50%', quantile_cont(age, 0.5) from ud
         union all select '75%', quantile_cont(age, 0.75) from ud) n
       union all select 'gender', gender, cast(count(*) as double) from ud group by gender
       union all select 'country', country, cast(count(*) as double) from ud group by country""",
    USERS,
)
oracle(
    "distribution_share",
    """select event_type, count(*) as event_count, count(*) / (select count(*) from events) as share
       from events group by event_type""",
)
oracle("hourly_rollup", f"select {summary_columns()} from su", SUMMARY)
oracle("stream_upsert", f"select {summary_columns()} from su", SUMMARY)
oracle("stream_upsert_folded", ORACLES["stream_upsert"])

# --- sessions --------------------------------------------------------------

NUMBERED = """select event_id, session_id, session_event_number,
       case when session_event_number = 1 then 1 else 0 end as is_session_start from ss"""
oracle("session_event_number", NUMBERED, EVENTS, SESSIONS)
oracle("session_event_number_split", NUMBERED, EVENTS, SESSIONS)
oracle(
    "session_event_number_literal",
    """select event_id, session_id, n as session_event_number, case when n = 1 then 1 else 0 end as is_session_start
       from (select *, row_number() over (partition by session_id order by event_time, event_id) as n from ue) x""",
    EVENTS,
)
oracle(
    "session_start",
    f"select {EVENT_COLUMNS} from ue join ss using (event_id, session_id) where session_event_number = 1",
    EVENTS,
    SESSIONS,
)
oracle("stream_session_start", ORACLES["session_start"])
oracle("stream_session_numbers", ORACLES["session_event_number"])

# --- sorts and limits ------------------------------------------------------

oracle(
    "latest_events",
    f"""select event_id as "offset", event_type, {when('event_time')} as kafka_timestamp from ue
        order by event_time desc, event_id desc limit 100""",
    EVENTS,
)
DISTRIBUTION = "select country, count(*) as user_count from ud group by country order by user_count desc, country"
oracle("country_distribution", DISTRIBUTION, USERS)
oracle("top_countries", DISTRIBUTION + " limit 5", USERS)

# --- summary table ---------------------------------------------------------

STEP = """case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3
          when 'signup' then 4 when 'error' then 5 end as step,"""
UPSERTED = f"""{SHAPED},
ta as ({rollup("(select * replace ('any' as event_type) from sh where event_type = 'purchase')")}),
de as ({rollup('sh', "'any'", STEP)}),
pa as (select date, hour, event_type, campaign_id, country, 0 as step, total_events, unique_users, cents, avg_cents,
              rate_units from ta union all select date, hour, event_type, campaign_id, country, step, total_events,
              unique_users, cents, avg_cents, rate_units from de),
fo as (select date, hour, event_type, campaign_id, country, count(*) as steps, sum(total_events) as e,
              max(unique_users) as unique_users, sum(cents) as cents, max(avg_cents) as only_avg,
              arg_max(total_events, step) as last_e, arg_max(cents, step) as last_cents,
              arg_max(rate_units, step) as rate_units from pa group by all)"""


def upserted(cents: str, events: str) -> str:
    return f"""select {summary_columns()} from (
        select *, e as total_events,
               case when steps = 1 then only_avg
                    else (2 * ({cents}) + greatest({events}, 1)) // (2 * greatest({events}, 1)) end as avg_cents
        from fo) f"""


oracle("upsert_summary", upserted("cents", "e"), UPSERTED)
oracle("upsert_summary_literal", upserted("cents + last_cents", "e + last_e"), UPSERTED)
oracle(
    "campaign_performance",
    f"""select campaign_id, {on('date')} as summary_date, cast(sum(total_events) as bigint) as total_events,
               cast(sum(unique_users) as bigint) as total_unique_users, {money('sum(cents)')} as total_revenue,
               cast(cast((2 * sum(rate_units) * 10000 + count(*)) // (2 * count(*)) as decimal(36,0))
                    / 100000000 as double) as avg_conversion_rate
        from su where campaign_id = 'SUMMER2024' and date between date '2024-01-05' and date '2024-01-25'
        group by campaign_id, date order by summary_date""",
    SUMMARY,
)
oracle(
    "campaign_performance_users",
    f"""select campaign_id, {on('date')} as summary_date, cast(sum(total_events) as bigint) as total_events,
               {money('sum(cents)')} as total_revenue, any_value(distinct_users) as distinct_users, true as within_bound
        from su join (select cast(event_time as date) as day, count(distinct user_id) as distinct_users
                      from ue where campaign_id = 'SUMMER2024' group by day) x on day = date
        where campaign_id = 'SUMMER2024' and date between date '2024-01-05' and date '2024-01-25'
        group by campaign_id, date""",
    SUMMARY,
)
oracle("stream_upsert_sketches", ORACLES["campaign_performance_users"])

# --- data quality ----------------------------------------------------------

oracle(
    "null_counts",
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter ({c} is null) as null_count, count(*) as total_count from en"""
        for c in ("user_id", "campaign_id", "session_id", "total_amount", "country")
    ),
    ENRICHED,
)
oracle(
    "freshness",
    f"""select {when('t')} as latest_timestamp, (epoch_us({AS_OF_SQL}) - epoch_us(t)) / 60e6::double as age_minutes,
               (epoch_us({AS_OF_SQL}) - epoch_us(t)) / 60e6::double <= 10 as is_fresh from (select max(ts) as t from events) x""",
)
FLAWED = f"""{USERS},
sp as (select cast(2000000000 + s_suppkey as int) as id,
              cast(case when s_nationkey >= 5 then s_nationkey * 10 end as int) as age, 'Other' as gender,
              case when s_nationkey <> 7 then 'State_0' end as state, 'US' as country from supplier),
fl as (select id, age, gender, state, country from ud union all from sp union all from sp)"""
oracle(
    "demographics_validation",
    """select 0 as missing_columns,
              cast(sum(cast(id is null as int) + cast(age is null as int) + cast(gender is null as int)
                   + cast(state is null as int) + cast(country is null as int)) as bigint) as null_values,
              count(*) filter (age is null or age < 1 or age > 120) as invalid_ages,
              count(*) - count(distinct id) as duplicate_ids, false as is_valid from fl""",
    FLAWED,
)
oracle(
    "invalid_rows",
    """select *, 'age' as reason from fl where age is null or age < 1 or age > 120
       union all
       select *, 'duplicate_id' from fl where id in (select id from fl group by id having count(*) > 1)""",
    FLAWED,
)
oracle(
    "quality_gate",
    f"""select 'minimum_records' as "check", total_users >= 1000 as passed from st
        union all select 'minimum_countries', countries >= 5 from st
        union all select 'reasonable_avg_age', avg_age between 18 and 65 from st""",
    USERS,
    f"st as ({STATS})",
)
oracle(
    "share_gate",
    """select event_type, share, share between low and high as passed from (
         select t as event_type, low, high,
                (select count(*) from events where event_type = t) / (select count(*) from events) as share
         from (values ('click', 0.7, 0.9), ('purchase', 0.1, 0.3)) b(t, low, high)) x""",
)
_RULES = {
    "click": ("event_type", "user_id", "campaign_id", "event_time"),
    "purchase": ("event_type", "user_id", "campaign_id", "order_id", "total_amount", "event_time"),
}
oracle(
    "field_requirements",
    " union all ".join(
        f"""select '{t}' as event_type, '{c.replace('event_time', 'timestamp')} present' as rule,
                   count(*) filter (event_type = '{t}' and {c} is null) as violations from ue"""
        for t, columns in _RULES.items()
        for c in columns
    )
    + """ union all select 'purchase', 'total_amount positive',
                    count(*) filter (event_type = 'purchase' and total_amount <= 0) from ue""",
    EVENTS,
)
REASON = """case event_type when 'error' then 'malformed json' when 'signup' then 'missing event_type'
     when 'view' then 'missing value' end"""
oracle(
    "dead_letter",
    f"""select {REASON} as error_reason, cast(user_id as varchar) as key, event_type <> 'view' as has_value,
               'user_events' as topic, cast(user_id % 6 as int) as partition, event_id as "offset" from ue
        where event_type in ('error', 'signup', 'view')""",
    EVENTS,
)
oracle(
    "stream_dead_letter",
    f"""select {REASON} as error_reason, cast(user_id as varchar) as key,
               case event_type when 'error' then '{{' || event_id end as raw_text, 'user_events' as topic,
               cast(user_id % 6 as int) as partition, event_id as "offset" from ue
        where event_type in ('error', 'signup', 'view')""",
    EVENTS,
)
oracle(
    "dead_letter_values",
    f"""select {REASON} as error_reason, event_id as "offset", event_type <> 'view' as has_value,
               case event_type when 'error' then '{{' || event_id end as raw_text,
               case event_type when 'signup' then cast(user_id as varchar) end as raw_user_id,
               case event_type when 'signup' then campaign_id end as raw_campaign_id,
               case event_type when 'signup' then session_id end as raw_session_id,
               case event_type when 'signup' then product_id end as raw_product_id,
               case event_type when 'signup' then strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') end as raw_timestamp,
               cast(null as varchar) as raw_event_type
        from ue where event_type in ('error', 'signup', 'view')""",
    EVENTS,
)
oracle("stream_dead_letter_values", ORACLES["dead_letter_values"])
oracle(
    "dead_letter_good",
    """select cast(user_id as varchar) as key, event_type, user_id, total_amount, cast(user_id % 6 as int) as partition,
              event_id as "offset" from ue where event_type in ('click', 'purchase')""",
    EVENTS,
)
oracle("stream_dead_letter_good", ORACLES["dead_letter_good"])
oracle(
    "error_counts",
    f"""select {REASON} as error_reason, count(*) as error_count from ue
        where event_type in ('error', 'signup', 'view') group by event_type""",
    EVENTS,
)
oracle(
    "enumeration_check",
    f"select {EVENT_COLUMNS} from ue where event_type not in ('click', 'view', 'cart_add', 'purchase')",
    EVENTS,
)

# --- points ----------------------------------------------------------------


def long_rows(source: str, measurement: str, tags: dict[str, str], time: str, fields: list[tuple[str, str, str]]) -> str:
    """One row per point and non-null field; ``fields`` are (name, kind, expression)."""
    tag_list = "".join(f"{expr} as tag_{name}, " for name, expr in tags.items())
    rows = []
    for name, kind, expr in fields:
        number = "cast(null as double)" if kind == "text" else f"cast({expr} as double)"
        text = f"cast({expr} as varchar)" if kind == "text" else "cast(null as varchar)"
        rows.append(
            f"""select '{measurement}' as measurement, {tag_list}{when(f"date_trunc('second', {time})")} as time,
                '{name}' as field, '{kind}' as kind, {number} as value, {text} as text_value
                from {source} where {expr} is not null"""
        )
    return " union all ".join(rows)


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


EVENT_TAGS = same(
    "event_type", "campaign_id", "country", "gender", "age_group", "region", "event_category", "campaign_type"
)
EVENT_FIELDS = [
    (n, "float", n)
    for n in (
        "user_id", "total_amount", "units", "revenue", "hour_of_day", "day_of_week", "data_quality_score", "age",
        "days_since_registration",
    )
] + [(n, "int", n) for n in ("is_conversion", "is_high_value", "is_weekend")]
EVENT_LONG = long_rows("sh", "user_events", EVENT_TAGS, "event_time", EVENT_FIELDS)
oracle("event_points", EVENT_LONG, SHAPED)
oracle(
    "point_range_read",
    f"""select * exclude (n) from (
          select *, row_number() over (partition by {', '.join(f'tag_{t}' for t in EVENT_TAGS)}, field
                                       order by time, value) as n
          from ({EVENT_LONG}) p where time >= {when(f"{AS_OF_SQL} - interval 20 days")}) x where n <= 10""",
    SHAPED,
)
MINUTE_FIELDS = [(n, "float", n) for n in ("event_count", "unique_users", "avg_amount", "total_revenue")]
oracle(
    "metrics_points",
    long_rows("mm", "event_metrics", same("event_type"), "w", MINUTE_FIELDS),
    EVENTS,
    f"""mm as (select date_trunc('minute', event_time) as w, event_type, count(*) as event_count,
                      count(distinct user_id) as unique_users, {AMOUNT} / nullif(count(total_amount), 0) as avg_amount,
                      {AMOUNT} as total_revenue from ue group by all)""",
)
CAMPAIGN_FIELDS = [
    (n, "float", n)
    for n in ("total_events", "unique_users", "clicks", "purchases", "revenue", "conversion_rate", "revenue_per_user")
]
oracle(
    "campaign_points",
    long_rows("cm", "campaign_analytics", same("campaign_id", "country"), "cast(window_start as timestamp)", CAMPAIGN_FIELDS),
    ENRICHED,
    f"cm as ({CAMPAIGN_METRICS})",
)
oracle(
    "merge_points",
    f"""select 'hourly' as measurement, event_type as tag_event_type, country as tag_country, {when('h')} as time,
               field, 'float' as kind, value, cast(null as varchar) as text_value
        from (select event_type, country, date_trunc('hour', event_time) as h, 'user_id' as field,
                     cast(arg_max(user_id, event_id) as double) as value from sh group by all
              union all
              select event_type, country, date_trunc('hour', event_time), 'total_amount',
                     arg_max(total_amount, event_id) from sh where total_amount is not null group by all) x""",
    SHAPED,
)
oracle(
    "bridge_points",
    long_rows(
        "ue",
        "user_events",
        {"event_type": "event_type", "campaign_id": "campaign_id", "country": "case when event_type <> 'view' then 'US' end"},
        "event_time",
        [
            ("user_id", "int", "user_id"),
            ("product_id", "text", "product_id"),
            ("amount", "float", "cast(cast(total_amount as decimal(18,2)) as double)"),
            ("amount", "text", "case when total_amount is null then 'none' end"),
            ("quantity", "int", "units"),
            ("session_id", "text", "session_id"),
        ],
    ),
    EVENTS,
)
oracle(
    "custom_point",
    long_rows(
        "ue", "orders", same("event_type"), "event_time", [("units", "float", "units"), ("order_id", "text", "order_id")]
    ),
    EVENTS,
)
oracle(
    "point_struct",
    f"""select event_id, 'user_events' as measurement, {when('event_time')} as time, event_type as tag_event_type,
               campaign_id as tag_campaign_id, country as tag_country, age_group as tag_age_group, gender as tag_gender,
               user_id as field_user_id, total_amount as field_total_amount, units as field_units,
               revenue as field_revenue, is_conversion as field_is_conversion from sh""",
    SHAPED,
)
oracle(
    "point_lines",
    """select 'visits' || coalesce(',campaign_id=' || campaign_id, '') || ',event_type=' || event_type
              || ' user_id=' || cast(user_id as varchar) || 'i' || coalesce(',units=' || cast(units as varchar) || 'i', '')
              || ' ' || cast(epoch_us(date_trunc('second', event_time)) // 1000000 as varchar) as line from ue""",
    EVENTS,
)
oracle("stream_event_points", ORACLES["point_lines"])
oracle("stream_batch_metrics", "select cast(count(*) as bigint) as records, true as has_rate from events")
oracle("stream_points", ORACLES["event_points"])
oracle("stream_point_store", ORACLES["event_points"])
oracle(
    "point_store_range",
    f"select * from ({EVENT_LONG}) x where time >= '2024-01-10' and time < '2024-01-12'",
    SHAPED,
)
oracle(
    "stream_observed_metrics",
    """select count(*) as records, cast(count(*) as double) as rows,
              cast(count(*) - count(campaign_id) as double) as campaign_id_nulls,
              cast(count(*) - count(session_id) as double) as session_id_nulls,
              cast(count(*) - count(total_amount) as double) as total_amount_nulls,
              round(cast(sum(cast(total_amount as decimal(18,2))) as double), 2) as revenue
       from ue group by least(4, floor(date_diff('day', timestamp '2024-01-01', event_time) / 6))""",
    EVENTS,
)

# --- late events -----------------------------------------------------------

# the batch of each event, and the watermark that the batches before it have set
ARRIVED = f"""{EVENTS},
ar as (
  select *, least(4, part + case when event_id % 7 = 0 then 1 else 0 end) as batch
  from (select *, greatest(0, least(4, cast(floor(
          (epoch(date_trunc('second', event_time)) - epoch(timestamp '2024-01-01') - 1830) / 518400.0) as bigint))) as part
        from ue) x),
nw as (select batch, max(event_time) as newest from ar group by batch),
wm as (select a.batch, max(b.newest) - interval 10 seconds as watermark
       from nw a join nw b on b.batch < a.batch group by a.batch),
sp as (select ar.*, watermark, coalesce(date_trunc('hour', event_time) + interval 1 hour <= watermark, false) as is_late
       from ar left join wm using (batch))"""
oracle(
    "stream_late_events",
    f"""select event_id, {when('event_time')} as "timestamp", event_type, user_id, total_amount,
               'behind watermark' as late_reason, {when('watermark')} as watermark, cast(batch as bigint) as batch_id
        from sp where is_late""",
    ARRIVED,
)
oracle(
    "stream_late_counts",
    """select cast(batch as bigint) as batch_id, 'behind watermark' as late_reason, count(*) as late_events,
              max(epoch_us(watermark) - epoch_us(event_time)) as most_behind_micros
       from sp where is_late group by batch""",
    ARRIVED,
)
oracle("stream_on_time_windows", tumbling("hour").replace("from ue", "from (select * from sp where not is_late) ue"), ARRIVED)
