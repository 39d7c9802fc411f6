"""SQL for a second engine (DuckDB) that every query must agree with, over the whole tables."""

from __future__ import annotations

LOG = """log as (
  select event_id as seq, ts, user_id, 'u-' || user_id as key, cast(event_id as varchar) as event_id,
    case event_type when 'signup' then 'OrderCreated' when 'purchase' then 'OrderPaid'
      when 'click' then 'OrderConfirmed' when 'view' then 'OrderPlaced'
      when 'error' then 'CustomerBlocked' else event_type end as event_type,
    cast(trunc(value) as integer) as amount,
    case event_type when 'click' then 'temporary' when 'signup' then 'temporary-long'
      when 'error' then 'poison' when 'purchase' then 'unknown' end as kase
  from events)"""


def stable(*parts: str) -> str:
    """Id of some text expressions: each with its length, NULL as a dash."""
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


def hashed(keys: str) -> str:
    """murmur2 of each key of a relation, as relation ``hashed(key, hash)``."""
    m, w = "1540483477", "4294967295"
    return f"""key_bytes as (
  select key, length(key) as n,
    list_transform(range(length(key)), lambda i: cast(ascii(substr(key, cast(i as integer) + 1, 1)) as bigint)) as b
  from (select distinct key from {keys})),
key_body as (
  select key, n, b, list_reduce(
    list_prepend(xor(cast(2538058380 as bigint), n), list_transform(range(n // 4),
      lambda i: b[i * 4 + 1] + b[i * 4 + 2] * 256 + b[i * 4 + 3] * 65536 + b[i * 4 + 4] * 16777216)),
    lambda h, c: xor((h * {m}) & {w},
      (xor((c * {m}) & {w}, ((c * {m}) & {w}) >> 24) * {m}) & {w})) as h
  from key_bytes),
key_tail as (
  select key, case when n % 4 = 0 then h else (xor(h, coalesce(b[n - n % 4 + 1], 0)
    + coalesce(b[n - n % 4 + 2], 0) * 256 + coalesce(b[n - n % 4 + 3], 0) * 65536) * {m}) & {w} end as h
  from key_body),
key_last as (select key, (xor(h, h >> 13) * {m}) & {w} as h from key_tail),
hashed as (select key, xor(h, h >> 15) as hash from key_last)"""


PLACED = f"""{LOG},
{hashed("log")},
placed as (
  select log.*, cast((hash & 2147483647) % 3 as integer) as partition
  from log join hashed using (key)),
offs as (select *, seq as "offset" from placed)"""

STATUS = """case event_type when 'OrderCreated' then 'CREATED' when 'OrderPaid' then 'PAID'
    when 'OrderConfirmed' then 'CONFIRMED' else event_type end"""

FOLD = f"""{LOG},
projection as (
  select key as order_id, arg_max({STATUS}, seq) as status, max(amount) as amount,
    arg_max(event_id, seq) as last_event_id
  from log where starts_with(event_type, 'Order') group by key)"""

PROJECTION_OTHER_TYPES = f"""with other as (
  select * replace (case when event_type = 'view' and event_id % 7 = 0 then 'OrderPacked'
    when event_type = 'view' and event_id % 11 = 0 then 'StockCounted' else event_type end as event_type)
  from events),
{FOLD.replace("from events)", "from other)")}
select * from projection"""
PROJECTION = f"with {FOLD} select * from projection"
PREFIX_DELETE = f"with {FOLD} select * from projection where not order_id like 'u-1%'"
POINT_LOOKUP = f"with {FOLD} select * from projection where order_id = 'u-42'"

TABLE_RESET = f"""with {FOLD}
select 'filled' as state, count(*) as rows from projection
union all select 'reset', cast(0 as bigint)"""

INBOX_DEDUP = f"""with {LOG} select distinct event_id from log
where event_type = 'OrderPaid' and ts >= timestamp '2024-01-08'"""
PAYMENTS = f"""{LOG},
payments as (
  select key as order_id, arg_min(amount, seq) as amount from log where event_type = 'OrderPaid' group by key)"""
INBOX_PAYMENTS = f"with {PAYMENTS} select * from payments"
FILTERED_COUNT = f"with {PAYMENTS} select count(*) as payments from payments where order_id = 'u-7'"
PAYMENTS_STREAM = INBOX_PAYMENTS
INBOX_STREAM = f"""with {LOG} select event_id, key as aggregate_id, amount from log
where event_type = 'OrderPaid'"""

OUTBOX_WRITE = f"""select 'order-' || o_orderkey as id, o_orderstatus as status,
  cast(trunc(o_totalprice) as integer) as amount,
  {stable("'OrderPaid'", "('order-' || o_orderkey)", "cast(epoch_us(o_orderdate) as varchar)", "o_orderstatus",
          "cast(cast(trunc(o_totalprice) as integer) as varchar)")} as event_id,
  'OrderPaid' as event_type, cast(trunc(o_totalprice) as integer) as event_amount, true as ids_agree
from orders"""

OUTBOX = f"""box as (
  select {stable("'OrderPaid'", "cast(o_orderkey as varchar)")} as id, 'c-' || o_custkey as key,
    cast(trunc(o_totalprice) as integer) as amount, o_orderstatus <> 'P' as published,
    o_orderdate as created_at
  from orders),
{hashed("box")},
pending as (
  select box.*, cast((hash & 2147483647) % 3 as integer) as partition
  from box join hashed using (key) where not published)"""
OUTBOX_RELAY = f"""with {OUTBOX}
select 'orders.events' as topic, key, id as event_id, amount, partition from pending"""
OUTBOX_PUBLISH = f"""with {OUTBOX}
select partition, row_number() over (partition by partition order by created_at, id) - 1 as "offset",
  key, id as event_id
from pending"""
OUTBOX_AFTER = """select 'c-' || o_custkey as aggregate_id, count(*) as outbox_rows,
  cast(0 as bigint) as still_pending
from orders group by all"""

# The truth table of the retry tiers, written out.
ENDS = f"""{LOG},
ends as (
  select event_id, coalesce(kase, 'ok') as kase,
    case when kase in ('poison', 'unknown') then 'dlt' else 'processed' end as outcome,
    case kase when 'temporary' then 2 when 'temporary-long' then 3 when 'poison' then 1
      when 'unknown' then 3 else 1 end as attempt,
    case kase when 'temporary' then 'case=temporary; attempt=1'
      when 'temporary-long' then 'case=temporary-long; attempt=2'
      when 'poison' then 'case=poison; attempt=1'
      when 'unknown' then 'case=unknown; attempt=3' end as x_error
  from log)"""
RETRY_OUTCOME = f"with {ENDS} select event_id, outcome, attempt, x_error from ends"
RETRY_HOPS = f"""with {ENDS},
hops(kase, target, attempt) as (values
  ('temporary', 'orders.retry.1', 1),
  ('temporary-long', 'orders.retry.1', 1), ('temporary-long', 'orders.retry.2', 2),
  ('poison', 'orders.dlt', 1),
  ('unknown', 'orders.retry.1', 1), ('unknown', 'orders.retry.2', 2), ('unknown', 'orders.dlt', 3))
select target, hops.attempt, 'case=' || kase || '; attempt=' || hops.attempt as x_error, count(*) as records
from ends join hops using (kase) group by all"""
RETRY_STAGE = f"""with {ENDS}
select event_id, case when kase in ('ok', 'temporary') then 'processed' else 'forwarded' end as outcome,
  case when kase in ('ok', 'temporary') then null when kase = 'poison' then 'orders.dlt'
    else 'orders.retry.2' end as target,
  case when kase in ('ok', 'temporary') then null else 'case=' || kase || '; attempt=2' end as x_error
from ends"""
RETRY_DAMAGED = f"""with {ENDS.replace("select event_id, coalesce", "select seq, event_id, coalesce")}
select case when seq % 13 = 0 then 'quarantined' else outcome end as outcome,
  case when seq % 13 = 0 then 1 else attempt end as attempt,
  case when seq % 13 = 0 then null else x_error end as x_error, count(*) as records
from ends group by all"""
RETRY_TIERS = f"""with {ENDS.replace("select event_id, coalesce", "select seq, event_id, coalesce")}
select case when seq % 13 = 0 then 'quarantined' else outcome end as outcome,
  case when seq % 13 = 0 then 1 when outcome = 'processed' then attempt end as attempt,
  case when seq % 13 <> 0 and outcome = 'dlt' then x_error end as x_error, count(*) as records
from ends group by all"""
DLT_REPORT = f"""with {ENDS} select x_error, attempt, count(*) as records from ends
where outcome = 'dlt' group by all"""

# Each reply's id is derived from the id of the event before it.
SAGA = f"""recursive {LOG},
rules(cause, topic, event_type) as (values
  ('OrderCreated', 'payments.events', 'PaymentReserved'),
  ('PaymentReserved', 'warehouse.events', 'StockReserved'),
  ('StockReserved', 'orders.events', 'OrderConfirmed')),
saga as (
  select 'orders.events' as topic, key, event_type, 0 as hop, cast(null as varchar) as caused_by, event_id, amount
  from log where event_type = 'OrderCreated'
  union all
  select rules.topic, key, rules.event_type, hop + 1, event_id, {stable("event_id", "rules.event_type")}, amount
  from saga join rules on saga.event_type = rules.cause)"""
SAGA_NEXT = f"with {SAGA} select topic, key, event_type, hop, caused_by, event_id, amount from saga where hop > 0"
SAGA_RESUMED = f"""with {SAGA}
select topic, event_type, hop - 1 as hop, caused_by, event_id, amount from saga where hop > 1"""
SAGA_PROGRESS = f"""with {LOG},
steps as (
  select key || '/' || strftime(ts, '%Y-%m-%d') as aggregate_id, event_type, ts,
    case event_type when 'OrderCreated' then 1 else 4 end as step
  from log where event_type in ('OrderCreated', 'OrderConfirmed')),
folded as (
  select aggregate_id, bool_or(step = 1) as step_1, false as step_2, false as step_3,
    bool_or(step = 4) as step_4, max(step) as furthest, max(ts) as last_at
  from steps group by aggregate_id)
select aggregate_id, step_1, step_2, step_3, step_4,
  case furthest when 1 then 'OrderCreated' else 'OrderConfirmed' end as furthest_step,
  case furthest when 1 then 'PaymentReserved' end as next_step,
  furthest <> 4 and last_at < timestamp '2024-01-31 00:00:00' - interval 10 day as stuck
from folded"""

CUSTOMER_EVENTS = """docs as (
  select c_custkey, cast(c_custkey % 3 + 1 as integer) as event_version,
    case c_custkey % 3
      when 0 then json_object('customerId', 'c-' || c_custkey, 'name', nm)
      when 1 then json_object('customerId', 'c-' || c_custkey, 'name', nm, 'segment', c_mktsegment)
      else json_object('id', 'c-' || c_custkey, 'fullName', nm) end as payload
  from (select *, case when c_acctbal >= 0 then c_name end as nm from customer)),
checked as (
  select c_custkey, event_version, list_contains(json_keys(payload), 'customerId') as has_id,
    list_contains(json_keys(payload), 'name') as has_name
  from docs)"""
CONTRACT_CHECK = f"""with {CUSTOMER_EVENTS}
select c_custkey, event_version, has_id and has_name as compatible,
  concat_ws(',', case when not has_id then 'customerId' end, case when not has_name then 'name' end) as missing
from checked"""
CONTRACT_SUMMARY = f"""with {CUSTOMER_EVENTS}
select 'CustomerChanged' as event_type, event_version, count(*) as events,
  count(*) filter (where has_id and has_name) as compatible_events,
  count(*) filter (where not (has_id and has_name)) as breaking_events
from checked group by event_version"""

MURMUR2 = f"""with {PLACED}
select event_id, key, hash, partition from placed join hashed using (key)"""
TARGET = """case event_type when 'OrderPaid' then 'payments.events'
    when 'CustomerBlocked' then 'orders.notifications' else 'orders.events' end"""
KEY_PLACEMENT = f"""with {PLACED}
select {TARGET} as topic, key, count(distinct partition) as partitions, count(*) as records
from placed group by all"""
USER = "case o_orderkey % 3 when 0 then 30 when 1 then 10 else 20 end"
PRODUCT = """(['Keyboard', 'Mouse', 'Monitor', 'Laptop', 'Headphones', 'Tablet', 'Printer', 'Scanner',
    'Speaker', 'Camera', 'Drone', 'Smartwatch'])[(o_orderkey + 11) % 12 + 1]"""
KEYED_PUBLISH = f"""with wide as (
  select case when o_orderkey % 4 = 0 then o_orderkey + 8589934592 else o_orderkey end as o_orderkey from orders),
numbered as (
  select o_orderkey as order_id, cast({USER} as bigint) as user_id, cast({USER} as varchar) as key,
    {PRODUCT} as product
  from wide),
{hashed("numbered")},
located as (
  select numbered.*, cast((hash & 2147483647) % 3 as integer) as partition from numbered join hashed using (key))
select partition, row_number() over (partition by partition order by order_id) - 1 as "offset",
  key, order_id, user_id, product
from located"""
CYCLIC_PRODUCTS = f"select o_orderkey, {USER} as user_id, {PRODUCT} as product from orders"

END_OFFSETS = f"""with {PLACED}
select 'orders.events' as topic, partition, max("offset") + 1 as end_offset from offs group by partition"""
LOG_OFFSETS = f"""with {PLACED}
select partition, row_number() over (partition by partition order by seq) - 1 as "offset", key, event_id
from placed"""
LAST_N = f"""with {PLACED},
ranked as (select *, row_number() over (partition by partition order by "offset" desc) as r from offs)
select partition, "offset", key, event_type from ranked where r <= 12"""
TAIL_READ = f"""with {PLACED},
ends as (select partition, max("offset") + 1 as e from offs group by partition)
select partition, "offset", key, event_type, '-' as status
from offs join ends using (partition) where "offset" >= greatest(0, e - 12)"""
BOUNDED_READ = f"""with {PLACED}
select partition, "offset", key, event_type from offs order by partition, "offset" limit 500"""
BOUNDED_READ_STATUS = f"""with {PLACED},
cut as (select seq from offs order by partition, "offset" limit 500)
select count(*) as read, cast(500 as bigint) as expected, count(*) >= 500 as complete from cut"""
TAKE_ONE = f"with {LOG} select seq, key, event_type from log order by seq limit 1"
ORDER_CHECK = f"""with {PLACED},
topics as (select *, {TARGET} as topic from offs),
steps as (
  select topic, key, partition,
    lag(amount) over (partition by topic, key, partition order by "offset") > amount as falls
  from topics)
select topic, key, count(distinct partition) as partitions, count(*) as records,
  count(*) filter (where falls) as inversions
from steps group by topic, key"""
FULL_AND_RESUMED = f"""with {LOG}
select case when ts < timestamp '2024-01-16' then 1 else 2 end as run, event_type,
  count(*) as records, count(*) as distinct_events
from log group by all"""

RECEIVED = """received as (
  select "group", member, count(seq) as received, (select count(*) from placed) as n
  from members left join placed using (partition) group by all)"""
SEPARATE = f"""members("group", member, partition) as (values
  ('billing-service', 'billing-1', 0), ('billing-service', 'billing-1', 1), ('billing-service', 'billing-2', 2),
  ('fraud-service', 'fraud-1', 0), ('fraud-service', 'fraud-1', 1), ('fraud-service', 'fraud-1', 2),
  ('notification-service', 'notification', 0), ('notification-service', 'notification', 1),
  ('notification-service', 'notification', 2)),
{RECEIVED}"""
SHARED = f"""members("group", member, partition) as (values
  ('orders-shared', 'billing-function', 0), ('orders-shared', 'billing-function', 1),
  ('orders-shared', 'notification-function', 2)),
{RECEIVED}"""
GROUP_SEPARATE = f"""with {PLACED}, {SEPARATE}
select "group", member, received, n - received as missed from received"""
GROUP_SHARED = f"""with {PLACED}, {SHARED}
select "group", member, received, n - received as missed from received"""
LOAD_FACTOR = f"""with {PLACED}, {SEPARATE}
select cast(sum(received) as bigint) as deliveries, max(n) as events,
  cast(sum(received) as double) / max(n) as load_factor
from received"""
MISSED_EVENTS = f"with {PLACED} select partition, key, event_id from placed where partition in (0, 1)"
TYPE_MIX = f"""with {LOG} select 'orders.events' as topic, event_type, count(*) as records
from log group by event_type"""
TOPIC_SUMMARY = f"""with {LOG} select 'orders.events' as topic, count(distinct event_type) as event_types,
  (select string_agg(t, ',' order by t) from (select distinct event_type as t from log)) as types,
  count(*) as records
from log"""
TYPE_ROUTE = f"""with {LOG} select event_id, event_type,
  case event_type when 'OrderPaid' then 'payments.events' when 'CustomerBlocked' then 'orders.notifications'
    else 'orders.events' end as target
from log"""

READER_COUNTS = f"""with {LOG} select {TARGET} as topic, count(*) as records from log group by all"""

NOTIFICATION_ENRICH = f"""with {LOG}
select event_id, user_id, c_name as name, c_mktsegment as segment
from log left join customer on user_id = c_custkey where event_type = 'OrderPaid'"""
STATE_LATEST = """select user_id, arg_max(event_type, event_id) as status, arg_max(value, event_id) as value,
  arg_max(cast(json_extract_string(props, '$.k') as integer), event_id) as k, max(event_id) as version
from events group by user_id"""

PAYLOAD_EXTRACT = """with fields as (
  select event_id, coalesce(cast(trunc(try_cast(json_extract_string(props, '$.k') as double)) as integer), 0) as k,
    coalesce(cast(trunc(try_cast(json_extract_string(props, '$.amount') as double)) as integer), 0) as amount,
    coalesce(json_extract_string(props, '$.product'), 'unknown') as product, user_id
  from events)
select event_id, k, amount, product, greatest(k, 50) as at_least_50, greatest(0, k - 12) as clamped,
  cast(user_id as varchar) as key
from fields"""
ENVELOPE_ROUNDTRIP = f"""with {LOG}
select event_id, event_type, 1 as event_version, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as occurred_at,
  epoch_us(ts) as occurred_micros, key as aggregate_id, amount, coalesce(kase, 'ok') as case_name
from log"""
STABLE_ID = f"""with {LOG} select seq, {stable("event_type", "key", "cast(seq as varchar)")} as stable_id from log"""

OUTCOME = """case when event_type = 'CustomerBlocked' then 'malformed JSON'
    when event_type = 'OrderPlaced' then 'not a JSON object' when event_type = 'OrderConfirmed' then 'empty value'
    when event_type = 'OrderCreated' and amount < 10 then 'no value' else 'accepted' end"""
DELIVERY_REPORT = f"""with {LOG} select 'orders.events' as topic, {OUTCOME} as outcome, count(*) as records
from log group by all"""
CONSUMED_STREAM = f"""with {LOG} select {OUTCOME} as outcome, 'unknown' as product, count(*) as records
from log group by all"""
