"""SQL that the further queries must agree with, over the whole tables."""

from __future__ import annotations

from .oracle import LOG, PLACED, PROJECTION, SAGA_PROGRESS, TAIL_READ
from .oracle import PAYMENTS_STREAM as PAYMENTS

__all__ = ["PAYMENTS", "PROJECTION", "SAGA_PROGRESS", "TAIL_READ"]

SAGA_SESSIONS = f"""with {LOG},
steps as (
  select key || '/' || strftime(ts, '%Y-%m-%d') as aggregate_id, ts,
    case event_type when 'OrderCreated' then 1 else 4 end as step
  from log where event_type in ('OrderCreated', 'OrderConfirmed')),
folded as (
  select aggregate_id, bool_or(step = 1) as step_1, false as step_2, false as step_3,
    bool_or(step = 4) as step_4, max(step) as furthest, max(ts) as last_at
  from steps group by aggregate_id)
select aggregate_id, step_1, step_2, step_3, step_4,
  case furthest when 1 then 'OrderCreated' else 'OrderConfirmed' end as furthest_step,
  case furthest when 1 then 'PaymentReserved' end as next_step, furthest <> 4 as stuck
from folded where last_at + interval 1 day <= (select date_trunc('millisecond', max(ts)) from steps) - interval 12 day"""

FACTS_AND_STATES = f"""with {LOG},
paid as (select * from log where event_type = 'OrderPaid'),
created as (select * from log where event_type = 'OrderCreated'),
bounds as (select min(seq) as low, max(seq) as high from log),
delivered as (
  select ts, event_type, unnest([third + (case when seq % 5 = 0 then 1 else 0 end), third + (case when seq % 5 = 0 or seq % 7 = 0 then 1 else 0 end)]) as run
  from (select *, (seq - low) * 3 // (high - low + 1) as third from log cross join bounds)
  where event_type in ('OrderPaid', 'OrderCreated')),
-- a query started again knows the common watermark and takes each side's anew from what it then reads
reached as (
  select least(max(ts) filter (event_type = 'OrderPaid'), max(ts) filter (event_type = 'OrderCreated')) as "at"
  from delivered group by run),
mark as (select date_trunc('millisecond', max("at")) - interval 12 day as mark_at from reached)
select p.event_id, p.user_id, c.event_id as state_id, c.amount as ordered
from paid p left join created c
  on c.user_id = p.user_id and c.ts between p.ts - interval 6 hour and p.ts + interval 6 hour
-- without a state a fact is given once none can come any more
where c.event_id is not null or p.ts + interval 6 hour < (select mark_at from mark)"""

FACTS_AND_TABLE = f"""with {LOG}
select event_id, user_id, c_name as name from log left join customer on user_id = c_custkey where event_type = 'OrderPaid'"""

ROUTED = f"""with {LOG},
named as (
  select event_id, event_type, case event_type when 'OrderPaid' then 'payments.events'
      when 'CustomerBlocked' then 'orders.notifications' else 'orders.events' end as target,
    case when seq % 11 = 0 then 'payload is no object'
      when seq % 13 = 0 then case event_type when 'OrderPaid' then 'missing amount, case'
        when 'OrderPlaced' then 'missing amount' when 'CustomerBlocked' then 'missing case' end end as reason
  from log)
select event_id, event_type, target || case when reason is null then '' else '.quarantine' end as topic, reason from named"""


def _fold(name: str, where: str) -> str:
    return f"""{name} as (
  select key as order_id, arg_max(case event_type when 'OrderCreated' then 'CREATED' when 'OrderPaid' then 'PAID'
      when 'OrderConfirmed' then 'CONFIRMED' else event_type end, seq) as status, max(amount) as amount,
    cast(max(seq) as varchar) as last_event_id
  from log where event_type like 'Order%' and {where} group by key)"""


DIFFERENCE = f"""with {LOG},
{_fold("one", "user_id % 50 <> 7")},
{_fold("two", "user_id % 50 <> 9 and seq % 97 <> 0")}
select order_id, case when two.status is null then 'removed' when one.status is null then 'added' else 'changed' end as change,
  one.status as old_status, two.status as new_status, one.amount as old_amount, two.amount as new_amount
from one full join two using (order_id)
where (one.status, one.amount, one.last_event_id) is distinct from (two.status, two.amount, two.last_event_id)"""

TRACES = """with recursive links as (
  select event_id, case when event_id % 50 = 0 then null when event_id % 50 < 46
      then event_id - event_id % 50 + (event_id % 50 - 1) // 2
      when event_id % 50 = 46 then -1 when event_id % 50 = 47 then event_id + 2 else event_id - 1 end as caused_by
  from events),
walk as (
  select event_id, event_id as root, 0 as depth, cast(event_id as varchar) as path from links
  where caused_by is null or caused_by not in (select event_id from links)
  union all
  select l.event_id, w.root, w.depth + 1, w.path || '>' || l.event_id from walk w join links l on l.caused_by = w.event_id)
select event_id, root, depth, coalesce(path, '') as path from links left join walk using (event_id)"""

RESULTS = f"""with {LOG},
told as (
  select seq as event_id, key, case event_type when 'CustomerBlocked' then 'malformed JSON'
    when 'OrderPlaced' then 'not a JSON object' when 'OrderConfirmed' then 'empty value'
    when 'OrderCreated' then case when amount < 10 then 'no value' end end as reason from log)
select event_id, key, case when reason is null then 'SUCCESS' else 'ERROR' end as result, reason from told"""

LAG = f"""with {PLACED},
bounds as (select min(seq) as low, max(seq) as high from placed),
readers as (select unnest(['keeps-up', 'stops', 'never-began']) as reader),
had as (
  select r.reader, p.partition, max(p.seq) + 1 as end_offset,
    coalesce(max(p.seq + 1) filter (read), 0) as position, count(*) filter (read) as records
  from (
    select placed.*, reader, case reader when 'keeps-up' then true
      when 'stops' then (seq - low) * 3 / (high - low + 1) < 1 else false end as read
    from placed cross join readers cross join bounds) p join readers r using (reader)
  group by r.reader, p.partition)
select reader, partition, end_offset, position, end_offset - position as lag, records from had"""

RELAYED_TWICE = """select 'c-' || o_custkey as aggregate_id, count(*) as outbox_rows, cast(0 as bigint) as still_pending,
  2 * count(*) filter (o_orderstatus = 'P') as sent, count(*) filter (o_orderstatus = 'P') as distinct_ids,
  cast(0 as bigint) as sent_at_last
from orders group by o_custkey"""
