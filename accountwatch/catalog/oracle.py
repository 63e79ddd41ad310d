"""The SQL each query must agree with, over the same tables registered as views."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Views over the tables, named as in canonical.py. Unused ones cost nothing.
_VIEWS = r"""
with account_events as (
  select e.event_id, cast(e.user_id as varchar) as account_id, c.c_name as account_name, c.c_acctbal as mrr,
    e.event_type,
    cast(json_extract_string(e.props, '$.k') as int) % 2 as category,
    e.props as event_body,
    cast(json_extract_string(e.props, '$.k') as int) % 5 + 1 as csat_score,
    cast(floor(epoch_us(e.ts) / 1000000) as bigint) as "timestamp",
    e.ts as event_timestamp
  from events e join customer c on c.c_custkey = e.user_id
),
ticket_rows as (
  select event_id, account_id, mrr, category, event_body, csat_score, "timestamp", event_timestamp,
    mrr * (5 - csat_score) as priority_score
  from account_events where mrr >= 5000 and csat_score <= 3 and event_type = 'error'
),
sliding as (
  select a.*, time_bucket(interval 2 days, event_timestamp, timestamp '1970-01-01') - i * interval 2 days as window_start
  from account_events a, (values (0), (1)) steps(i)
),
loop_counts as (
  select account_id, category, mrr, count(*) as incident_count,
    first(event_body order by event_timestamp, event_id) as event_summary,
    first(event_body order by event_timestamp desc, event_id desc) as last_summary,
    window_start, window_start + interval 4 days as window_end
  from sliding where event_type = 'error' and mrr >= 5000
  group by window_start, account_id, category, mrr
),
loop_rows as (select * exclude (last_summary) from loop_counts where incident_count >= 3),
churn_rows as (
  select account_id, mrr,
    count(*) filter (where event_type = 'view') as login_count,
    count(*) filter (where event_type = 'purchase') as feature_count,
    window_start, window_start + interval 4 days as window_end
  from sliding where mrr >= 5000
  group by window_start, account_id, mrr
  having login_count >= 2 and feature_count = 0
),
tickets as (
  select * exclude (event_timestamp),
    case when event_id % 3 = 0 then null when event_id % 7 = 0 then '' else 'draft' end as ai_draft,
    event_id % 5 = 0 as is_approved
  from ticket_rows
),
loops as (
  select *, case when account_id::bigint % 3 = 0 then null else 'draft' end as ai_draft, account_id::bigint % 5 = 0 as is_approved
  from loop_rows
),
churn as (
  select *, case when account_id::bigint % 4 = 0 then null else 'draft' end as ai_draft, account_id::bigint % 7 = 0 as is_approved
  from churn_rows
),
latest_tickets as (
  select * from tickets qualify row_number() over (partition by account_id, category
    order by ai_draft is not null desc, "timestamp" desc, event_id desc) = 1
),
latest_loops as (
  select * from loops qualify row_number() over (partition by account_id, category
    order by window_start desc, incident_count desc, mrr desc) = 1
),
latest_churn as (
  select * from churn qualify row_number() over (partition by account_id
    order by window_start desc, login_count desc, mrr desc) = 1
),
queue_tickets as (
  select * from tickets where not is_approved and (ai_draft is null or ai_draft = '')
  qualify row_number() over (partition by account_id order by "timestamp", event_id) = 1
),
queue_loops as (
  select * from loops where ai_draft is null or ai_draft = ''
  qualify row_number() over (partition by account_id, category
    order by window_start, incident_count desc, mrr desc) = 1
),
queue_churn as (
  select * from churn where ai_draft is null or ai_draft = ''
  qualify row_number() over (partition by account_id order by window_start, login_count desc, mrr desc) = 1
),
lanes as (
  select account_id, mrr, is_approved, ai_draft, 'Ticket Recovery' as lane, 1 as lane_rank,
    ai_draft is not null as has_draft, "timestamp" as reported, null::timestamp as started, category
  from latest_tickets
  union all
  select account_id, mrr, is_approved, ai_draft, 'Systemic Failure', 2, false, null, window_start, category from latest_loops
  union all
  select account_id, mrr, is_approved, ai_draft, 'Silent Churn Risk', 3, false, null, window_start, null from latest_churn
),
accounts as (
  select account_id, mrr, is_approved, ai_draft, lane, lane_rank from lanes
  qualify row_number() over (partition by account_id order by lane_rank, has_draft desc,
    reported desc nulls last, started desc nulls last, category desc nulls last) = 1
),
exposed as (
  select account_id, mrr from lanes where not is_approved
  qualify row_number() over (partition by account_id order by lane_rank, has_draft desc,
    reported desc nulls last, started desc nulls last, category desc nulls last) = 1
),
status_alerts as (
  select event_id, account_id, mrr, "timestamp", ai_draft as recovery_draft,
    case when is_approved then 'sent' when ai_draft is not null then 'completed' else 'pending' end as status
  from tickets
),
kb as (
  select vec_id as sop_id, 'label ' || label as category, 'Policy for label ' || label as content, embedding::double[] as embedding
  from embeddings qualify row_number() over (partition by label order by vec_id) = 1
),
distances as (
  select e.vec_id, kb.sop_id, round(list_cosine_distance(e.embedding::double[], kb.embedding), 12) as distance,
    kb.content as policy
  from embeddings e, kb
),
ranked as (
  select vec_id, sop_id, round(distance, 5) as distance, policy,
    cast(row_number() over (partition by vec_id order by distances.distance, sop_id) as int) as rank
  from distances
),
new_drafts as (
  select event_id, case when event_id % 7 = 0 then '' else 'draft ' || n end as draft, ts + n * interval 1 hour as drafted_at
  from events, (values (1), (2)) turns(n)
  where event_id % 3 <> 0 and (n = 1 or event_id % 2 = 0)
  qualify row_number() over (partition by event_id order by n desc) = 1
)
"""


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = _VIEWS + sql


# Sources and detection

oracle(
    "parse_events",
    """
select cast(event_id as varchar) as event_id, account_id as user_id, account_name as account_id,
  'contact@' || lower(replace(replace(account_name, ' ', ''), ',', '')) || '.com' as email,
  mrr, event_type, cast(category as varchar) as category, event_body, csat_score, "timestamp"
from account_events where event_id % 11 <> 0
union all
select null, null, null, null, null, null, null, null, null, null from account_events where event_id % 11 = 0
""",
)
oracle("rejected_events", "select '{broken ' || event_id as message from account_events where event_id % 11 = 0")
oracle(
    "contact_addresses",
    "select c_custkey, 'contact@' || lower(replace(replace(c_name, ' ', ''), ',', '')) || '.com' as email from customer",
)
oracle(
    "event_times",
    """select event_id, "timestamp", date_trunc('second', event_timestamp) as event_timestamp from account_events""",
)
oracle("priority_score", "select event_id, account_id, mrr * (5 - csat_score) as priority_score from account_events")
oracle("ticket_alerts", "select * from ticket_rows")
oracle(
    "low_csat_risk",
    "select event_id, account_id, mrr, event_body, csat_score from account_events where mrr >= 1000 and csat_score <= 3",
)
oracle("friction_loops", "select * from loop_rows")
oracle(
    "friction_loops_last_report",
    """
select account_id, category, mrr, incident_count, last_summary as event_summary, window_start, window_end
from loop_counts where incident_count >= 3
""",
)
oracle(
    "friction_loops_tumbling",
    """
select account_id, category, mrr, count(*) as incident_count,
  first(event_body order by event_timestamp, event_id) as event_summary,
  time_bucket(interval 4 days, event_timestamp, timestamp '1970-01-01') as window_start,
  time_bucket(interval 4 days, event_timestamp, timestamp '1970-01-01') + interval 4 days as window_end
from account_events where event_type = 'error' and mrr >= 5000
group by all having incident_count >= 3
""",
)
oracle("silent_churners", "select * from churn_rows")
oracle(
    "priority_ranking",
    "select event_id, account_id, priority_score from ticket_rows order by priority_score desc, event_id limit 100",
)

# Queues and current views

oracle("draft_queue_tickets", "select * from queue_tickets")
oracle("draft_queue_next", "select * from queue_tickets order by account_id limit 1")
oracle("draft_queue_loops", "select * from queue_loops")
oracle("draft_queue_churn", "select * from queue_churn")
oracle("latest_tickets", "select * from latest_tickets")
oracle("latest_loops", "select * from latest_loops")
oracle("latest_churn", "select * from latest_churn")
oracle(
    "approved_accounts",
    """
select account_id, mrr, category, event_body, ai_draft from tickets where is_approved
qualify row_number() over (partition by account_id order by ai_draft is not null desc, "timestamp" desc, event_id desc) = 1
""",
)
oracle(
    "needs_draft",
    "select event_id, account_id, ai_draft from tickets where not is_approved and (ai_draft is null or ai_draft = '')",
)
oracle(
    "ready_for_review",
    "select event_id, account_id, ai_draft from tickets where not is_approved and ai_draft is not null and ai_draft <> ''",
)
oracle(
    "ready_for_review_any_draft",
    "select event_id, account_id, ai_draft from tickets where not is_approved and ai_draft is not null",
)
oracle("pending_review", "select * from latest_loops where not is_approved")

oracle("pending_review_churn", "select * from latest_churn where not is_approved")

# State

oracle(
    "apply_drafts",
    """
select t.event_id, t.account_id, t.mrr, d.draft as ai_draft, d.drafted_at, false as is_approved
from ticket_rows t left join new_drafts d using (event_id)
""",
)
oracle(
    "apply_approvals",
    """
select event_id, account_id, mrr,
  case when event_id % 5 = 0 and event_id % 10 <> 0 then 'edited' else ai_draft end as ai_draft,
  event_id % 5 = 0 as is_approved
from tickets
""",
)
oracle(
    "lane_state",
    """
select *,
  case when account_id::bigint % 5 = 0 then 'edited' when account_id::bigint % 3 <> 0 and account_id::bigint % 7 <> 0 then 'draft' end as ai_draft,
  case when account_id::bigint % 3 <> 0 and account_id::bigint % 7 <> 0 then window_start end as drafted_at,
  account_id::bigint % 5 = 0 as is_approved
from loop_rows
""",
)
oracle(
    "lane_state_by_time",
    """
select *,
  case when account_id::bigint % 2 = 0 and account_id::bigint % 3 <> 2 then 'edited' else 'draft' end as ai_draft,
  window_start + (account_id::bigint % 3) * interval 1 hour as drafted_at,
  account_id::bigint % 2 = 0 as is_approved
from loop_rows
""",
)
oracle("alert_status", "select event_id, case when is_approved then 'Actioned' else 'At Risk' end as status from tickets")
oracle("drafted_rows", "select account_id, mrr, recovery_draft from status_alerts where status = 'completed'")
oracle(
    "mark_sent",
    """
select event_id, account_id, case when event_id % 5 = 0 then 'sent' else status end as status,
  case when event_id % 5 = 0 and event_id % 10 <> 0 then 'edited' else recovery_draft end as recovery_draft
from status_alerts
""",
)

# Policies, tiers, briefs and drafts

oracle("nearest_policies", "select * from ranked where rank = 1")
oracle("nearest_policies_doubled", "select * from ranked where rank = 1")
oracle("nearest_policies_one_length", "select * from ranked where rank = 1")
oracle("nearest_policies_topk", "select * from ranked where rank <= 3")
oracle("nearest_policies_blocked", "select * from ranked where rank <= 2")
oracle(
    "cosine_distances",
    """
select vec_id, round(list_cosine_distance(embedding::double[], list_reverse(embedding)::double[]), 5) as distance
from embeddings
""",
)
oracle(
    "response_tiers",
    """
select event_id,
  case when mrr * 2 >= 15000 then 'ULTRA-VIP: Executive Outreach. Immediate 30-min Zoom invite.'
       when mrr * 2 >= 10000 then 'VIP Concierge: Priority response within 1 hour.'
       else 'Growth Account: Standard 4-hour recovery protocol.' end
  || ' Follow this specific protocol: ' || case when event_id % 3 <> 0 then 'policy ' || category else '' end
  as recovery_strategy
from account_events
""",
)
oracle(
    "response_tiers_variant",
    """
select event_id,
  case when mrr > 5000 then 'High-Priority: Offer 1-on-1 Product Lead call + 20% loyalty discount.'
       else 'Standard: Offer 1 month free credit + technical guide.' end as recovery_strategy
from account_events
""",
)
oracle(
    "strip_preambles",
    r"""
, blanks as (
  select string_agg(chr(c), '') as chars from (
    select unnest([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198,
                   8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288]) as c)
),
raw as (
  select doc_id, chars, trim(case when doc_id % 2 = 0 then text
    else 'Here is the email:' || chr(10) || chr(10) || ' ' || chr(9) || 'Hi Team ' || doc_id || ',' || chr(10) || text end,
    chars) as draft
  from documents, blanks
),
lines as (select *, string_split(draft, chr(10)) as parts from raw),
starts as (
  select *, list_position([starts_with(lower(trim(p, chars)), 'hi ') for p in parts], true) as start from lines
)
select doc_id,
  case when coalesce(start, 0) = 0 then draft
       else trim(array_to_string(parts[start:], chr(10)), chars) end as draft
from starts
""",
)
_CLOSING = (
    "'Open with ''Hi [Account] Team,'' and put nothing before it.' || chr(10) || "
    "'At most {words} words, no placeholders. Tone: {tone}.' || chr(10) || 'Sign as Ada, Example Ltd.'"
)
oracle(
    "ticket_brief",
    """
select q.event_id,
  'Write a recovery email from a senior customer success manager at Example Ltd.' || chr(10)
  || 'Account: ' || q.account_id || chr(10) || 'Issue type: ' || q.category || chr(10)
  || 'Complaint: ' || q.event_body || chr(10)
  || 'Resolution policy: ' || coalesce(r.policy, 'No specific policy found. Use general best practices.') || chr(10)
  || 'Strategy: ' || case when q.mrr >= 15000 then 'ULTRA-VIP: Executive Outreach. Immediate 30-min Zoom invite.'
       when q.mrr >= 10000 then 'VIP Concierge: Priority response within 1 hour.'
       else 'Growth Account: Standard 4-hour recovery protocol.' end
  || ' Follow this specific protocol: ' || coalesce(r.policy, 'No specific policy found. Use general best practices.') || chr(10)
  || 'Acknowledge the complaint, give the steps of the policy, end with one next step.' || chr(10)
  || 'Offer a call for technical or integration issues only. Never name an internal tier.' || chr(10)
  || """
    + _CLOSING.format(words=100, tone="direct, empathetic, focused on the solution")
    + """ as brief
from queue_tickets q left join ranked r on r.vec_id = q.account_id::bigint and r.rank = 1
""",
)
oracle(
    "loop_brief",
    """
select account_id, category,
  'Write an escalation email from a senior customer success manager at Example Ltd.' || chr(10)
  || 'Account: ' || account_id || chr(10) || 'Repeated issue: ' || category || chr(10)
  || 'Reports in the window: ' || incident_count || chr(10) || 'Reported as: ' || event_summary || chr(10)
  || 'Apologise for the repeated trouble, say that engineering has it, offer a 30-minute call.' || chr(10)
  || """
    + _CLOSING.format(words=80, tone="accountable, focused on the solution")
    + " as brief from queue_loops",
)
oracle(
    "churn_brief",
    """
select account_id,
  'Write a re-engagement email from a product adoption specialist at Example Ltd.' || chr(10)
  || 'Account: ' || account_id || chr(10) || 'Logins without feature use: ' || login_count || chr(10)
  || 'Start from the observation, not from a sale, and offer a 15-minute onboarding call.' || chr(10)
  || """
    + _CLOSING.format(words=70, tone="warm, observant, never pushy")
    + " as brief from queue_churn",
)
oracle(
    "offer_brief",
    """
select event_id,
  'Write a short recovery email from a senior customer success manager at Example Ltd.' || chr(10)
  || 'Account: ' || account_id || chr(10) || 'Issue type: ' || category || chr(10)
  || 'Strategy: ' || case when mrr > 5000 then 'High-Priority: Offer 1-on-1 Product Lead call + 20% loyalty discount.'
       else 'Standard: Offer 1 month free credit + technical guide.' end || chr(10)
  || 'Address the customer by account when no name is known.' || chr(10)
  || """
    + _CLOSING.format(words=80, tone="empathetic but formal")
    + " as brief from ticket_rows",
)
oracle(
    "draft_with",
    """
select account_id, category, window_start,
  case when account_id::bigint % 13 <> 0 then 'Here is the email:' || chr(10) || chr(10) || 'Hi ' || account_id || ' Team,'
    || chr(10) || 'We are on it.' || chr(10) end as draft,
  case when account_id::bigint % 13 = 0 then 'Agent Error: no answer for ' || account_id end as error
from loops
""",
)
oracle(
    "undrafted_after_failures",
    """
select event_id, account_id, cast(null as varchar) as ai_draft from ticket_rows
where account_id::bigint % 13 = 0 or account_id::bigint % 11 = 0 or event_id % 17 = 0
""",
)
oracle(
    "screened_drafts",
    """
select event_id, account_id,
  case when account_id::bigint % 13 = 0 then 'Agent Error: no answer for ' || account_id
    when coalesce(event_body, '') = '' then 'No complaint provided.'
    else 'Here is the email:' || chr(10) || chr(10) || 'Hi ' || account_id || ' Team,' || chr(10) || 'We are on it.' || chr(10) end as draft,
  case when account_id::bigint % 13 = 0 then 'Agent Error: no answer for ' || account_id end as error
from account_events where mrr >= 1000 and csat_score <= 3
""",
)
oracle(
    "ticket_drafts",
    """
select event_id, 'Hi ' || account_id || ' Team,' || chr(10) || 'We are on it.' as draft
from queue_tickets where account_id::bigint % 13 <> 0
""",
)
oracle(
    "churn_drafts",
    """
select account_id, window_start, 'Hi ' || account_id || ' Team,' || chr(10) || 'We are on it.' as draft
from queue_churn where account_id::bigint % 13 <> 0
""",
)

# Figures

oracle("all_lanes", "select account_id, mrr, is_approved, ai_draft, lane, lane_rank from lanes")
oracle("pending_all_lanes", "select account_id, mrr from lanes where not is_approved")
oracle("one_row_per_account", "select * from accounts")
oracle(
    "lane_kpis",
    """
select (select count(*) from lanes) as total_risk_events,
  round(coalesce((select avg(is_approved::int) * 100 from latest_tickets), 0), 2) as success_rate,
  round(coalesce((select sum(mrr) from (
    select mrr from latest_tickets where is_approved qualify row_number() over (partition by account_id
      order by ai_draft is not null desc, "timestamp" desc, category desc) = 1)), 0), 2) as revenue_actioned,
  round(coalesce((select sum(mrr) from exposed), 0), 2) as revenue_at_risk
""",
)
oracle(
    "risk_by_alert_type",
    "select lane, round(coalesce(sum(mrr) filter (where not is_approved), 0), 2) as mrr from lanes group by lane",
)
oracle(
    "revenue_funnel",
    """
select 'Total Revenue Risk Detected' as stage, round(coalesce(sum(mrr), 0), 2) as number from accounts
union all
select 'AI Draft Generated', round(coalesce(sum(mrr), 0), 2) from accounts where ai_draft is not null and ai_draft <> ''
union all
select 'Revenue Actioned', round(coalesce(sum(mrr), 0), 2) from accounts where is_approved
""",
)
oracle("top_exposed_accounts", "select account_id, mrr from exposed order by mrr desc, account_id limit 10")
oracle("alert_counts", "select account_id, is_approved, count(*) as alerts from latest_tickets group by all")
oracle("alert_counts_loops", "select account_id, is_approved, count(*) as alerts from latest_loops group by all")
oracle("alert_counts_churn", "select account_id, is_approved, count(*) as alerts from latest_churn group by all")
oracle(
    "overview",
    """
, kpis as (
  select 'total_risk_events' as figure, count(*)::double as number from lanes
  union all select 'success_rate', coalesce((select avg(is_approved::int) * 100 from latest_tickets), 0)
  union all select 'revenue_actioned', coalesce((select sum(mrr) from (
    select mrr from latest_tickets where is_approved qualify row_number() over (partition by account_id
      order by ai_draft is not null desc, "timestamp" desc, category desc) = 1)), 0)
  union all select 'revenue_at_risk', coalesce((select sum(mrr) from exposed), 0)
  union all select 'Total Revenue Risk Detected', coalesce(sum(mrr), 0) from accounts
  union all select 'AI Draft Generated', coalesce(sum(mrr), 0) from accounts where ai_draft is not null and ai_draft <> ''
  union all select 'Revenue Actioned', coalesce(sum(mrr), 0) from accounts where is_approved
)
select figure, null::varchar as lane, null::varchar as account_id, null::boolean as is_approved, round(number, 2) as number from kpis
union all
select 'pending_revenue', lane, null, null, round(coalesce(sum(mrr) filter (where not is_approved), 0), 2) from lanes group by lane
union all
select 'alerts', lane, account_id, is_approved, count(*)::double from lanes group by lane, account_id, is_approved
union all
select * from (select 'top_exposed', null, account_id, null, mrr from exposed order by mrr desc, account_id limit 10)
""",
)
oracle(
    "draft_backlog",
    """
select count(*) as total_events,
  count(*) filter (where ai_draft is not null and not is_approved) as pending_review,
  round(coalesce(sum(mrr) filter (where ai_draft is not null and not is_approved), 0), 2) as revenue_pending_review,
  round(coalesce(sum(mrr) filter (where ai_draft is null), 0), 2) as revenue_undrafted
from tickets
""",
)
oracle(
    "lane_success",
    """
select round(coalesce(avg(is_approved::int) * 100, 0), 2) as success_rate,
  round(coalesce((select sum(mrr) from (select distinct account_id, mrr from tickets where is_approved)), 0), 2)
    as revenue_actioned
from tickets
""",
)
oracle("exposure_by_account", "select account_id, is_approved, round(sum(mrr), 2) as mrr from tickets group by all")
oracle("exposure_by_status", "select account_id, status, round(sum(mrr), 2) as mrr from status_alerts group by all")
oracle("exposure_by_category", "select category, round(sum(mrr), 2) as mrr from tickets group by all")
oracle(
    "status_kpis",
    """
select count(*) as total_alerts,
  round(coalesce(sum(mrr) filter (where status = 'pending'), 0), 2) as revenue_pending,
  count(*) filter (where status = 'completed') as drafts_ready
from status_alerts
""",
)
oracle(
    "recent_drafts",
    """
select account_id, mrr, recovery_draft from status_alerts where status = 'completed'
order by "timestamp" desc, event_id desc limit 5
""",
)
oracle(
    "mean_time_to_draft",
    """
select round(avg(epoch_us(drafted_at) - epoch_us(event_timestamp)) / 60000000.0, 4) as minutes
from ticket_rows join new_drafts using (event_id)
""",
)

# Written and read back

oracle("lane_round_trip", "select * from loop_rows")
oracle(
    "lane_compaction",
    "select event_id, account_id, mrr, strftime(event_timestamp, '%Y-%m-%d') as day from ticket_rows",
)
oracle("folded_lane", "select * from loop_rows")
oracle("knowledge_base", "select sop_id, category, content, cast(len(embedding) as int) as dimensions from kb")
oracle("export_actioned", "select account_id, mrr, is_approved, ai_draft, 'Actioned' as status from accounts where is_approved")
oracle("ticket_library", "select lang as category, text as support_text, cast(doc_id % 2 + 1 as int) as suggested_csat from documents")

# Streams: append mode leaves out the windows the watermark has not closed.

oracle("ticket_alerts_stream", "select * exclude (event_timestamp) from ticket_rows")
oracle(
    "friction_loops_stream",
    """
select * from loop_rows where window_end <= (
  select max(event_timestamp) - interval 1 minute from account_events
  where mrr >= 5000 and event_type = 'error')
""",
)
oracle(
    "silent_churners_stream",
    """
select * from churn_rows where window_end <= (
  select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000)
""",
)
oracle("friction_loops_early_stream", "select * from loop_rows")
oracle("silent_churners_early_stream", "select * from churn_rows")
oracle("friction_loops_early_slices", "select * from loop_rows")
oracle("silent_churners_early_slices", "select * from churn_rows")
oracle(
    "lanes_stream",
    """
select 'tickets' as lane, account_id, mrr from ticket_rows
union all
select 'loops', account_id, mrr from loop_rows where window_end <= (
  select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000 and event_type = 'error')
union all
select 'churn', account_id, mrr from churn_rows where window_end <= (
  select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000)
""",
)
oracle(
    "friction_loops_late_rows",
    """
, middle as (
  select min(epoch_us(ts)) + (max(epoch_us(ts)) + 1 - min(epoch_us(ts))) // 2 as micros from events
)
select account_id, category, mrr, count(*) as incident_count,
  first(event_body order by event_timestamp, event_id) as event_summary,
  window_start, window_start + interval 4 days as window_end
from sliding, middle where event_type = 'error' and mrr >= 5000 and epoch_us(event_timestamp) >= middle.micros
group by window_start, account_id, category, mrr
having count(*) >= 3 and window_start + interval 4 days <= (
  select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000 and event_type = 'error')
""",
)

# One stream for all outputs: messages that are not JSON count nowhere but among the rejects.

_READ = """
, read_events as (select * from account_events where event_id % 11 <> 0),
read_sliding as (select * from sliding where event_id % 11 <> 0),
read_loops as (
  select account_id, category::varchar as category, mrr, count(*) as incident_count,
    first(event_body order by event_timestamp, event_id::varchar) as event_summary,
    window_start, window_start + interval 4 days as window_end
  from (select * replace (date_trunc('second', event_timestamp) as event_timestamp) from read_sliding)
  where event_type = 'error' and mrr >= 5000 group by window_start, account_id, category, mrr having count(*) >= 3
),
read_churn as (
  select account_id, mrr, count(*) filter (where event_type = 'view') as login_count,
    count(*) filter (where event_type = 'purchase') as feature_count,
    window_start, window_start + interval 4 days as window_end
  from read_sliding where mrr >= 5000 group by window_start, account_id, mrr having login_count >= 2 and feature_count = 0
)
"""
oracle(
    "routed_messages",
    """
select case when event_id % 11 <> 0 then event_id::varchar end as event_id,
  case when event_id % 11 <> 0 then account_id end as account_id, case when event_id % 11 <> 0 then mrr end as mrr,
  case when event_id % 11 <> 0 then event_type end as event_type, case when event_id % 11 <> 0 then category::varchar end as category,
  case when event_id % 11 <> 0 then csat_score end as csat_score, case when event_id % 11 <> 0 then "timestamp" end as "timestamp",
  null::varchar as message
from account_events
union all
select null, null, null, null, null, null, null, '{broken ' || event_id from account_events where event_id % 11 = 0
""",
)
oracle(
    "routed_alerts",
    _READ
    + """
select 'tickets' as lane, account_id, mrr, 1::bigint as number from read_events
where mrr >= 5000 and csat_score <= 3 and event_type = 'error'
union all select 'loops', account_id, mrr, incident_count from read_loops
union all select 'churn', account_id, mrr, login_count from read_churn
""",
)
oracle("routed_loops_after_lost_checkpoint", _READ + "select * from read_loops")
oracle("routed_churn_after_lost_checkpoint", _READ + "select * from read_churn")

# Late events: after a correction the stream's closed windows are those of the batch.

oracle(
    "friction_loops_late_events",
    """
, middle as (
  select min(epoch_us(ts)) + (max(epoch_us(ts)) + 1 - min(epoch_us(ts))) // 2 as micros from events
)
select account_id, category, mrr, event_timestamp, window_start, window_start + interval 4 days as window_end
from sliding, middle where event_type = 'error' and mrr >= 5000 and epoch_us(event_timestamp) < middle.micros
  and window_start + interval 4 days <= (
    select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000 and event_type = 'error')
""",
)
ORACLE["friction_loops_late_corrected"] = ORACLE["friction_loops_stream"]
ORACLE["silent_churners_late_corrected"] = ORACLE["silent_churners_stream"]

# Windows by revenue band: a run for each band, put together.

_BANDED = """
, banded as (
  select a.*, time_bucket(interval 4 days, event_timestamp, timestamp '1970-01-01') - i * interval 4 days as window_start, interval 8 days as width
  from account_events a, (values (0), (1)) steps(i) where mrr >= 5000 and mrr < 7000
  union all
  select a.*, time_bucket(interval 2 days, event_timestamp, timestamp '1970-01-01') - i * interval 2 days, interval 4 days
  from account_events a, (values (0), (1)) steps(i) where mrr >= 7000 and mrr < 9000
  union all
  select a.*, time_bucket(interval 2 days, event_timestamp, timestamp '1970-01-01'), interval 2 days from account_events a where mrr >= 9000
),
band_loops as (
  select account_id, category, mrr, count(*) as incident_count, first(event_body order by event_timestamp, event_id) as event_summary,
    window_start, window_start + any_value(width) as window_end
  from banded where event_type = 'error' group by window_start, account_id, category, mrr having count(*) >= 3
)
"""
oracle("friction_loops_by_band", _BANDED + "select * from band_loops")
oracle(
    "friction_loops_by_band_stream",
    _BANDED
    + """
select * from band_loops where window_end <= (
  select max(event_timestamp) - interval 1 minute from account_events where mrr >= 5000 and event_type = 'error')
""",
)

ORACLE["lane_state_by_key"] = ORACLE["lane_state_by_time"]

ORACLE["overview_refreshed"] = ORACLE["overview"]
