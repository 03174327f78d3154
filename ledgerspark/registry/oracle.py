"""The named queries written independently in plain SQL, for comparison.

Common table expressions hold the mapped entities and the cleaned tables; each
query is a select over them. Money and shares are cast to double, dates to
text, so both sides print alike.
"""

from __future__ import annotations

from ledgerspark.sources import testdata as td

AS_OF = "date '2026-09-16'"


def _select(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f'{text} as "{name}"' for name, text in columns.items())
    return f"select {listed} from {source}"


PEOPLE = (
    "(select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer union all "
    + _select(td.SUPPLIER_AS_PERSON, "supplier")
    + ") c join nation n on n.n_nationkey = c.c_nationkey join region r on r.r_regionkey = n.n_regionkey"
)

CTES = {
    "projects": _select(
        td.PROJECT_COLUMNS,
        "orders o join customer c on c.c_custkey = o.o_custkey join nation n on n.n_nationkey = c.c_nationkey "
        "join region r on r.r_regionkey = n.n_regionkey left join (select l_orderkey, "
        "sum(cast(l_extendedprice as decimal(14,2))) as cost, max(cast(l_shipdate as date)) as last_ship "
        "from lineitem group by l_orderkey) a on a.l_orderkey = o.o_orderkey",
    ),
    "employees": _select(td.EMPLOYEE_COLUMNS, PEOPLE),
    "history": _select(
        td.HISTORY_COLUMNS,
        "(select o_custkey, o_orderdate, o_orderpriority, o_totalprice, "
        "row_number() over w as rn, lag(o_totalprice) over w as prev_price, lag(o_orderpriority) over w as prev_pri "
        "from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)) h",
    ),
    "transactions": _select(
        td.TRANSACTION_COLUMNS,
        "lineitem l join supplier s on s.s_suppkey = l.l_suppkey join part p on p.p_partkey = l.l_partkey",
    ),
    "platform_events": _select({**td.EVENT_COLUMNS, "ts": "cast(ts as timestamp)"}, "events"),
    "projects_clean": """
        select project_id, project_name, department,
          case lower(trim(status)) when 'in progress' then 'In Progress' when 'completed' then 'Completed'
            when 'not started' then 'Not Started' when 'on hold' then 'On Hold' end as status,
          priority, region, project_manager_id,
          try_cast(start_date as date) as start_date, try_cast(end_date as date) as end_date,
          coalesce(budget, 0) as budget, coalesce(actual_cost, 0) as actual_cost,
          actual_cost - budget as budget_variance,
          coalesce(actual_cost > budget, false) as is_over_budget,
          date_diff('day', try_cast(start_date as date), try_cast(end_date as date)) as duration_days,
          case lower(trim(status)) when 'in progress' then 'Active' when 'completed' then 'Closed'
            else 'Pending' end as status_category,
          case when budget > 0 then cast(actual_cost as double) / cast(budget as double) * 100 end
            as budget_utilisation_pct,
          case when priority = 'Critical' or coalesce(actual_cost > budget, false) then 'High'
            when priority = 'High' or (budget > 0 and cast(actual_cost as double) / cast(budget as double) * 100 > 90)
            then 'Medium' else 'Low' end as risk_level
        from projects""",
    "employee_dates": f"""
        select *,
          case when length(trim(hire_date)) = 10 then try_cast(hire_date as date) end as parsed,
          coalesce(level, 'Unknown') as known_level
        from employees""",
    "usable_dates": f"""
        select employee_id,
          case when parsed between date '1990-01-01' and {AS_OF} then parsed end as usable from employee_dates""",
    "median_date": """
        select date '1970-01-01' + cast(floor(median(date_diff('day', date '1970-01-01', usable))) as int) as day
        from usable_dates""",
    "bands": """
        select known_level as level, median, iqr, greatest(median - 2 * iqr, 0) as lower_bound,
          median + 2 * iqr as upper_bound
        from (select known_level, round(quantile_cont(cast(salary as double), 0.5), 4) as median,
            round(quantile_cont(cast(salary as double), 0.75), 4) - round(quantile_cont(cast(salary as double), 0.25), 4)
              as iqr
          from employee_dates group by known_level)""",
    "employees_clean": """
        select e.employee_id,
          case when trim(coalesce(full_name, '')) = '' then 'Unknown' else full_name end as full_name,
          case when trim(coalesce(email, '')) = '' then 'missing.' || lower(e.employee_id) || '@example.com'
            else email end as email,
          cast(coalesce(u.usable, m.day) as date) as hire_date,
          department, role, e.level,
          case when salary < lower_bound then lower_bound when salary > upper_bound then upper_bound
            else cast(salary as double) end as salary,
          case when manager_id is null then 'Unknown' when manager_id = e.employee_id then null
            else manager_id end as manager_id,
          region, status,
          case when years_experience < 0 then 0 when years_experience > 50 then 50 else years_experience end
            as years_experience
        from employee_dates e join usable_dates u on u.employee_id = e.employee_id
          join bands b on b.level = e.known_level cross join median_date m""",
    "versions_history": """
        select employee_id, new_salary as salary, new_role as role, new_level as level, change_reason,
          effective_date as valid_from,
          coalesce(lead(effective_date) over w, date '9999-12-31') as valid_to,
          lead(effective_date) over w is null as is_current
        from history window w as (partition by employee_id
          order by effective_date, cast(new_salary as decimal(18,4)), new_role, new_level, change_reason)""",
    "versions_no_history": """
        select employee_id, salary, role, level, 'Initial appointment' as change_reason, hire_date as valid_from,
          date '9999-12-31' as valid_to, true as is_current
        from employees_clean e where not exists (select 1 from history h where h.employee_id = e.employee_id)""",
    "versions": """
        select v.employee_id, e.full_name, e.email, e.department, v.role, v.level,
          cast(cast(cast(v.salary as decimal(18,4)) as decimal(12,2)) as double) as salary, e.manager_id, e.region, e.status, v.change_reason,
          v.valid_from, v.valid_to, v.is_current,
          v.employee_id || '@' || cast(v.valid_from as varchar) as version_id
        from (select * from (select employee_id, cast(salary as double) as salary, role, level, change_reason,
            valid_from, valid_to, is_current from versions_history)
          union all select employee_id, salary, role, level, change_reason, valid_from, valid_to, is_current
            from versions_no_history) v
        join employees_clean e on e.employee_id = v.employee_id""",
    "dated": "select *, cast(transaction_date as date) as day from transactions",
    "dim_project": "select row_number() over (order by project_id) as project_key, * from projects_clean",
    "dim_vendor": """
        select row_number() over (order by vendor_id, vendor_name) as vendor_key, vendor_id, vendor_name
        from (select distinct vendor_id, vendor_name from transactions)""",
    "dim_employee": "select row_number() over (order by employee_id, valid_from, valid_to, salary, role, level, "
        "change_reason) as employee_key, * from versions",
    "fact": """
        select row_number() over (order by transaction_id) as transaction_key, transaction_id, project_key,
          employee_key, vendor_key, cast(strftime(day, '%Y%m%d') as bigint) as date_key, amount, currency, category,
          payment_status, invoice_ref, day
        from dated t left join dim_project p on p.project_id = t.project_id
          left join dim_vendor v on v.vendor_id = t.vendor_id
          left join dim_employee d on d.employee_id = t.approved_by and t.day >= d.valid_from and t.day < d.valid_to""",
    "good_events": "select * from platform_events where event_id is not null and user_id is not null",
    "steps": """
        select event_id, event_type, project_id, user_id, ts, severity, resolved_by,
          row_number() over (partition by project_id, event_type order by ts, event_id) as seq
        from good_events where event_type in ('escalation_raised', 'escalation_resolved')""",
    "escalations": """
        select a.event_id, a.project_id, a.user_id as raised_by, a.ts as raised_at, a.severity,
          b.ts is not null as resolved, b.resolved_by, b.ts as resolved_at,
          date_diff('second', a.ts, b.ts) / cast(3600 as double) as resolution_time_hours
        from (select * from steps where event_type = 'escalation_raised') a
          left join (select * from steps where event_type = 'escalation_resolved') b
            on b.project_id = a.project_id and b.seq = a.seq""",
    "queue": """
        select *, min(balance) over (partition by project_id order by ts, resolves, event_id
            rows between unbounded preceding and 1 preceding) as lowest
        from (select *, sum(1 - resolves) over w as opened, sum(1 - 2 * resolves) over w as balance
          from (select *, case event_type when 'escalation_resolved' then 1 else 0 end as resolves from steps)
          window w as (partition by project_id order by ts, resolves, event_id rows unbounded preceding))""",
}

PREFIX = "with " + ", ".join(f"{name} as ({text})" for name, text in CTES.items()) + " "


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = PREFIX + body


EVENT_OUT = f"select event_id, event_type, project_id, user_id, {_time('ts')} as timestamp, severity, resolved_by"

# sources and sinks
oracle("src_projects", """
    select project_id, status, cast(try_cast(start_date as date) as varchar) as start_date,
      cast(try_cast(end_date as date) as varchar) as end_date, cast(budget as double) as budget,
      cast(actual_cost as double) as actual_cost, cast(actual_cost - budget as double) as budget_variance,
      coalesce(actual_cost > budget, false) as is_over_budget,
      date_diff('day', try_cast(start_date as date), try_cast(end_date as date)) as duration_days
    from projects""")
oracle("src_employees", """
    select employee_id, full_name, email, hire_date, department, role, level, cast(salary as double) as salary,
      manager_id, region, status, cast(years_experience as bigint) as years_experience from employees""")
oracle("src_transactions", """
    select transaction_id, project_id, vendor_id, vendor_name, category, cast(amount as double) as amount, currency,
      cast(cast(transaction_date as date) as varchar) as transaction_date, payment_status, approved_by, invoice_ref,
      notes from transactions""")
oracle("src_history", """
    select employee_id, cast(previous_salary as double) as previous_salary, cast(new_salary as double) as new_salary,
      previous_role, new_role, previous_level, new_level, cast(effective_date as varchar) as effective_date,
      change_type, change_reason from history""")
oracle("src_events", f"{EVENT_OUT} from platform_events")
oracle("src_event_stream", f"{EVENT_OUT} from platform_events")
oracle("gen_dim_date", """
    select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(cast(d as date) as varchar) as full_date,
      year(d) as year, quarter(d) as quarter, month(d) as month, monthname(d) as month_name, weekofyear(d) as week,
      day(d) as day, dayname(d) as day_of_week, isodow(d) in (6, 7) as is_weekend
    from (select unnest(generate_series((select min(day) from dated)::timestamp, (select max(day) from dated)::timestamp,
      interval 1 day)) as d)""")
oracle("snk_event_stream", "select event_type as key, event_id, true as stamped from platform_events")

CLEAN_PROJECT_COLUMNS = """project_id, project_name, department, status, priority, region, project_manager_id,
      cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date,
      cast(budget as double) as budget, cast(actual_cost as double) as actual_cost,
      cast(budget_variance as double) as budget_variance, is_over_budget, duration_days, status_category"""
oracle("snk_csv", f"select {CLEAN_PROJECT_COLUMNS}, budget_utilisation_pct, risk_level from projects_clean")
oracle("snk_staging", "select project_id, status_category, risk_level from projects_clean")

DAILY = """select cast(event_date as varchar) as event_date, event_type, event_count,
      cast(sum(event_count) over (partition by event_type order by event_date
        rows between unbounded preceding and current row) as bigint) as cumulative_count"""
DAILY_FROM = """(select cast(ts as date) as event_date, event_type, count(*) as event_count
      from good_events group by 1, 2)"""
oracle("snk_parquet", f"{DAILY}, count(*) over () as rows_written from {DAILY_FROM}")

# projects
for column, text in {
    "budget_variance": "cast(budget_variance as double)",
    "is_over_budget": "is_over_budget",
    "duration_days": "duration_days",
    "risk_level": "risk_level",
    "status_category": "status_category",
}.items():
    oracle(f"p_{column}", f"select project_id, {text} as {column} from projects_clean")
oracle("p_status_clean", "select project_id, status from projects_clean")
oracle("p_budget_utilisation", """
    select project_id, round(budget_utilisation_pct, 6) as budget_utilisation_pct from projects_clean""")
oracle("p_zero_fill", """
    select project_id, cast(budget as double) as budget, cast(actual_cost as double) as actual_cost
    from projects_clean""")
oracle("q_projects_clean", f"""
    select {CLEAN_PROJECT_COLUMNS}, round(budget_utilisation_pct, 6) as budget_utilisation_pct, risk_level
    from projects_clean""")
oracle("r_risk_distribution", "select risk_level, count(*) as projects from projects_clean group by risk_level")

# employees
oracle("e_missing_email", "select employee_id, email from employees_clean")
oracle("e_fill_unknown", """
    select c.employee_id, c.full_name, c.department, c.role, c.level, coalesce(e.manager_id, 'Unknown') as manager_id,
      c.region, c.status from employees_clean c join employees e on e.employee_id = c.employee_id""")
oracle("e_invalid_hire_date", """
    select employee_id, hire_date from employee_dates where trim(hire_date) <> '' and parsed is null""")
oracle("e_implausible_hire_date", f"""
    select employee_id, hire_date from employee_dates where parsed < date '1990-01-01' or parsed > {AS_OF}""")
oracle("e_impute_hire_date", "select employee_id, cast(hire_date as varchar) as hire_date from employees_clean")
oracle("e_clamp_experience", """
    select employee_id, cast(greatest(least(years_experience, 50), 0) as bigint) as years_experience from employees""")
oracle("e_salary_band", """
    select e.employee_id, salary < lower_bound or salary > upper_bound as outside_band,
      cast(greatest(least(cast(salary as double), upper_bound), lower_bound) as double) as salary
    from employee_dates e join bands b on b.level = e.known_level""")
oracle("e_self_manager", "select employee_id, manager_id from employees_clean")
oracle("e_quality_summary", f"""
    select issue, affected_rows from (
      select 'missing_email' as issue, count(*) as affected_rows from employees where trim(coalesce(email, '')) = ''
      union all select 'missing_' || k, n from (
        select 'full_name' as k, count(*) as n from employees where trim(coalesce(full_name, '')) = ''
        union all select 'department', count(*) from employees where trim(coalesce(department, '')) = ''
        union all select 'role', count(*) from employees where trim(coalesce(role, '')) = ''
        union all select 'level', count(*) from employees where trim(coalesce(level, '')) = ''
        union all select 'manager_id', count(*) from employees where trim(coalesce(manager_id, '')) = ''
        union all select 'region', count(*) from employees where trim(coalesce(region, '')) = ''
        union all select 'status', count(*) from employees where trim(coalesce(status, '')) = '') where n > 0
      union all select 'invalid_hire_date_format', count(*) from employee_dates
        where trim(hire_date) <> '' and parsed is null
      union all select 'implausible_hire_date', count(*) from employee_dates
        where parsed < date '1990-01-01' or parsed > {AS_OF}
      union all select 'hire_date_imputed', count(*) from employee_dates
        where trim(hire_date) <> '' and (parsed is null or parsed < date '1990-01-01' or parsed > {AS_OF})
      union all select 'negative_years_experience', count(*) from employees where years_experience < 0
      union all select 'implausible_years_experience', count(*) from employees where years_experience > 50
      union all select 'salary_level_mismatch', count(*) from employee_dates e join bands b on b.level = e.known_level
        where salary < lower_bound or salary > upper_bound
      union all select 'self_referencing_manager', count(*) from employees where manager_id = employee_id)""")
oracle("q_employees_clean", """
    select employee_id, full_name, email, cast(hire_date as varchar) as hire_date, department, role, level, salary,
      manager_id, region, status, cast(years_experience as bigint) as years_experience from employees_clean""")
oracle("e_inactive_conflict", """
    select e.employee_id, status, usable is null as unusable_hire_date,
      coalesce(manager_id = e.employee_id, false) as self_managed
    from employees e join usable_dates u on u.employee_id = e.employee_id
    where status = 'Active' and (usable is null or manager_id = e.employee_id)""")

# transactions and events, row level
oracle("t_is_approved", "select transaction_id, approved_by is not null as is_approved from transactions")
oracle("t_amount_aed", """
    select transaction_id, cast(amount as double) as amount, coalesce(cast(amount as double), 0) as amount_aed
    from transactions""")
oracle("t_year_month", "select transaction_id, strftime(day, '%Y-%m') as transaction_year_month from dated")
oracle("v_drop_null_keys", "select event_id, user_id, event_type from good_events")
oracle("v_dedup_first", f"{EVENT_OUT} from platform_events")
oracle("v_counts", """
    select 2 * count(*) as read_rows, 2 * count(*) filter (where user_id is null) as missing_id_rows,
      count(*) filter (where user_id is not null) as copy_rows,
      count(*) filter (where user_id is not null) as kept_rows from platform_events""")
oracle("v_date_parts", """
    select event_id, cast(cast(ts as date) as varchar) as event_date, hour(ts) as event_hour,
      strftime(ts, '%Y-%m') as event_month from platform_events""")
oracle("v_project_filter", "select event_id, project_id from platform_events where project_id is not null")
oracle("filter_predicates", """
    select project_id, status, priority, cast(budget as double) as budget from projects_clean
    where status in ('In Progress', 'On Hold') and priority not in ('Low')
      and (budget > (select avg(cast(budget as double)) from projects_clean) or is_over_budget)""")

# joins
oracle("j_enrich_project", """
    select transaction_id, project_name, department from transactions t
    left join projects_clean p on p.project_id = t.project_id""")
oracle("j_enrich_approver", """
    select transaction_id, full_name as approver_name from transactions t
    left join employees_clean e on e.employee_id = t.approved_by""")
oracle("j_unique_key_guard", """
    select dataset, key, cast(sum(n) as bigint) as key_rows, count(*) as distinct_keys,
      count(*) filter (where n > 1) as repeated_keys
    from (select 'projects' as dataset, 'project_id' as key, project_id, count(*) as n from projects group by 3
      union all select 'employees', 'employee_id', employee_id, count(*) from employees group by 3
      union all select 'employees_salary_history', 'employee_id', employee_id, count(*) from history group by 3)
    group by dataset, key""")
oracle("j_refused_keys", "select employee_id, count(*) as copies from history group by employee_id having count(*) > 1")
oracle("t_unmatched_projects", """
    select count(*) as unmatched_transactions
    from (select project_id from transactions union all select project_id from platform_events) t
    where not exists (select 1 from projects_clean p where p.project_id = t.project_id)""")
oracle("q_transactions_enriched", """
    select transaction_id, t.project_id, vendor_id, vendor_name, category, cast(amount as double) as amount, currency,
      payment_status, approved_by, invoice_ref, notes, cast(day as varchar) as transaction_date, project_name,
      p.department, e.full_name as approver_name, approved_by is not null as is_approved,
      coalesce(cast(amount as double), 0) as amount_aed, strftime(day, '%Y-%m') as transaction_year_month
    from dated t left join projects_clean p on p.project_id = t.project_id
      left join employees_clean e on e.employee_id = t.approved_by""")
oracle("j_inner_equi", """
    select employee_id, cast(valid_from as varchar) as valid_from, full_name, email, department from versions""")
oracle("j_anti_not_exists", "select employee_id from versions_no_history")
oracle("j_point_in_time", """
    select transaction_id, approved_by, version_id as employee_version from dated t
    left join versions v on v.employee_id = t.approved_by and t.day >= v.valid_from and t.day < v.valid_to""")
oracle("j_star", """
    select transaction_id, p.project_id as project_key, d.vendor_id as vendor_key, version_id as employee_key,
      cast(strftime(day, '%Y%m%d') as bigint) as date_key
    from dated t left join projects_clean p on p.project_id = t.project_id
      left join dim_vendor d on d.vendor_id = t.vendor_id
      left join versions v on v.employee_id = t.approved_by and t.day >= v.valid_from and t.day < v.valid_to""")

OVERLAP = """
    select a.employee_id, a.version_id as version_a, cast(a.valid_from as varchar) as a_valid_from,
      cast(a.valid_to as varchar) as a_valid_to, b.version_id as version_b,
      cast(b.valid_from as varchar) as b_valid_from, cast(b.valid_to as varchar) as b_valid_to
    from {0} a join {0} b on a.employee_id = b.employee_id and a.version_id < b.version_id
      and a.valid_from < b.valid_to and b.valid_from < a.valid_to"""
LONGER = """(select employee_id, version_id, valid_from,
      case when is_current then valid_to else valid_to + 30 end as valid_to from versions)"""
oracle("j_overlap", OVERLAP.format(LONGER))
oracle("j_adjacent", """
    select c.employee_id, cast(c.valid_from as varchar) as change_date, p.salary as previous_salary,
      c.salary as new_salary
    from versions c join versions p on p.employee_id = c.employee_id and p.valid_to = c.valid_from""")
oracle("j_fifo_pair", f"""
    select event_id, project_id, resolved_by, {_time('resolved_at')} as resolved_at from escalations where resolved""")
oracle("j_cross_scalar", """
    select transaction_id, cast(amount as double) as amount from transactions
    cross join (select avg(amount) as average from transactions where payment_status = 'Pending')
    where payment_status = 'Pending' and amount > average""")

SLOW_FROM = """
    from projects_clean p join transactions t on t.project_id = p.project_id
      join employees_clean e on e.employee_id = p.project_manager_id
    where p.status not in ('Completed', 'On Hold') and t.payment_status = 'Pending'
      and t.amount > (select avg(amount) from transactions where payment_status = 'Pending')"""
SLOW = f"""
    select e.full_name, e.department, e.role, p.project_name, p.status, cast(p.budget as double) as budget,
      cast(p.actual_cost as double) as actual_cost, cast(t.amount as double) as amount, t.category, t.payment_status,
      t.transaction_date {SLOW_FROM}"""
oracle("j_comma", f"""
    select e.department, p.status, count(*) as transactions, cast(sum(amount) as double) as amount {SLOW_FROM}
    group by e.department, p.status""")

MANAGERS = """select v.{0} as employee_key, p.{1} as project_key, 'Manager' as project_role
    from {2} p join {3} v on v.employee_id = p.project_manager_id and v.is_current"""
APPROVERS = """select distinct v.{0} as employee_key, p.{1} as project_key, 'Approver' as project_role
    from transactions t join {2} p on p.project_id = t.project_id
      join {3} v on v.employee_id = t.approved_by and v.is_current"""
NATURAL = ("employee_id", "project_id", "projects_clean", "versions")
KEYED = ("employee_key", "project_key", "dim_project", "dim_employee")
oracle("j_bridge_manager", MANAGERS.format(*NATURAL))
oracle("j_bridge_approver", APPROVERS.format(*NATURAL))
oracle("j_lookup_map", """
    select status, status_category, count(*) as projects from projects_clean group by status, status_category""")
oracle("j_fk_orphans", """
    select 'manager_id' as target, cast(count(*) as double) as metric from employees
    where manager_id is not null and manager_id <> 'EMP0000'
      and manager_id not in (select employee_id from employees)""")

# aggregations
oracle("q_project_activity", f"""
    select project_id, count(*) as total_events,
      count(*) filter (where event_type = 'escalation_raised') as escalation_count,
      count(*) filter (where event_type = 'task_completed') as task_completions,
      count(*) filter (where event_type = 'document_uploaded') as document_uploads,
      {_time('max(ts)')} as last_event_timestamp, count(distinct user_id) as unique_users,
      count(distinct event_type) as unique_event_types
    from good_events where project_id is not null group by project_id""")
oracle("q_user_activity", f"""
    select user_id, count(*) filter (where event_type = 'login') as login_count,
      count(*) filter (where event_type = 'logout') as logout_count,
      count(*) filter (where event_type not in ('login', 'logout')) as actions_taken,
      count(distinct project_id) as projects_touched, {_time('min(ts)')} as first_active,
      {_time('max(ts)')} as last_active, count(distinct cast(ts as date)) as active_days
    from good_events group by user_id""")
oracle("q_daily_volume", f"{DAILY} from {DAILY_FROM}")
oracle("q_peak_usage", """
    select cast(event_date as varchar) as event_date, event_hour, total_events, unique_users, event_types_per_hour
    from (select cast(ts as date) as event_date, hour(ts) as event_hour, count(*) as total_events,
        count(distinct user_id) as unique_users, count(distinct event_type) as event_types_per_hour
      from good_events group by 1, 2 order by total_events desc, event_date, event_hour limit 20)""")

VENDOR_SPEND = """(select vendor_name, sum(amount) as total_spend, count(*) as transaction_count,
      100 * cast(sum(amount) as double) / cast(sum(sum(amount)) over () as double) as share
      from transactions group by vendor_name)"""
oracle("a_vendor_spend", f"""
    select vendor_name, cast(total_spend as double) as total_spend, transaction_count,
      round(share, 6) as percentage_of_total_spend from {VENDOR_SPEND}""")
MONTHLY = """(select strftime(day, '%Y-%m') as year_month, category, sum(amount) as spend from dated group by 1, 2)"""
oracle("a_monthly_spend", f"select year_month, category, cast(spend as double) as monthly_spend from {MONTHLY}")
oracle("a_scalar_avg", """
    select round(cast(avg(amount) as double), 4) as avg_pending_amount from transactions
    where payment_status = 'Pending'""")
oracle("a_level_quantiles", """
    select level, median, round(iqr, 4) as iqr, round(lower_bound, 4) as lower_bound,
      round(upper_bound, 4) as upper_bound from bands""")
oracle("a_global_median", "select cast(cast(day as date) as varchar) as median_hire_date from median_date")
oracle("a_null_counts", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_rows from employees"
    for c in td.EMPLOYEE_COLUMNS
))
oracle("a_top_share", " union all ".join(
    f"""select '{c}' as column_name, arg_max(v, n) as top_value, round(max(n) / cast(sum(n) as double), 6) as top_share,
      count(*) as distinct_values from (select {c} as v, count(*) as n from projects group by 1 order by n desc, v)"""
    for c in ("status", "department", "priority", "region")
))
oracle("a_zscore", """
    select transaction_id, cast(amount as double) as amount from transactions,
      (select avg(cast(amount as double)) as mean, stddev_samp(cast(amount as double)) as dev from transactions)
    where abs(cast(amount as double) - mean) / dev > 1.5""")
TYPE_COUNTS = "select coalesce(event_type, 'unknown') as event_type, count(*) as event_count from platform_events group by 1"
oracle("a_event_type_counts", TYPE_COUNTS)
oracle("a_conditional_sum", """
    select project_id, cast(sum(case when event_type = 'escalation_raised' then 1 else 0 end) as bigint)
      as escalation_count from platform_events group by project_id""")
oracle("a_distinct_conditional", """
    select user_id, count(distinct project_id) as projects_touched from platform_events group by user_id""")

# windows and set operations
oracle("w_surrogate_key", "select row_number() over (order by transaction_id) as transaction_key, transaction_id from transactions")
oracle("w_fifo_seq", "select event_id, event_type, project_id, seq from steps")
oracle("w_lead_valid_to", """
    select employee_id, cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to, is_current
    from versions_history""")
CHANGE = """round(100 * (cast(spend as double) - cast(lag(spend) over w as double))
      / nullif(cast(lag(spend) over w as double), 0), 2)"""
TREND = """select year_month, category, cast(spend as double) as monthly_spend,
      cast(sum(spend) over (partition by category order by year_month
        rows between unbounded preceding and current row) as double) as running_total, {change}
      as month_over_month_pct_change from {source} window w as (partition by category order by year_month)"""
oracle("q5_monthly_trend", TREND.format(change=CHANGE, source=MONTHLY))
oracle("w_lag_mom", f"""
    select category, year_month, {CHANGE} as month_over_month_pct_change from {MONTHLY}
    window w as (partition by category order by year_month)""")
oracle("w_running_total", f"""
    select category, year_month, cast(sum(spend) over (partition by category order by year_month
      rows between unbounded preceding and current row) as double) as running_total from {MONTHLY}""")
oracle("q_trend_12m", TREND.format(change=CHANGE, source=f"""(select * from {MONTHLY}
    where year_month >= strftime((select max(day) from dated) - interval 11 month, '%Y-%m'))"""))
oracle("u_union_all", """
    select employee_id, role, level, cast(salary as double) as salary, change_reason,
      cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to from versions_history
    union all select employee_id, role, level, salary, change_reason, cast(valid_from as varchar),
      cast(valid_to as varchar) from versions_no_history""")
oracle("u_distinct", "select distinct vendor_id, vendor_name from transactions")
oracle("u_replicate", """
    select payment_status, 'R' || cast(i as varchar) as copy, count(*) as transactions,
      cast(sum(amount) as double) as amount
    from transactions, (select unnest([0, 1, 2]) as i) group by 1, 2""")

# streaming
oracle("st_type_counts", TYPE_COUNTS)
oracle("st_forward_critical", """
    select project_id, event_id, severity from platform_events
    where event_type = 'escalation_raised' and severity = 'Critical'""")
oracle("st_summary", f"""
    select 'total_messages_consumed' as metric, count(*) as value from platform_events
    union all select 'critical_escalations_forwarded', count(*) from platform_events
      where event_type = 'escalation_raised' and severity = 'Critical'
    union all select 'messages_of_all_runs', count(*) from platform_events
    union all select 'event_counts.' || event_type, event_count from ({TYPE_COUNTS})""")
_NUMBERED = "(select *, cast(substr(event_id, 4) as bigint) as number from platform_events)"
oracle("st_stamp", f"""
    select event_type as key, event_id, event_type, project_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp,
      number / 4 as amount, number as first_step, true as null_step, true as null_member, true as stamped
    from {_NUMBERED} where number % 50 <> 7""")
_LATE = f"{_NUMBERED} where number % 2 = 1"
oracle("snk_stream_summary", f"""
    select 'total_messages_consumed' as metric, count(*) as value from {_LATE}
    union all select 'critical_escalations_forwarded', count(*) from {_LATE}
      and event_type = 'escalation_raised' and severity = 'Critical'
    union all select 'messages_of_all_runs', count(*) from platform_events
    union all select 'event_counts.' || event_type, count(*) from {_LATE} group by event_type""")
oracle("st_malformed", f"select event_id, 'not JSON' as reason from {_NUMBERED} where number % 50 = 7")
oracle("st_bounded_run", """
    select count(*) as events_read, count(distinct event_id) as event_ids from platform_events""")
oracle("st_dedup_first", "select event_id, user_id, event_type from good_events")
oracle("st_daily_volume", """
    select cast(cast(ts as date) as varchar) as event_date, event_type, count(*) as event_count
    from platform_events group by 1, 2""")

# data quality
TEXT_TABLES = {"projects": td.PROJECT_COLUMNS, "employees": td.EMPLOYEE_COLUMNS, "transactions": td.TRANSACTION_COLUMNS}
THRESHOLDS = {"projects": 0.90, "employees": 0.85, "transactions": 0.80}
PK = {"projects": "project_id", "employees": "employee_id", "transactions": "transaction_id"}


def _status(failed: str) -> str:
    return f"case when {failed} then 'FAIL' else 'PASS' end"


def _rows(parts: list[tuple[str, str, str, str, str]]) -> str:
    """(dataset, target, metric expression, failure test, detail expression) as check rows."""
    return " union all ".join(
        f"""select '{dataset}' as dataset, '{target}' as target, {_status(failed)} as status,
          cast(m as double) as metric, case when {failed} then {detail} end as detail
        from (select {metric} from {dataset})"""
        for dataset, target, metric, failed, detail in parts
    )


COMPLETENESS = " union all ".join(
    f"""select '{table}' as dataset, '{c}' as target, {_status(f'm < {THRESHOLDS[table]}')} as status,
      round(m, 4) as metric
    from (select avg(case when trim(coalesce(cast({c} as varchar), '')) = '' then 0.0 else 1.0 end) as m from {table})"""
    for table, columns in TEXT_TABLES.items()
    for c in columns
)
UNIQUENESS = " union all ".join(
    f"""select '{table}' as dataset, '{key}' as target, {_status('u < n')} as status, cast(u as double) as metric,
      '{key}: ' || u || ' unique / ' || n || ' total' as detail
    from (select count(distinct {key}) as u, count(*) as n from {table})"""
    for table, key in PK.items()
)
RANGES = [
    ("projects", "budget", 0, 10000000), ("projects", "actual_cost", 0, 10000000),
    ("employees", "salary", 10000, 100000), ("employees", "years_experience", 0, 50),
    ("transactions", "amount", 0, 5000000),
]
VALIDITY_NUMERIC = _rows([
    (
        table, c,
        f"count(*) filter (where {c} < {low}) as lo, count(*) filter (where {c} > {high}) as hi, lo + hi as m",
        "m > 0",
        f"""'{c}: ' || concat_ws(', ',
          case when lo > 0 then lo || ' value(s) below minimum ({low})' end,
          case when hi > 0 then hi || ' value(s) above maximum ({high})' end)""",
    )
    for table, c, low, high in RANGES
])
DAY = "case when length(trim({0})) = 10 then try_cast({0} as date) end"
VALIDITY_DATE = _rows([
    (
        table, c,
        f"count(*) filter (where trim({c}) <> '' and {DAY.format(c)} is null) as u, "
        f"count(*) filter (where {DAY.format(c)} > {AS_OF}) as f, u + f as m",
        "m > 0",
        f"'{c}: ' || u || ' unparsable, ' || f || ' in the future'",
    )
    for table, c in [
        ("projects", "start_date"), ("projects", "end_date"), ("employees", "hire_date"),
        ("transactions", "transaction_date"),
    ]
])
BEFORE = _rows([(
    "projects", "start_date<end_date", "count(*) filter (where cast(start_date as date) > cast(end_date as date)) as m",
    "m > 0", "'start_date > end_date in ' || m || ' row(s)'",
)])
NON_NEGATIVE = _rows([
    (table, c, f"count(*) filter (where {c} < 0) as m", "m > 0", f"'{c}: ' || m || ' negative value(s)'")
    for table, c in [("projects", "actual_cost"), ("employees", "years_experience"), ("transactions", "amount")]
])
SALARY_LEVEL = _rows([(
    "employees", "salary~level",
    """count(*) filter (where (level = 'Junior' and salary not between 10000 and 20000)
      or (level = 'Mid' and salary not between 15000 and 25000)
      or (level = 'Senior' and salary not between 23000 and 37000)
      or (level = 'Lead' and salary not between 36000 and 52000)
      or (level = 'Director' and salary not between 48000 and 72000)) as m""",
    "m > 0", "m || ' employee(s) with salary outside their level''s band'",
)])
REFERENTIAL = _rows([
    (
        table, c,
        f"count(*) filter (where {c} is not null and {c} <> 'EMP0000' "
        f"and {c} not in (select {key} from {target})) as m",
        "m > 0", f"'{c}: ' || m || ' value(s) not found in {target}.{key}'",
    )
    for table, c, target, key in [
        ("projects", "project_manager_id", "employees", "employee_id"),
        ("employees", "manager_id", "employees", "employee_id"),
        ("transactions", "project_id", "projects", "project_id"),
        ("transactions", "approved_by", "employees", "employee_id"),
    ]
])
DISTRIBUTION = " union all ".join(
    f"""select '{table}' as dataset, '{c}' as target, {_status('share > 0.30')} as status, round(share, 4) as metric,
      case when share > 0.30 then
        '{c}: ''' || v || ''' is ' || format('{{:.0f}}', share * 100) || '% of non-null values (> 30%)' end as detail
    from (select {c} as v, count(*) / cast(sum(count(*)) over () as double) as share from {table}
      where {c} is not null group by {c} order by share desc, v limit 1)"""
    for table, columns in {
        "projects": ["status", "department", "priority", "region"],
        "employees": ["department", "role", "level", "region", "status"],
        "transactions": ["category", "currency", "payment_status"],
    }.items()
    for c in columns
)
FRESHNESS = f"""select 'transactions' as dataset, 'transaction_date' as target, {_status('m > 30')} as status,
    cast(m as double) as metric, 'most recent transaction_date is ' || m || ' day(s) old (threshold 30)' as detail
  from (select date_diff('day', max(cast(transaction_date as date)), {AS_OF}) as m from transactions)"""
OUTLIERS = """select 'transactions' as dataset, 'amount' as target,
    case when m > 0 then 'FAIL' else 'PASS' end as status, cast(m as double) as metric,
    case when m > 0 then 'amount: ' || m || ' value(s) beyond 3.0 std dev from the mean' end as detail
  from (select count(*) as m from transactions, (select avg(cast(amount as double)) as mean,
    stddev_samp(cast(amount as double)) as dev from transactions)
    where abs(cast(amount as double) - mean) / dev > 3)"""
_BEYOND = """select 'transactions' as dataset, 'amount' as target,
    case when m > 0 then 'FAIL' else 'PASS' end as status, cast(m as double) as metric,
    case when m > 0 then 'amount: ' || m || ' value(s) beyond {0}' end as detail
  from (select count(*) as m from (select cast(amount as double) as v from transactions), ({1}) where {2})"""
_QUARTILES = """select quantile_cont(cast(amount as double), 0.25) as q1, quantile_cont(cast(amount as double), 0.75) as q3
    from transactions"""
oracle("dq_outliers_iqr", _BEYOND.format(
    "1.5 quartile distances", _QUARTILES, "v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)"))
_LOGARITHMS = """select avg(ln(v)) as mean, stddev_samp(ln(v)) as dev
    from (select cast(amount as double) as v from transactions where amount > 0)"""
oracle("dq_outliers_log", _BEYOND.format(
    "3.0 std dev from the mean of logarithms", _LOGARITHMS, "case when v > 0 then abs(ln(v) - mean) / dev > 3 end"))
_EVEN = "greatest(0.30, 2 / cast(n as double))"
oracle("dq_distribution_relative", DISTRIBUTION.replace("share > 0.30", f"share > {_EVEN}").replace(
    "'% of non-null values (> 30%)'", f"'% of non-null values (> ' || format('{{:.0f}}', 100 * {_EVEN}) || '%)'").replace(
    " as double) as share", " as double) as share, count(*) over () as n"))
CONSISTENCY = f"{BEFORE} union all {NON_NEGATIVE} union all {SALARY_LEVEL}"
CHECKS = {
    "completeness": f"select dataset, target, status from ({COMPLETENESS})",
    "uniqueness": UNIQUENESS,
    "validity_numeric": VALIDITY_NUMERIC,
    "validity_date": VALIDITY_DATE,
    "consistency": CONSISTENCY,
    "referential_integrity": REFERENTIAL,
    "distribution": DISTRIBUTION,
    "freshness": FRESHNESS,
    "outliers": OUTLIERS,
}
for name, body in {
    "dq_completeness": COMPLETENESS,
    "dq_uniqueness": UNIQUENESS,
    "dq_validity_numeric": VALIDITY_NUMERIC,
    "dq_validity_date": VALIDITY_DATE,
    "dq_consistency": CONSISTENCY,
    "dq_consistency_before": BEFORE,
    "dq_consistency_non_negative": NON_NEGATIVE,
    "dq_consistency_salary_level": SALARY_LEVEL,
    "dq_referential": REFERENTIAL,
    "dq_distribution": DISTRIBUTION,
    "dq_freshness": FRESHNESS,
    "dq_outliers": OUTLIERS,
}.items():
    oracle(name, body)

# position of a failed target in its configuration, for the listing order
TARGET_ORDER = {t: i for columns in TEXT_TABLES.values() for i, t in enumerate(columns)}
CONFIG_ORDER = {
    "consistency": ["start_date<end_date", "actual_cost", "years_experience", "salary~level", "amount"],
    "distribution": ["status", "department", "priority", "role", "level", "region", "category", "currency",
                     "payment_status"],
}
EMPLOYEE_DISTRIBUTION = ["department", "role", "level", "region", "status"]
ALL_CHECKS = " union all ".join(
    f"select dataset, '{check}' as check_name, target, status from ({body})" for check, body in CHECKS.items()
)


def _position(targets: list[str]) -> str:
    return "case target " + " ".join(f"when '{t}' then {i}" for i, t in enumerate(targets)) + " end"


LISTING = f"""case when check_name = 'consistency' then {_position(CONFIG_ORDER['consistency'])}
  when check_name = 'distribution' and dataset = 'employees' then {_position(EMPLOYEE_DISTRIBUTION)}
  when check_name = 'distribution' then {_position(CONFIG_ORDER['distribution'])}
  else {_position(list(dict.fromkeys(TARGET_ORDER)))} end"""
oracle("dq_run", f"""
    select dataset, check_name, case when n > 0 then 'FAIL' else 'PASS' end as status, failed_columns
    from (select dataset, check_name, count(*) filter (where status = 'FAIL') as n,
        coalesce(string_agg(case when status = 'FAIL' then target end, ', ' order by {LISTING}), '') as failed_columns
      from ({ALL_CHECKS}) c group by dataset, check_name)""")
SUMMARY = f"""select dataset, count(*) as checks_run, count(*) filter (where n = 0) as checks_passed,
    count(*) filter (where n > 0) as checks_failed
  from (select dataset, check_name, count(*) filter (where status = 'FAIL') as n from ({ALL_CHECKS}) c
    group by dataset, check_name) group by dataset"""
oracle("dq_summary", SUMMARY)
oracle("dq_gate", f"""
    select dataset, target as key_column, metric as completeness, metric < 0.8 as blocked from ({COMPLETENESS})
    where (dataset, target) in (('projects', 'project_id'), ('employees', 'employee_id'),
      ('transactions', 'transaction_id'))""")
oracle("r_run_report", " union all ".join(
    f"""select '{t}' as dataset, '{m}' as metric, cast(count(*) as varchar) as value from {source}"""
    for t in TEXT_TABLES
    for m, source in (
        ("raw_rows", t), ("clean_rows", {"transactions": "transactions"}.get(t, f"{t}_clean")),
    )
) + "".join(
    f" union all select dataset, '{m}', cast({m} as varchar) from ({SUMMARY})" for m in ("checks_passed", "checks_failed")
))

# warehouse
PROJECT_DIM = """project_id, project_name, department, status, status_category, priority, region, project_manager_id,
      cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date,
      cast(budget as double) as budget, cast(actual_cost as double) as actual_cost, risk_level"""
oracle("q_dim_project", f"select project_key, {PROJECT_DIM} from dim_project")
oracle("q_dim_vendor", "select vendor_key, vendor_id, vendor_name from dim_vendor")
VERSION_OUT = """employee_id, cast(salary as double) as salary, role, level, change_reason,
      cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to, is_current"""
oracle("q_scd2_history", f"select {VERSION_OUT} from versions_history")
oracle("q_scd2_no_history", f"select {VERSION_OUT} from versions_no_history")
oracle("q_dim_employee", """
    select employee_key, employee_id, full_name, email, department, role, level, salary, manager_id, region, status,
      change_reason, cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to, is_current
    from dim_employee""")
oracle("q_bridge", f"{MANAGERS.format(*KEYED)} union all {APPROVERS.format(*KEYED)}")
oracle("q_fact", """
    select transaction_key, transaction_id, project_key, employee_key, vendor_key, date_key,
      cast(amount as double) as amount, currency, category, payment_status, invoice_ref from fact""")
oracle("q_val_one_current", """
    select employee_id, count(*) as current_count from versions where is_current group by employee_id
    having count(*) > 1""")
oracle("q_val_version_counts", """
    select employee_id, count(*) as version_count from versions group by employee_id
    order by version_count desc, employee_id limit 10""")
oracle("q_val_overlap", OVERLAP.format("versions"))


def _unique(table: str, columns: str, source: str) -> str:
    return f"""select '{table}' as table_name, 'unique({columns})' as constraint_name,
      cast(coalesce(sum(n - 1), 0) as bigint) as violations from (select count(*) as n from {source} group by {columns})"""


def _not_null(table: str, column: str, source: str) -> str:
    return f"""select '{table}' as table_name, 'not null({column})' as constraint_name,
      count(*) filter (where {column} is null) as violations from {source}"""


def _references(table: str, column: str, target: str, source: str, other: str) -> str:
    return f"""select '{table}' as table_name, '{column} references {target}' as constraint_name,
      count(*) as violations from {source} where {column} is not null
      and {column} not in (select {column} from {other})"""


DIM_DATE = ORACLE["gen_dim_date"][len(PREFIX):]
BRIDGE = f"({MANAGERS.format(*KEYED)} union all {APPROVERS.format(*KEYED)})"
SOURCES = {
    "dim_date": f"({DIM_DATE})", "dim_project": "dim_project", "dim_employee": "dim_employee",
    "dim_vendor": "dim_vendor", "bridge_employee_project": BRIDGE, "fact_transactions": "fact",
}
CONSTRAINT_PARTS = [
    _unique(t, c, SOURCES[t])
    for t, c in [
        ("dim_date", "date_key"), ("dim_date", "full_date"), ("dim_project", "project_key"),
        ("dim_project", "project_id"), ("dim_employee", "employee_key"), ("dim_vendor", "vendor_key"),
        ("dim_vendor", "vendor_id"), ("bridge_employee_project", "employee_key, project_key, project_role"),
        ("fact_transactions", "transaction_key"), ("fact_transactions", "transaction_id"),
    ]
] + [
    _not_null(t, c, SOURCES[t])
    for t, columns in {
        "dim_date": "date_key full_date year quarter month month_name week day day_of_week is_weekend",
        "dim_project": "project_key project_id",
        "dim_employee": "employee_key employee_id valid_from valid_to is_current",
        "dim_vendor": "vendor_key vendor_id",
        "bridge_employee_project": "employee_key project_key project_role",
        "fact_transactions": "transaction_key transaction_id",
    }.items()
    for c in columns.split()
] + [
    _references(t, c, target, SOURCES[t], SOURCES[target])
    for t, c, target in [
        ("bridge_employee_project", "employee_key", "dim_employee"),
        ("bridge_employee_project", "project_key", "dim_project"),
        ("fact_transactions", "project_key", "dim_project"), ("fact_transactions", "employee_key", "dim_employee"),
        ("fact_transactions", "vendor_key", "dim_vendor"), ("fact_transactions", "date_key", "dim_date"),
    ]
]
oracle("w9_constraints", " union all ".join(CONSTRAINT_PARTS))
oracle("w9_published", " union all ".join(f"select '{t}' as table_name, count(*) as table_rows from {SOURCES[t]}" for t in SOURCES))

# business questions and marts
DEPT = """select department, cast(sum(budget) as double) as total_budget,
      cast(sum(actual_cost) as double) as total_actual_cost,
      round(100 * cast(sum(actual_cost) as double) / nullif(cast(sum(budget) as double), 0), 2) as spend_percentage,
      sum(actual_cost) > sum(budget) as over_budget
    from projects_clean group by department"""
oracle("q1_dept_budget", f"{DEPT} having cast(sum(actual_cost) as double) / nullif(cast(sum(budget) as double), 0) > 0.90")
oracle("m_dept_bar", DEPT)
WORKLOAD = """select full_name, email, count(*) as active_project_count,
      cast(sum(budget) as double) as combined_budget_responsibility,
      cast(sum(actual_cost) as double) as combined_actual_spend
    from projects_clean p join versions v on v.employee_id = p.project_manager_id and v.is_current
    where p.status in ({0}) group by full_name, email having count(*) > {1}"""
oracle("q2_manager_workload", WORKLOAD.format("'In Progress', 'On Hold'", 3))
oracle("q_manager_load_gt1", WORKLOAD.format("'In Progress'", 1))
CONCENTRATION = """select vendor_name, cast(total_spend as double) as total_spend, transaction_count,
      round(share, 2) as percentage_of_total_spend,
      case when share > 10 then 'HIGH' when share >= 5 then 'MEDIUM' else 'NORMAL' end as risk_flag
    from {0} where share > {1}"""
oracle("q3_vendor_concentration", CONCENTRATION.format(VENDOR_SPEND, 5))
oracle("q_vendor_gt30", CONCENTRATION.format(VENDOR_SPEND, 30))
oracle("q4_open_issues", """
    select p.project_id, project_name, department, status as project_status, count(*) as open_transaction_count,
      cast(sum(amount) as double) as open_transaction_value
    from transactions t join projects_clean p on p.project_id = t.project_id
    where payment_status in ('Pending', 'Disputed')
    group by p.project_id, project_name, department, status having sum(amount) > 50000""")
oracle("q6_comp_increase", """
    select c.employee_id, c.full_name, cast(c.valid_from as varchar) as change_date, p.salary as previous_salary,
      c.salary as new_salary, round(c.salary - p.salary, 2) as increase_amount,
      round(100 * (c.salary - p.salary) / nullif(p.salary, 0), 2) as increase_pct
    from versions c join versions p on p.employee_id = c.employee_id and p.valid_to = c.valid_from
    where c.salary > p.salary order by increase_amount desc, c.employee_id, change_date limit 20""")
oracle("q_slow_original", SLOW)
oracle("q_slow_rewritten", SLOW)
oracle("q_issue_rate", """
    select project_id, project_name, status, had_issue,
      round(100 * cast(count(*) filter (where had_issue) over () as double) / count(*) over (), 2) as issue_rate_pct
    from (select project_id, project_name, status,
        project_id in (select project_id from platform_events where event_type = 'escalation_raised'
            and project_id is not null
          union select project_id from transactions where payment_status = 'Disputed') as had_issue
      from projects_clean)""")
oracle("q_escalation_log", f"""
    select event_id, project_id, raised_by, {_time('raised_at')} as raised_at, severity, resolved, resolved_by,
      {_time('resolved_at')} as resolved_at, round(resolution_time_hours, 6) as resolution_time_hours
    from escalations""")
oracle("q_escalation_log_causal", f"""
    select a.event_id, a.project_id, a.user_id as raised_by, {_time('a.ts')} as raised_at, a.severity,
      b.ts is not null as resolved, b.resolved_by, {_time('b.ts')} as resolved_at,
      round(date_diff('second', a.ts, b.ts) / cast(3600 as double), 6) as resolution_time_hours
    from (select * from queue where resolves = 0) a
      left join (select * from queue where resolves = 1 and balance >= least(0, coalesce(lowest, 0))) b
        on b.project_id = a.project_id and b.opened - b.balance + least(0, coalesce(b.lowest, 0)) = a.opened""")
KPI = """select cast(sum(budget) as double) as total_budget, cast(sum(actual_cost) as double) as total_actual_cost,
      round(100 * cast(count(*) filter (where actual_cost > budget) as double) / count(*), 2)
        as over_budget_projects_pct,
      any_value(f.transaction_count) as transaction_count,
      cast(any_value(f.transaction_amount) as double) as transaction_amount
    from {0} p cross join (select count(*) as transaction_count, sum(amount) as transaction_amount from {1}) f"""
oracle("m_kpi_cards", KPI.format("projects_clean", "transactions"))
oracle("m_slicers", KPI.format(
    "(select * from projects_clean where region in ('ASIA', 'EUROPE') and status = 'In Progress')",
    """(select d.* from dated d join projects_clean q on q.project_id = d.project_id
      where q.region in ('ASIA', 'EUROPE') and q.status = 'In Progress' and year(d.day) in (1997, 1998))""",
))
oracle("m_top_variance", """
    select project_id, project_name, department, cast(budget as double) as budget,
      cast(actual_cost as double) as actual_cost, cast(variance as double) as budget_variance
    from (select *, budget_variance as variance from projects_clean where budget_variance is not null
      order by variance desc, project_id limit 10)""")
oracle("m_vendor_donut", f"""
    select case when n <= 5 then vendor_name else 'Other' end as vendor_slice,
      cast(sum(total_spend) as double) as total_spend
    from (select *, row_number() over (order by total_spend desc, vendor_name) as n from {VENDOR_SPEND}) group by 1""")

# governance
SENSITIVE = {
    "projects_clean": {c: "Confidential" for c in (
        "budget", "actual_cost", "budget_variance", "budget_utilisation_pct", "is_over_budget")},
    "employees": {
        "full_name": "Personal (PII)", "email": "Personal (PII)", "hire_date": "Personal (PII)",
        "salary": "Personal (PII) + Confidential",
    },
    "transactions": {c: "Confidential" for c in ("vendor_id", "vendor_name", "amount", "notes")},
    "history": {
        "previous_salary": "Personal (PII) + Confidential", "new_salary": "Personal (PII) + Confidential",
        "change_reason": "Confidential",
    },
}
CLEAN_PROJECT_NAMES = [*td.PROJECT_COLUMNS, "budget_variance", "is_over_budget", "duration_days", "status_category",
                       "budget_utilisation_pct", "risk_level"]
CLASSIFIED = {
    "projects_clean": ("projects", CLEAN_PROJECT_NAMES),
    "employees": ("employees", list(td.EMPLOYEE_COLUMNS)),
    "transactions": ("transactions", list(td.TRANSACTION_COLUMNS)),
    "history": ("employees_salary_history", list(td.HISTORY_COLUMNS)),
}


def _classified(source: str, column: str) -> str:
    kind = SENSITIVE[source].get(column, "Internal")
    law = "'GDPR + UAE PDPL'" if "PII" in kind else "null"
    return f"""select '{CLASSIFIED[source][0]}' as dataset, '{column}' as column_name, '{kind}' as classification,
      {law} as regulation, count({column}) as filled_rows from {source}"""


oracle("g_classification", " union all ".join(
    _classified(source, column) for source, (_, columns) in CLASSIFIED.items() for column in columns
))
def _keyed(column: str) -> str:
    """HMAC-SHA-256 under the fixed key of the query."""
    pads = ["".join(f"\\x{b ^ pad:02X}" for b in b"key of the checked query".ljust(64, b"\0")) for pad in (0x36, 0x5C)]
    return f"sha256('{pads[1]}'::blob || unhex(sha256('{pads[0]}'::blob || encode({column}))))"


oracle("g_mask_view", f"""
    select employee_id, {_keyed("full_name")} as full_name, {_keyed("email")} as email, cast(null as varchar) as hire_date,
      department, role, level, cast(null as double) as salary, manager_id, region, status,
      cast(years_experience as bigint) as years_experience from employees_clean""")
oracle("g_salary_aggregate", """
    select department, count(salary) as employees_paid, round(avg(salary), 2) as average_salary,
      cast(sum(cast(salary as decimal(18,4))) as double) as total_compensation
    from employees_clean group by department""")
ENDED = "(select *, case when status = 'Inactive' then cast(hire_date + interval 60 month as date) end as ended from employees_clean)"


def _retention(dataset: str, source: str, since: str, archive: int | None, dispose: int) -> str:
    middle = f"when {since} + interval {archive} year <= {AS_OF} then 'archive'" if archive else ""
    return f"""select '{dataset}' as dataset, case when {since} + interval {dispose} year <= {AS_OF} then 'dispose' {middle}
      else 'keep' end as retention_action, count(*) as records from {source} group by 2"""


oracle("g_retention", " union all ".join([
    _retention("projects", "(select case when status_category = 'Closed' then end_date end as d from projects_clean)", "d", 1, 7),
    _retention("employees", ENDED, "ended", None, 2),
    _retention("transactions", "dated", "day", 2, 5),
    _retention("employees_salary_history", f"(select e.ended from history h left join {ENDED} e on e.employee_id = h.employee_id)", "ended", 2, 7),
]))
oracle("g_anonymise", f"""
    select employee_id, case when not gone then full_name end as full_name, case when not gone then email end as email,
      department, level, salary, gone as anonymised
    from (select *, coalesce(ended + interval 2 year <= {AS_OF}, false) as gone from {ENDED})""")


def oracle_sql(aliases: dict[str, str]) -> dict[str, str]:
    """All check statements; an operator that shares a query shares its SQL."""
    shared = {name: ORACLE[target] for name, target in aliases.items() if target in ORACLE}
    return ORACLE | shared
