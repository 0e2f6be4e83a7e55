"""The adapters' rules in SQL, as named common table expressions."""

from __future__ import annotations

from checks.adapters import SCD_LOADS, TEST_ENTITIES, TEST_TOPICS
from tidewire.fixed_values import ENTITY_NAMES, SOURCE_SYSTEM, TOPIC_KEYWORDS


def half_up(part: str, whole: str, digits: int = 2, scale: int = 1) -> str:
    """scale * part / whole rounded half up in whole numbers; NULL for a zero whole."""
    steps = 10**digits
    size = f"cast((2 * {scale * steps} * abs({part}) + ({whole})) // nullif(2 * ({whole}), 0) as double) / {steps}"
    return f"(case when ({part}) < 0 then -({size}) else {size} end)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return half_up(part, whole, digits, 100)


def score_sql(keywords: list[str], match: str = "substring") -> str:
    points = []
    for keyword in keywords:
        if match == "token":
            points.append(f"2 * cast(list_contains(tokens, '{keyword}') as integer)")
        else:
            points.append(f"2 * cast(contains(lowered, '{keyword}') as integer)")
        points += [f"cast(list_contains(tokens, '{word}') as integer)" for word in dict.fromkeys(keyword.split())]
    return " + ".join(points)


def topic_sql(topics: dict[str, list[str]], match: str = "substring") -> str:
    scores = {name: f"({score_sql(words, match)})" for name, words in topics.items()}
    best = f"greatest({', '.join(scores.values())})"
    arms = " ".join(f"when {best} = {score} then '{name}'" for name, score in scores.items())
    return f"case when {best} = 0 then 'Other' {arms} end"


def entity_sql(entities: dict[str, list[str]]) -> str:
    names = [name for group in entities.values() for name in group]
    return "concat_ws(',', " + ", ".join(f"case when contains(lowered, '{n}') then '{n}' end" for n in names) + ")"


def customer_batches() -> str:
    arms = []
    for load, (until, now) in enumerate(SCD_LOADS, 1):
        arms.append(
            f"select {load} load, timestamp '{now}' now, date '{until}' ingest_date, o_custkey, o_orderkey, o_orderdate,"
            f" o_orderpriority from orders where o_orderdate < timestamp '{until}'"
            " qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"
        )
    return " union all ".join(arms)


VIEWS: dict[str, str] = {
    "ord": """
        select cast(o_orderkey as varchar) content_id, o_orderstatus content_type, 'Order ' || o_orderkey title,
               'https://shop.example.com/orders/' || o_orderkey url,
               case when o_orderkey % 4 <> 0 then 'https://img.example.com/' || o_orderkey end image_url,
               'N' || c_nationkey news_site, o_orderpriority || ' order of ' || c_name summary,
               o_orderdate published_at, c_mktsegment topic_name, o_orderpriority = '1-URGENT' featured,
               least(cast(o_orderdate as date) + cast(o_orderkey % 10 as integer), date '2001-08-01') ingest_date
        from orders left join customer on o_custkey = c_custkey""",
    "evt": """
        select cast(event_id as varchar) content_id, event_type content_type, 'u' || (user_id % 20) news_site,
               'k' || (cast(json_extract_string(props, '$.k') as integer) % 11) topic_name, ts published_at,
               value > 50 featured, cast(ts as date) ingest_date
        from events""",
    "doc_raw": """
        select cast(doc_id as varchar) id, doc_id, lang,
               case when doc_id % 41 = 0 then null when doc_id % 43 = 0 then ''
                    else 'Item ' || doc_id || ' from ' || source end title,
               case when doc_id % 37 = 0 then 'not-a-valid-url'
                    else 'https://' || source || '.example.com/' || doc_id end url,
               case when doc_id % 4 <> 0 then 'https://img.example.com/' || doc_id end image_url,
               source news_site, "text" summary,
               case when doc_id % 31 = 0 then null when doc_id % 29 = 0 then 'bad-date'
                    else strftime(timestamp '2024-01-01' + to_minutes((doc_id * 6367) % 259200), '%Y-%m-%dT%H:%M:%SZ')
               end published_text,
               case when doc_id % 6 <> 0
                    then strftime(timestamp '2024-01-01' + to_minutes((doc_id * 6367) % 259200)
                                  + to_days(cast(doc_id % 5 as integer)), '%Y-%m-%dT%H:%M:%SZ') end updated_text,
               doc_id % 7 = 0 featured,
               case when doc_id % 5 = 0 then '[]'
                    else '[{"name":"' || lang || '","socials":["' || source || '"]}]' end authors_json,
               case when doc_id % 4 = 0 then '[{"launch_id":"L' || doc_id || '","provider":"p","status":{"code":'
                    || (doc_id % 3) || '}}]' else '[]' end launches_json,
               case when doc_id % 9 = 0 then '[{"event_id":7,"kind":"x"},{"event_id":8}]' else '[]' end events_json,
               case doc_id % 3 when 0 then 'articles' when 1 then 'blogs' else 'reports' end content_type,
               date '2024-07-01' ingest_date
        from documents""",
    "doc_checked": """
        select *, case when title is null or title = '' then 'Missing required field: title'
                       when published_text is null then 'Missing required field: published_at'
                       when published_text = 'bad-date' then 'Invalid timestamp format for published_at' end reason
        from doc_raw""",
    "doc_silver": f"""
        select *, content_type || '_' || id content_id, '{SOURCE_SYSTEM}' source_system,
               strptime(published_text, '%Y-%m-%dT%H:%M:%SZ') published_at,
               strptime(updated_text, '%Y-%m-%dT%H:%M:%SZ') updated_at,
               sha256(id || '||' || title || '||' || url || '||'
                      || strftime(strptime(published_text, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S')
                      || '||' || coalesce(summary, 'NULL')) record_hash
        from doc_checked where reason is null""",
    "doc_words": r"""
        select *, lower(coalesce(title, '') || ' ' || coalesce(summary, '')) lowered,
               regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(summary, '')),
                                  '[\p{L}\p{N}_]{3,}') tokens
        from doc_silver""",
    "doc_gold": f"""
        select *, array_to_string(tokens, ',') keywords, {entity_sql(TEST_ENTITIES)} entities,
               {topic_sql(TEST_TOPICS)} topic_name
        from doc_words""",
    "doc_real": f"""
        select *, {entity_sql(ENTITY_NAMES)} entities, {topic_sql(TOPIC_KEYWORDS)} topic_name from doc_words""",
    "dup": """
        select l_orderkey || '-' || l_linenumber content_id, 'lineitem' content_type,
               cast(l_shipdate as date) ingest_date from lineitem""",
    "cust_loads": customer_batches(),
    "cust_changes": """
        select *, 'Order ' || o_orderkey title,
               sha256('Order ' || o_orderkey || '||' || o_orderpriority) record_hash
        from cust_loads
        qualify sha256('Order ' || o_orderkey || '||' || o_orderpriority)
                is distinct from lag(sha256('Order ' || o_orderkey || '||' || o_orderpriority))
                over (partition by o_custkey order by load)""",
    "cust": """
        select cast(o_custkey as varchar) content_id, 'customer' content_type, title, o_orderdate published_at,
               o_orderpriority topic_name, ingest_date, record_hash,
               cast(row_number() over (partition by o_custkey order by load) as integer) "version", now valid_from,
               coalesce(lead(now) over (partition by o_custkey order by load), timestamp '9999-12-31 23:59:59') valid_to,
               lead(now) over (partition by o_custkey order by load) is null is_current
        from cust_changes""",
    "ord_loads": """
        select *, date '1999-12-31' load_date from ord where ingest_date <= date '1999-12-31'
        union all select *, date '2001-08-01' load_date from ord""",
    "trends": """
        select strftime(published_at, '%Y-%m') year_month, topic_name, content_type, count(*) content_count,
               load_date ingest_date
        from ord_loads group by all""",
    "activity": """
        select strftime(published_at, '%Y-%m') year_month, news_site, content_type, count(*) content_count,
               load_date ingest_date
        from ord_loads group by all""",
    "runs": """
        select cast(o_orderdate as date) run_date, 'daily_load' pipeline_name,
               case when count(*) filter (o_orderstatus = 'P') * 3 >= count(*) then 'failed' else 'completed' end status,
               count(*) records_processed, count(*) filter (o_orderstatus = 'P') records_failed,
               count(*) filter (o_orderpriority = '1-URGENT') execution_time_seconds,
               case when count(*) filter (o_orderstatus = 'P') * 3 >= count(*) then 'too many pending orders'
               end error_message,
               cast(o_orderdate as date) + to_days(1) + to_minutes(count(*)) created_at
        from orders group by cast(o_orderdate as date)""",
    "chk": """
        select run_date check_date, 'pending_orders' check_name,
               case when status = 'failed' then 'failed' else 'PASS' end check_result,
               records_processed records_checked, records_failed, error_message error_details, created_at
        from runs""",
}

NEEDS = {
    "doc_checked": ["doc_raw"], "doc_silver": ["doc_checked"], "doc_words": ["doc_silver"],
    "doc_gold": ["doc_words"], "doc_real": ["doc_words"], "cust_changes": ["cust_loads"], "cust": ["cust_changes"],
    "ord_loads": ["ord"], "trends": ["ord_loads"], "activity": ["ord_loads"], "chk": ["runs"],
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and whatever they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    views = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in ordered)
    body = body.strip()
    if not views:
        return body
    if body.lower().startswith("with "):
        return f"with {views},\n{body[5:]}"
    return f"with {views}\n{body}"
