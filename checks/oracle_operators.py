"""SQL for the operator queries, over the views of ``oracle_views``."""

from __future__ import annotations

from checks.adapters import NAME_PARTS, TEST_ENTITIES, TEST_TOPICS
from checks.oracle_views import entity_sql, pct, score_sql, topic_sql, with_views

WORDS = r"'[\p{L}\p{N}_]{3,}'"
LONG_WORDS = r"'[\p{L}\p{N}_]{6,}'"
NOW = "timestamp '2024-07-01 12:00:00'"

# Raw lines: which fault a line has, in the order the rules look for them.
RAW_CHECKED = """
    raw_checked as (
        select id, content_type, case
            when doc_id % 61 = 0 then 'Malformed record'
            when doc_id % 53 = 0 then 'Missing required field: id'
            when title is null then 'Missing required field: title'
            when published_text is null then 'Missing required field: published_at'
            when published_text = 'bad-date' or published_text like '%T00:%'
                then 'Invalid timestamp format for field: published_at'
            when url = 'not-a-valid-url' then 'Invalid URL format for field: url'
            when doc_id % 47 = 0 then 'Invalid URL format for field: image_url'
            when doc_id % 59 = 0 and content_type <> 'reports' then 'Field should be array: launches' end reason
        from doc_raw)"""

SITES = """
    named as (select 'N' || c_nationkey || '-' || year(o_orderdate) site, least(cast(o_orderdate as date)
                     + cast(o_orderkey % 10 as integer), date '2001-08-01') d
              from orders left join customer on o_custkey = c_custkey where o_orderstatus <> 'P'),
    early as (select site, min(d) a, max(d) b, count(*) n from named where d <= date '1999-12-31' group by 1),
    late as (select site, min(d) a, max(d) b, count(*) n from named where d > date '1999-12-31' group by 1)"""

OFFICIAL = """
    official as (select source from documents group by 1
                 having count(*) filter (lang = 'en') * (select count(*) from documents)
                        >= count(*) * (select count(*) from documents where lang = 'en'))"""

DOC_WORDS = f"""
    docs as (select doc_id, lower("text") lowered, regexp_extract_all(lower("text"), {WORDS}) tokens from documents)"""

HISTORY = """
    select content_id || '|customer|' || "version" content_pk, content_id, content_type, title, topic_name,
           published_at, ingest_date, record_hash, "version", valid_from, valid_to, is_current from cust"""


def top_list(view: str, dimension: str, label: str) -> str:
    return f"""(select cast(to_json(list(struct_pack({label} := {dimension}, "count" := n) order by n desc, {dimension}))
                as varchar) from (select {dimension}, cast(sum(content_count) as bigint) n from {view}
                where ingest_date = date '2001-08-01' and {dimension} <> '' group by 1
                order by n desc, {dimension} limit 5))"""


OPERATORS: dict[str, str] = {
    "a01_bronze_read": with_views("doc_raw", """
        select id, content_type, title, url, image_url, news_site, published_text published_at,
               updated_text updated_at, featured, md5(summary) summary_md5, authors_json, launches_json, events_json, ingest_date
        from doc_raw"""),
    "a04_missing_type": with_views("doc_raw", """
        select content_type, count(*) records from doc_raw where content_type <> 'reports' group by 1"""),
    "a02_info_sites": "select distinct source news_site from documents",
    "a02_api_metadata": f"""
        select distinct lang api_version, cast(2 as bigint) news_sites_count,
               source || ',' || upper(source) news_sites_list, date '2024-07-01' ingest_date, {NOW} captured_at
        from documents""",
    "a03_parquet_partitions": with_views("ord", """
        select content_type, cast(year(ingest_date) as integer) load_year, count(*) content_count,
               min(published_at) earliest
        from ord where year(ingest_date) >= 1998 group by 1, 2"""),
    "a05_write_statistics": with_views("ord", """
        select count(*) records_read, count(*) filter (featured) featured_read, count(*) records_observed,
               count(*) filter (featured) featured_observed, 15 column_count from ord"""),
    "a09_staging_load": with_views("doc_gold", """
        select id, content_id, content_type, title, url, news_site, published_at, updated_at, featured, topic_name,
               entities, cast(year(published_at) as integer) published_year,
               cast(month(published_at) as integer) published_month, cast(day(published_at) as integer) published_day,
               authors_json, launches_json, events_json, image_url, ingest_date, 'check' ingest_run_id, record_hash,
               md5(summary) summary_md5, md5(keywords) keywords_md5 from doc_gold"""),
    "a10_aggregate_staging": with_views("trends", "select * from trends"),
    "a12_land_valid_lines": with_views("doc_raw", f"""
        with {RAW_CHECKED} select content_type endpoint, count(*) records from raw_checked
        where reason is null group by 1"""),
    "a13_extraction_metadata": with_views("doc_raw", f"""
        with {RAW_CHECKED} select content_type endpoint, 'run_' || content_type run_id,
               '2024-07-01T00:00:00' start_time, '2024-07-01T00:10:00' end_time,
               count(*) filter (reason is null) records_downloaded, count(*) filter (reason is null) valid_count,
               count(reason) invalid_count, cast(ceil(count(*) / 100) as bigint) total_pages, count(*) total_results,
               '2024-07-01' ingest_date from raw_checked group by content_type"""),
    "a14_list_extractions": with_views("doc_raw", f"""
        with {RAW_CHECKED} select content_type endpoint, count(*) filter (reason is null) records
        from raw_checked group by 1"""),
    "a15_check_extraction": with_views("doc_raw", """
        select content_type endpoint, count(*) records, 'OK' status from doc_raw group by 1
        union all select 'info', 0, 'No files found'"""),
    "a17_incremental": with_views("doc_raw", """
        select id, content_type, strptime(published_text, '%Y-%m-%dT%H:%M:%SZ') published_at,
               strptime(updated_text, '%Y-%m-%dT%H:%M:%SZ') updated_at
        from doc_raw where published_text <> 'bad-date'
        and try_strptime(published_text, '%Y-%m-%dT%H:%M:%SZ') >= timestamp '2024-03-01'
        and try_strptime(updated_text, '%Y-%m-%dT%H:%M:%SZ') >= timestamp '2024-04-15'"""),
    "b03_site_flags": with_views("doc_silver", f"""
        with {OFFICIAL} select news_site, news_site in (select source from official) news_site_validated,
               count(*) record_count from doc_silver group by 1, 2"""),
    "b04_silver_reasons": with_views("doc_checked", """
        select id, content_type, reason is null is_valid, reason from doc_checked"""),
    "b05_ingest_reasons": with_views("doc_raw", f"with {RAW_CHECKED} select id, reason from raw_checked"),
    "b06_batch_totals": with_views("doc_raw", f"""
        with {RAW_CHECKED} select content_type, count(*) total_records, count(*) filter (reason is null) valid_count,
               count(reason) invalid_count from raw_checked group by 1"""),
    "b08_timestamp_policies": """
        select event_id, case event_id % 10 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                   when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') when 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
                   when 3 then strftime(ts, '%Y-%m-%d') when 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
                   when 5 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 6 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
                   when 7 then strftime(ts, '%Y-02-30T00:00:00Z') when 8 then strftime(ts, '%H:%M') else '' end "text",
               case when event_id % 10 in (0, 5, 6) then date_trunc('second', ts) when event_id % 10 = 1 then ts
                    when event_id % 10 = 2 then date_trunc('millisecond', ts)
                    when event_id % 10 = 3 then date_trunc('day', ts)
                    when event_id % 10 = 4 then date_trunc('second', ts) - interval 2 hour end lenient,
               case when event_id % 10 in (0, 5, 6) then date_trunc('second', ts)
                    when event_id % 10 = 1 then ts end strict
        from events""",
    "b09_quarantine": with_views("doc_checked", f"""
        select id, content_type, false _is_valid, reason _error_reason, {NOW} quarantine_timestamp, url payload_url,
               case when doc_id % 4 = 0 then cast(doc_id % 3 as varchar) end payload_code
        from doc_checked where reason is not null"""),
    "b13_year_topics": with_views("ord", """
        select content_id id, strftime(published_at, '%Y') topic_name,
               cast(year(published_at) as integer) published_year, title
        from ord where featured order by id limit 10"""),
    "b16_normalized": r"""
        with heads as (select page_id, url, upper(url) u,
                              regexp_extract(upper(url), '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) head from pages)
        select page_id id, 'Page ' || page_id title, split_part(url, '/', 3) news_site, 'short' summary,
               lower(head) || substr(u, length(head) + 1) url from heads""",
    "b17_quality_flags": with_views("doc_raw", """
        with p as (select id, summary, cast(try_strptime(published_text, '%Y-%m-%dT%H:%M:%SZ') as date) d from doc_raw)
        select id, length(summary) > 500 title_too_long, length(summary) < 200 summary_too_short,
               coalesce(d > date '2024-05-01', false) future_date, coalesce(year(d) < 2000, false) very_old_date
        from p"""),
    "d01_topic_trends": with_views("doc_gold", """
        select strftime(published_at, '%Y-%m') year_month, topic_name, content_type, count(*) content_count, ingest_date
        from doc_gold group by all"""),
    "d02_source_activity": with_views("doc_gold", """
        select strftime(published_at, '%Y-%m') year_month, news_site, content_type, count(*) content_count, ingest_date
        from doc_gold group by all"""),
    "d10_top_topics": with_views("doc_gold", """
        select topic_name, count(*) content_count from doc_gold group by 1
        order by content_count desc, topic_name limit 5"""),
    "d11_entity_coverage": with_views("doc_gold", f"""
        with g as (select count(*) total_records, count(*) filter (entities <> '') with_entities from doc_gold)
        select *, {pct('with_entities', 'total_records', 1)} coverage_pct from g"""),
    "d12_batch_sites": with_views("ord", """
        select news_site news_site_name, min(ingest_date) first_in_batch, max(ingest_date) last_in_batch,
               count(*) rows_in_batch from ord where news_site <> '' group by 1"""),
    "e01_dedup_latest": """
        select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice from lineitem
        qualify row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1""",
    "e01_stored_latest": """
        select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice from lineitem
        qualify row_number() over (partition by l_orderkey
            order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1""",
    "e01_stored_earliest": """
        select user_id, event_type, event_id, ts from events
        qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1""",
    "e01_dedup_earliest": """
        select user_id, event_type, event_id, ts from events
        qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1""",
    "f03_latest_month_top": with_views("trends", """
        select year_month, topic_name, content_type, content_count from trends
        where year_month = (select max(year_month) from trends)
        order by content_count desc, topic_name, content_type limit 5"""),
    "g01_union_types": with_views("ord evt", """
        select content_id, content_type, featured, null::varchar news_site, title from ord
        union all select content_id, content_type, featured, news_site, null from evt"""),
    "g03_except_rows": f"""
        with {SITES}
        select site news_site_name, n total_content_count, 'row differs' kind
        from (select site, n from late except all select site, n from early)
        union all select site, n, 'new site' from late where site not in (select site from early)""",
    "h12_record_hash": with_views("ord", """
        select content_id id, sha256(content_id || '||' || title || '||' || url || '||'
               || strftime(published_at, '%Y-%m-%d %H:%M:%S') || '||' || coalesce(image_url, 'NULL')) record_hash
        from ord"""),
    "h13_relation_rows": with_views("doc_silver", """
        select content_id, content_type, 'author' relation, 0 "position", lang item,
               '{"name":"' || lang || '","socials":["' || news_site || '"]}' item_json
        from doc_silver where doc_id % 5 <> 0
        union all select content_id, content_type, 'launch', 0, 'L' || doc_id, launches_json[2:-2]
        from doc_silver where doc_id % 4 = 0
        union all select content_id, content_type, 'event', unnest([0, 1]), unnest(['7', '8']),
               unnest(['{"event_id":7,"kind":"x"}', '{"event_id":8}']) from doc_silver where doc_id % 9 = 0"""),
    "i02_tokens": f"""
        with words as (select doc_id, regexp_extract_all(lower("text"), {WORDS}) w,
                              regexp_extract_all(lower("text"), {LONG_WORDS}) l from documents)
        select doc_id, cast(len(w) as integer) token_count, md5(coalesce(array_to_string(w, ','), '')) keywords_md5,
               cast(len(l) as integer) long_count from words""",
    "i05_topic_scores": with_views("doc_words", f"""
        with scored as (select content_id, {', '.join(f'cast({score_sql(w)} as integer) score_{n.lower()}'
                                                      for n, w in TEST_TOPICS.items())} from doc_words)
        select *, concat_ws(',', {', '.join(f"case when score_{n.lower()} > 0 then '{n}' end" for n in TEST_TOPICS)})
               topics_all from scored"""),
    "i05_topics_default": with_views("doc_real", "select content_id, topic_name, entities from doc_real"),
    "i05_topics_by_token": with_views("doc_words", f"""
        select content_id, {topic_sql(TEST_TOPICS, 'token')} topic_name from doc_words"""),
    "i06_large_dictionary": with_views("doc_words", f"""
        with parts as (select unnest({NAME_PARTS}) part, generate_subscripts({NAME_PARTS}, 1) place),
             names as (select a.part || b.part || c.part name, a.part topic, (a.place * 100 + b.place) * 100 + c.place place
                       from parts a, parts b, parts c),
             found as (select content_id, name, topic, place, contains(lowered, name) inside, list_contains(tokens, name) token
                       from doc_words, names),
             scores as (select content_id, topic, min(place) place, sum(2 * inside::int + token::int) score
                        from found group by 1, 2 having score > 0),
             best as (select content_id, arg_min(topic, (-score, place)) topic from scores group by 1),
             listed as (select content_id, string_agg(name, ',' order by place) entities from found where inside group by 1)
        select content_id, coalesce(topic, 'Other') topic_name, md5(coalesce(entities, '')) entities_md5
        from doc_words left join best using (content_id) left join listed using (content_id)"""),
    "i06_typed_entities": with_views("doc_words", " union all ".join(
        f"""select '{kind}' entity_type, '{name}' entity, count(*) mention_count from doc_words
            where contains(lowered, '{name}') having count(*) > 0"""
        for kind, names in TEST_ENTITIES.items() for name in names)),
    "i07_enriched": with_views("doc_gold", f"""
        select content_id, source_system, md5(keywords) keywords_md5, entities, topic_name,
               cast(year(published_at) as integer) published_year, cast(month(published_at) as integer) published_month,
               cast(day(published_at) as integer) published_day, authors_json, launches_json, events_json,
               'check' ingest_run_id, {NOW} processed_at, record_hash from doc_gold"""),
    "i08_exploded_keywords": with_views("doc_gold", """
        with items as (select content_type, unnest(tokens) keyword from doc_gold)
        select keyword, content_type, count(*) uses from items group by 1, 2"""),
    "i09_sql_functions": f"""
        with {DOC_WORDS} select doc_id, cast(len(tokens) as integer) token_count, {topic_sql(TEST_TOPICS)} topic_name,
               {entity_sql(TEST_ENTITIES)} entities from docs""",
    "j01_scd2_merge": with_views("cust", HISTORY),
    "j01_scd2_stored": with_views("cust", HISTORY),
    "j03_site_dimension": f"""
        with {SITES}
        select coalesce(e.site, l.site) news_site_name, true is_active, coalesce(e.a, l.a) first_seen_date,
               coalesce(l.b, e.b) last_seen_date, coalesce(e.n, 0) + coalesce(l.n, 0) total_content_count,
               case when e.site is null then timestamp '2001-08-02' else timestamp '2000-01-01' end created_at,
               case when l.site is null then timestamp '2000-01-01' else timestamp '2001-08-02' end updated_at
        from early e full join late l on e.site = l.site""",
    "j04_topic_dimension": with_views("doc_gold", f"""
        select distinct topic_name, true is_active, {NOW} created_at from doc_gold"""),
    "j05_replaced_dates": with_views("trends", """
        select year_month, topic_name, content_type,
               content_count + cast(ingest_date = date '2001-08-01' as integer) content_count, ingest_date from trends"""),
    "j05_empty_reload": with_views("trends", "select * from trends where ingest_date <> date '2001-08-01'"),
    "j12_backfill_order": with_views("cust", HISTORY),
    "j06_version_report": with_views("cust", """
        select content_type, count(*) total_records, count(*) filter (is_current) current_records,
               count(*) filter (not is_current) historical_records from cust group by 1"""),
    "j06_dimension_counts": with_views("ord", """
        select 'news_sites' ref_table, count(distinct news_site) total_count from ord
        union all select 'topics', count(distinct topic_name) from ord"""),
    "j06_aggregate_counts": with_views("trends activity", """
        select 'Topic Trends' table_name, ingest_date, count(*) record_count, count(distinct year_month) distinct_months,
               count(distinct topic_name) distinct_groups, count(distinct content_type) distinct_content_types
        from trends group by 2
        union all select 'Source Activity', ingest_date, count(*), count(distinct year_month),
               count(distinct news_site), count(distinct content_type) from activity group by 2"""),
    "j07_run_records": with_views("ord runs", """
        with loaded as (select ingest_date, count(*) n from ord group by 1)
        select strftime(ingest_date, '%Y-%m-%d') || '-'
               || substr(md5(strftime(ingest_date, '%Y-%m-%d') || '2001-08-02 01:00:00'), 1, 8) run_id,
               'daily_load' run_type, 'completed' run_status, ingest_date, n records_processed,
               coalesce(r.records_failed, 0) records_failed, timestamp '2001-08-02 00:30:00' started_at,
               timestamp '2001-08-02 01:00:00' completed_at, cast(1800 as bigint) duration_seconds,
               timestamp '2001-08-02 01:00:00' created_at
        from loaded left join runs r on r.run_date = ingest_date"""),
    "j08_content_checks": with_views("ord", f"""
        select 'daily_content_count-' || strftime(ingest_date, '%Y-%m-%d') check_id, 'daily_content_count' check_name, 'row_count' check_type, 'core.content_items' target_table,
               if(count(*) >= 7, 'PASS', 'WARNING') check_result, cast(count(*) as double) check_value,
               cast(7 as double) threshold_value, ingest_date, {NOW} checked_at from ord group by ingest_date"""),
    "j09_insights": with_views("ord trends activity", f"""
        select '2001-08-01' "date", count(*) total_content, count(distinct news_site) active_sources,
               count(distinct content_type) content_types, {top_list('trends', 'topic_name', 'topic')} top_topics,
               {top_list('activity', 'news_site', 'source')} top_sources
        from ord where ingest_date = date '2001-08-01'"""),
    "j10_unsound_versions": with_views("dup", """
        select content_id, content_type, count(*) versions, count(*) current_versions
        from dup group by 1, 2 having count(*) > 1"""),
    "j10_sound_versions": with_views("cust", """
        select content_type, count(*) versions, cast(0 as bigint) broken_keys from cust group by 1"""),
    "j10_repeated_keys": with_views("ord trends", """
        select 'sites' table_name, news_site "key", count(*) copies from ord group by 2 having count(*) > 1
        union all select 'trends', year_month || '|' || topic_name, count(*) from trends
        group by year_month, topic_name having count(*) > 1"""),
    "k09_3_job_checks": with_views("doc_checked", f"""
        with g as (select count(*) filter (reason is null) records_checked, count(reason) records_failed from doc_checked)
        select date '2024-07-01' check_date, 'daily_content_count' check_name,
               if(records_checked >= 100, 'PASS', 'WARNING') check_result, records_checked, records_failed,
               {pct('records_failed', 'records_checked')} failure_rate_pct from g"""),
    "k11_job_summary": with_views("doc_silver", """
        select cast(published_at as date) "date", content_type, count(*) content_count,
               count(*) filter (featured) featured_count from doc_silver group by 1, 2"""),
    "m01_job_issues": with_views("doc_checked", f"""
        with g as (select content_type, count(*) n, count(*) filter (reason is null) k from doc_checked group by 1),
             i as (select 'broken rule' issue_type, reason subject, count(*) affected_records,
                          (select count(*) from doc_checked) total_records
                   from doc_checked where reason is not null group by reason
                   union all select 'lost records', content_type, n - k, n from g
                   where n <> k and (n - k) * 100 >= n * 10)
        select *, {pct('affected_records', 'total_records')} failure_rate,
               if(affected_records * 100 > total_records * 50, 'CRITICAL', 'WARNING') severity,
               date '2024-07-01' ingest_date from i"""),
    "d03_sketched_distincts": with_views("ord", """
        select strftime(published_at, '%Y-%m') year_month, count(distinct content_id) items, count(distinct news_site) sites,
               count(distinct topic_name) topics, true "close"
        from ord group by 1"""),
    "d01_followed_trends": with_views("cust", """
        select strftime(published_at, '%Y-%m') year_month, topic_name, content_type, count(*) content_count,
               date '1999-01-01' ingest_date
        from cust where valid_from <= timestamp '1999-01-01 06:00:00' and valid_to > timestamp '1999-01-01 06:00:00'
        group by all"""),
    "k11_followed_summary": with_views("cust", """
        select cast(published_at as date) "date", content_type, right(title, 1) news_site, topic_name,
               count(*) content_count, count(*) filter (title like '%7') featured_count
        from cust where is_current group by 1, 2, 3, 4"""),
    "k11_daily_summary": with_views("ord", """
        select cast(published_at as date) "date", content_type, news_site, topic_name, count(*) content_count,
               count(*) filter (featured) featured_count from ord group by 1, 2, 3, 4"""),
    "l01_streamed_gold": with_views("doc_real doc_checked", """
        select content_id, topic_name, record_hash, null::varchar reason from doc_real
        union all select content_type || '_' || id, null, null, reason from doc_checked where reason is not null"""),
    "l02_closed_hours": """
        select date_trunc('hour', ts) window_start, date_trunc('hour', ts) + interval 1 hour window_end, event_type,
               count(*) content_count
        from events group by 1, 2, 3
        having window_end <= (select max(ts) from events) - interval 1 day""",
    "l02_unique_hours": """
        select date_trunc('hour', ts) window_start, date_trunc('hour', ts) + interval 1 hour window_end, event_type,
               count(*) content_count
        from events group by 1, 2, 3""",
    "l02_streamed_hours": """
        select date_trunc('hour', ts) window_start, date_trunc('hour', ts) + interval 1 hour window_end, event_type,
               count(*) content_count
        from events group by 1, 2, 3""",
    "m01_quality_issues": with_views("doc_checked", f"""
        with t as (select news_site, count(*) total_records from doc_checked group by 1),
             g as (select news_site, reason issue_type, count(*) affected_records from doc_checked
                   where reason is not null group by 1, 2)
        select g.*, total_records, {pct('affected_records', 'total_records')} failure_rate,
               if(affected_records * 100 > total_records * 6, 'CRITICAL', 'WARNING') severity
        from g join t using (news_site)"""),
    "m02_threshold_breaches": with_views("runs", """
        with m as (select run_date ingest_date, 'records_processed' metric_name, records_processed current_value from runs
                   union all select run_date, 'records_failed', records_failed from runs),
             l as (select metric_name, cast(floor(avg(current_value)) * 2 as bigint) threshold,
                          if(metric_name = 'records_failed', '>', '<=') comparison from m group by 1)
        select ingest_date, metric_name, current_value, threshold, comparison, 'WARNING' severity
        from m join l using (metric_name)
        where (comparison = '>' and current_value > threshold) or (comparison = '<=' and current_value <= threshold)"""),
    "m03_run_events": with_views("runs", """
        select 'run-' || strftime(run_date, '%Y-%m-%d') run_id, if(status = 'failed', 'ERROR', 'INFO') severity,
               if(status = 'failed', 'Run failed: daily_load', 'Pipeline Completed Successfully') subject,
               run_date ingest_date, records_processed, execution_time_seconds duration_seconds, error_message
        from runs"""),
    "m04_layer_loss": with_views("doc_checked", f"""
        with g as (select news_site, count(*) bronze_count, count(*) filter (reason is null) silver_count
                   from doc_checked group by 1)
        select *, {pct('bronze_count - silver_count', 'bronze_count')} loss_pct,
               (bronze_count - silver_count) * 100 < bronze_count * 12 acceptable from g"""),
    "m05_duplicate_keys": with_views("dup", """
        select content_id, content_type, count(*) copies from dup group by 1, 2 having count(*) > 1"""),
    "m06_null_fields": with_views("doc_raw", """
        select id record_id, 'title' field_name from doc_raw where title is null
        union all select id, 'published_at' from doc_raw where published_text is null"""),
    "m07_suspicious_dates": with_views("ord", """
        select content_id, cast(published_at as date) published_date,
               if(published_at >= timestamp '2001-07-16', 'Future date', 'Very old date') issue
        from ord where published_at >= timestamp '2001-07-16' or year(published_at) < 1996"""),
    "m08_unofficial_sites": with_views("doc_silver", f"""
        with {OFFICIAL} select news_site, count(*) record_count from doc_silver
        where news_site not in (select source from official) group by 1"""),
    "m09_dedup_by_url": """
        select 'https://e.example.com/' || event_type || '/' || user_id url, ts updated_at,
               cast(event_id as varchar) record_hash from events
        qualify row_number() over (partition by event_type, user_id
                                   order by ts desc, cast(event_id as varchar) desc) = 1""",
}
