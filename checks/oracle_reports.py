"""SQL for the 52 reports, over the views of ``oracle_views``."""

from __future__ import annotations

from checks.oracle_views import half_up, pct, with_views

ORD_TODAY = "date '2001-08-02'"
EVT_TODAY = "date '2024-01-31'"
NAMED = "topic_name is not null and topic_name not in ('2018','2019','2020','2021','2022','2023','2024')"



REPORTS: dict[str, str] = {
    "k01_1_volume_by_type": with_views("ord", f"""
        with g as (select content_type, count(*) total_records, count(distinct content_id) unique_content,
                          min(published_at) earliest, max(published_at) latest from ord group by 1)
        select *, datediff('day', earliest, latest) days_span,
               {pct('total_records', 'sum(total_records) over ()')} percentage from g"""),
    "k01_2_daily_volume": with_views("evt", f"""
        select date_trunc('day', published_at) publish_date, content_type, count(*) content_count
        from evt where published_at >= {EVT_TODAY} - 30 group by 1, 2"""),
    "k01_3_topic_distribution": with_views("ord", f"""
        with g as (select topic_name, content_type, count(*) content_count from ord where {NAMED} group by 1, 2)
        select *, {pct('content_count', 'sum(content_count) over ()')} percentage from g"""),
    "k01_4_text_lengths": with_views("doc_gold", f"""
        with s as (select content_type, length(title) t, length(summary) s from doc_gold
                   where title is not null and summary is not null),
             g as (select content_type, count(*) total_content, cast(sum(t) as bigint) st, cast(sum(s) as bigint) ss,
                          min(t) min_title_length, max(t) max_title_length,
                          min(s) min_summary_length, max(s) max_summary_length from s group by 1)
        select content_type, total_content, {half_up('st', 'total_content', 0)} avg_title_length,
               {half_up('ss', 'total_content', 0)} avg_summary_length,
               cast(min_title_length as integer) min_title_length, cast(max_title_length as integer) max_title_length,
               cast(min_summary_length as integer) min_summary_length,
               cast(max_summary_length as integer) max_summary_length from g"""),
    "k01_5_featured_share": with_views("ord", f"""
        with g as (select content_type, featured, count(*) content_count from ord group by 1, 2)
        select *, {pct('content_count', 'sum(content_count) over (partition by content_type)')} percentage_within_type
        from g"""),
    "k01_6_image_share": with_views("ord", f"""
        with g as (select content_type, if(image_url is null, 'No Image', 'With Image') has_image,
                          count(*) content_count from ord group by 1, 2)
        select *, {pct('content_count', 'sum(content_count) over (partition by content_type)')} percentage from g"""),
    "k02_1_top_sites": with_views("ord", f"""
        with g as (select news_site, count(*) article_count, count(distinct topic_name) topics_covered,
                          min(published_at) first_article, max(published_at) latest_article,
                          cast(sum(length(summary)) as bigint) letters, count(summary) summaries
                   from ord where news_site is not null group by 1)
        select news_site, article_count, topics_covered, first_article, latest_article,
               datediff('day', first_article, latest_article) active_days,
               {half_up('letters', 'summaries', 0)} avg_summary_length
        from g order by article_count desc, news_site limit 20"""),
    "k02_2_site_months": with_views("ord", f"""
        select strftime(published_at, '%Y-%m') year_month, news_site, count(*) content_count from ord
        where news_site is not null and published_at >= {ORD_TODAY} - interval 12 month group by 1, 2"""),
    "k02_3_site_specialization": with_views("ord", f"""
        with g as (select news_site, topic_name, count(*) article_count from ord
                   where news_site is not null and {NAMED} group by 1, 2 having count(*) >= 5)
        select *, {pct('article_count', 'sum(article_count) over (partition by news_site)')} pct_of_source_output
        from g"""),
    "k02_4_site_diversity": with_views("ord", f"""
        with g as (select news_site, count(distinct topic_name) topic_diversity, count(*) total_articles from ord
                   where news_site is not null and {NAMED} group by 1 having count(*) >= 10)
        select *, {half_up('topic_diversity', 'total_articles', 3)} diversity_ratio from g"""),
    "k02_5_site_frequency": with_views("ord", f"""
        with g as (select news_site, count(*) total_articles, min(published_at) first_article,
                          max(published_at) latest_article,
                          datediff('day', min(published_at), max(published_at)) + 1 active_days
                   from ord where news_site is not null group by 1 having count(*) >= 50)
        select *, {half_up('total_articles', 'active_days')} articles_per_day from g"""),
    "k03_1_top_topics": with_views("ord", f"""
        with g as (select topic_name, count(*) content_count, count(distinct news_site) sources_covering,
                          min(published_at) first_mention, max(published_at) latest_mention
                   from ord where {NAMED} group by 1)
        select *, {pct('content_count', 'sum(content_count) over ()')} percentage from g"""),
    "k03_2_topic_type_matrix": with_views("ord", f"""
        with g as (select topic_name, content_type, count(*) content_count from ord where {NAMED} group by 1, 2)
        select *, {pct('content_count', 'sum(content_count) over (partition by topic_name)')} pct_within_topic
        from g"""),
    "k03_3_trending_topics": with_views("ord", f"""
        with lately as (select topic_name, count(*) n from ord where {NAMED} and published_at >= {ORD_TODAY} - 7
                        and published_at < {ORD_TODAY} group by 1),
             earlier as (select topic_name, count(*) n from ord where {NAMED} and published_at >= {ORD_TODAY} - 14
                         and published_at < {ORD_TODAY} - 7 group by 1),
             both_weeks as (select coalesce(l.topic_name, e.topic_name) topic_name, coalesce(l.n, 0) last_7_days,
                                   coalesce(e.n, 0) previous_7_days
                            from lately l full join earlier e on l.topic_name = e.topic_name)
        select *, last_7_days - previous_7_days absolute_change,
               {pct('last_7_days - previous_7_days', 'previous_7_days')} percent_change from both_weeks"""),
    "k03_4_emerging_topics": with_views("evt", f"""
        select topic_name, min(published_at) first_appearance, count(*) article_count,
               count(distinct news_site) sources, datediff('day', min(published_at), {EVT_TODAY}) days_since_first
        from evt where {NAMED} group by 1 having min(published_at) >= {EVT_TODAY} - 90"""),
    "k04_1_monthly_volume": with_views("ord", f"""
        select strftime(published_at, '%Y-%m') year_month, content_type, count(*) content_count,
               count(distinct news_site) active_sources, count(distinct topic_name) topics_covered
        from ord where published_at >= {ORD_TODAY} - interval 24 month group by 1, 2"""),
    "k04_2_weekly_volume": with_views("evt", f"""
        with g as (select cast(date_trunc('week', published_at) as timestamp) week_start, count(*) total_content,
                          count(distinct news_site) active_sources
                   from evt where published_at >= {EVT_TODAY} - 84 group by 1)
        select *, {half_up('total_content', '7', 1)} avg_per_day from g"""),
    "k04_3_weekday_pattern": with_views("evt", f"""
        with g as (select dayname(published_at) day_of_week, cast(dayofweek(published_at) as bigint) day_number,
                          count(*) content_count from evt where published_at >= {EVT_TODAY} - 90 group by 1, 2)
        select *, {pct('content_count', 'sum(content_count) over ()')} percentage,
               {half_up('sum(content_count) over ()', 'count(*) over ()', 0)} avg_per_day from g"""),
    "k04_4_hourly_pattern": with_views("evt", f"""
        with g as (select cast(hour(published_at) as bigint) hour_of_day, count(*) content_count from evt
                   where published_at >= {EVT_TODAY} - 90 group by 1)
        select *, {pct('content_count', 'sum(content_count) over ()')} percentage from g"""),
    "k04_5_monthly_growth": with_views("ord", f"""
        with g as (select strftime(published_at, '%Y-%m') year_month, count(*) current_month from ord
                   where published_at >= {ORD_TODAY} - interval 12 month group by 1),
             h as (select *, lag(current_month) over (order by year_month) previous_month from g)
        select *, current_month - previous_month absolute_change,
               {pct('current_month - previous_month', 'previous_month')} growth_rate_pct from h"""),
    "k05_1_top_entities": with_views("doc_gold", """
        with items as (select distinct content_id, content_type, topic_name, unnest(string_split(entities, ',')) entity
                       from doc_gold where entities <> '')
        select entity, count(distinct content_id) mention_count, count(distinct content_type) content_types_count,
               count(distinct topic_name) topics_count
        from items where length(entity) >= 3 group by 1 order by mention_count desc, entity limit 50"""),
    "k05_2_top_keywords": with_views("doc_gold", """
        with items as (select content_id, topic_name, unnest(tokens) keyword from doc_gold)
        select keyword, count(distinct content_id) frequency, count(distinct topic_name) topics_used_in
        from items group by 1 order by frequency desc, keyword limit 100"""),
    "k05_3_keywords_by_topic": with_views("doc_gold", f"""
        with items as (select topic_name, unnest(tokens) keyword from doc_gold where {NAMED})
        select topic_name, keyword, count(*) frequency from items group by 1, 2 having count(*) >= 5"""),
    "k05_4_entity_pairs": with_views("doc_gold", """
        with listed as (select content_id, string_split(entities, ',') names from doc_gold where entities <> ''),
             placed as (select content_id, unnest(names) entity, generate_subscripts(names, 1) place from listed)
        select a.entity entity1, b.entity entity2, count(distinct a.content_id) co_occurrences
        from placed a join placed b on a.content_id = b.content_id and a.place < b.place
        where length(a.entity) >= 3 and length(b.entity) >= 3
        group by 1, 2 having count(distinct a.content_id) >= 5
        order by co_occurrences desc, entity1, entity2 limit 100"""),
    "k06_1_freshness": with_views("ord", f"""
        select content_type, max(published_at) latest_published, max(ingest_date) latest_ingested,
               datediff('hour', max(published_at), timestamp '2001-08-02 10:30:00') hours_since_latest_publish,
               datediff('day', max(ingest_date), {ORD_TODAY}) days_since_latest_ingest
        from ord group by 1"""),
    "k06_2_completeness": with_views("doc_gold", f"""
        with g as (
            select 'title' field_name, count(*) - count(title) null_count, count(*) total_count from doc_gold
            union all select 'image_url', count(*) - count(image_url), count(*) from doc_gold
            union all select 'summary', count(*) - count(summary), count(*) from doc_gold
            union all select 'topic_name', count(*) - count(topic_name), count(*) from doc_gold
            union all select 'entities', count(*) - count(entities), count(*) from doc_gold
            union all select 'keywords', count(*) - count(keywords), count(*) from doc_gold
            union all select 'news_site', count(*) - count(news_site), count(*) from doc_gold)
        select *, total_count - null_count non_null_count, {pct('null_count', 'total_count')} null_percentage,
               {pct('total_count - null_count', 'total_count')} completeness_pct from g"""),
    "k06_3_duplicate_current": with_views("dup", """
        select content_id, content_type, count(*) current_versions, 1 latest_version
        from dup group by 1, 2 having count(*) > 1"""),
    "k06_4_version_histogram": with_views("cust", """
        with g as (select content_id, content_type, count(*) version_count from cust group by 1, 2)
        select version_count, count(*) content_with_this_many_versions from g group by 1"""),
    "k06_5_ingest_quality": with_views("dup", """
        select ingest_date, content_type, count(*) records_ingested, count(distinct content_id) unique_content,
               count(*) - count(distinct content_id) duplicates_in_batch
        from dup where ingest_date >= date '2001-06-01' - 30 group by 1, 2"""),
    "k06_6_version_audit": with_views("cust", """
        select content_id, content_type, "version", valid_from, valid_to, is_current, title from cust
        where valid_from >= date '2001-08-05' - 7 or valid_to >= date '2001-08-05' - 7
        order by valid_from desc, content_id, content_type, "version" desc limit 100"""),
    "k07_1_topic_trend_report": with_views("trends", f"""
        with g as (select year_month, topic_name, cast(sum(content_count) as bigint) total_content, count(*) parts
                   from trends where ingest_date = (select max(ingest_date) from trends) and {NAMED}
                   and year_month >= strftime({ORD_TODAY} - interval 12 month, '%Y-%m') group by 1, 2)
        select year_month, topic_name, total_content, {half_up('total_content', 'parts', 1)} avg_per_type from g"""),
    "k07_2_site_activity_report": with_views("activity", f"""
        select year_month, news_site, cast(sum(content_count) as bigint) total_content from activity
        where ingest_date = (select max(ingest_date) from activity)
        and year_month >= strftime({ORD_TODAY} - interval 12 month, '%Y-%m') group by 1, 2"""),
    "k07_3_topic_growth": with_views("trends", f"""
        with g as (select year_month, topic_name, cast(sum(content_count) as bigint) current_month from trends
                   where ingest_date = (select max(ingest_date) from trends) and {NAMED} group by 1, 2),
             h as (select *, lag(current_month) over (partition by topic_name order by year_month) previous_month
                   from g)
        select *, current_month - coalesce(previous_month, 0) absolute_change,
               {pct('current_month - previous_month', 'previous_month')} growth_rate_pct
        from h where year_month >= strftime({ORD_TODAY} - interval 6 month, '%Y-%m')"""),
    "k07_4_best_months": with_views("trends", f"""
        with g as (select topic_name, year_month, cast(sum(content_count) as bigint) total_content from trends
                   where ingest_date = (select max(ingest_date) from trends) and {NAMED} group by 1, 2)
        select *, rank() over (partition by topic_name order by total_content desc) rank_within_topic from g
        qualify rank_within_topic <= 3"""),
    "k08_1_executive_summary": with_views("ord", f"""
        select count(*) total_content, count(distinct content_id) unique_content_items,
               count(distinct news_site) active_sources,
               count(distinct topic_name) filter ({NAMED}) topics_covered, max(published_at) latest_content_date,
               max(ingest_date) latest_ingest_date,
               count(*) filter (published_at >= {ORD_TODAY} - 7) content_last_7_days,
               count(*) filter (published_at >= {ORD_TODAY} - 30) content_last_30_days from ord"""),
    "k08_2_week_in_days": with_views("evt", f"""
        select date_trunc('day', published_at) "date", count(*) content_count,
               count(distinct news_site) active_sources, count(distinct topic_name) topics_covered,
               count(*) filter (featured) featured_count
        from evt where published_at >= {EVT_TODAY} - 7 group by 1"""),
    "k08_3_type_distribution": with_views("ord", f"""
        with g as (select content_type, count(*) content_count from ord group by 1)
        select *, {pct('content_count', 'sum(content_count) over ()')} percentage from g"""),
    "k08_4_leading_topics": with_views("ord", f"""
        select topic_name, count(*) content_count, count(distinct news_site) sources_covering from ord
        where {NAMED} group by 1 order by content_count desc, topic_name limit 10"""),
    "k08_5_leading_sites": with_views("ord", """
        select news_site, count(*) content_count, count(distinct topic_name) topics_covered from ord
        where news_site is not null group by 1 order by content_count desc, news_site limit 10"""),
    "k08_6_highlights": with_views("ord", """
        select title, content_type, news_site, topic_name, published_at, url, image_url, summary from ord
        where featured and image_url is not null order by published_at desc, url limit 10"""),
    "k08_7_activity_heatmap": with_views("evt", f"""
        select cast(published_at as date) "date", count(*) content_count,
               case when count(*) >= 340 then 'Very High' when count(*) >= 330 then 'High'
                    when count(*) >= 320 then 'Medium' else 'Low' end activity_level
        from evt where published_at >= {EVT_TODAY} - 90 group by 1"""),
    "k09_1_recent_runs": with_views("runs", f"""
        select run_date, pipeline_name, status, records_processed, execution_time_seconds,
               {half_up('records_processed', 'execution_time_seconds')} records_per_second, error_message, created_at
        from runs order by run_date desc, created_at desc limit 50"""),
    "k09_2_failed_runs": with_views("runs", f"""
        select run_date, pipeline_name, status, error_message, execution_time_seconds, created_at,
               datediff('hour', created_at, timestamp '2001-08-02 10:30:00') hours_ago
        from runs where status = 'failed' and run_date >= {ORD_TODAY} - 7"""),
    "k09_3_recent_checks": with_views("chk", f"""
        select check_date, check_name, check_result, records_checked, records_failed,
               {pct('records_failed', 'records_checked')} failure_rate_pct, error_details, created_at
        from chk order by check_date desc, created_at desc limit 50"""),
    "k09_4_failed_checks": with_views("chk", f"""
        select check_date, check_name, check_result, records_checked, records_failed, error_details
        from chk where check_result = 'failed' and check_date >= {ORD_TODAY} - 7"""),
    "k09_5_stale_types": with_views("ord", """
        with g as (select content_type, max(ingest_date) latest_ingest_date,
                          datediff('day', max(ingest_date), date '2001-08-03') days_since_last_ingest
                   from ord group by 1)
        select *, case when days_since_last_ingest > 2 then 'ALERT: Stale Data'
                       when days_since_last_ingest > 1 then 'WARNING: Data Aging' else 'OK' end freshness_status
        from g"""),
    "k09_6_volume_anomalies": with_views("evt", f"""
        with daily as (select cast(published_at as date) "date", count(*) daily_count from evt
                       where published_at >= {EVT_TODAY} - 30 group by 1),
             s as (select avg(daily_count) a, stddev_samp(daily_count) d from daily)
        select "date", daily_count, round(a, 6) avg_daily, round(d, 6) stddev_daily,
               round((daily_count - a) / nullif(d, 0), 2) z_score,
               case when abs((daily_count - a) / nullif(d, 0)) > 2 then 'ANOMALY'
                    when abs((daily_count - a) / nullif(d, 0)) > 1.5 then 'WARNING' else 'NORMAL' end status
        from daily, s where "date" >= {EVT_TODAY} - 7"""),
    "k10_1_topic_pairs": with_views("evt", f"""
        with days as (select cast(published_at as date) d, news_site, topic_name from evt where {NAMED}),
             g as (select a.topic_name topic1, b.topic_name topic2, count(*) co_occurrence_count
                   from days a join days b on a.d = b.d and a.news_site = b.news_site and a.topic_name < b.topic_name
                   group by 1, 2 having count(*) >= 10)
        select *, rank() over (order by co_occurrence_count desc) "rank" from g
        order by co_occurrence_count desc, topic1, topic2 limit 50"""),
    "k10_1b_topic_pairs_orders": with_views("ord", f"""
        with days as (select cast(published_at as date) d, news_site, topic_name, count(*) n from ord where {NAMED}
                      group by 1, 2, 3),
             g as (select a.topic_name topic1, b.topic_name topic2, cast(sum(a.n * b.n) as bigint) co_occurrence_count
                   from days a join days b on a.d = b.d and a.news_site = b.news_site and a.topic_name < b.topic_name
                   group by 1, 2)
        select *, rank() over (order by co_occurrence_count desc) "rank" from g where co_occurrence_count >= 10
        order by co_occurrence_count desc, topic1, topic2 limit 50"""),
    "k10_2_site_velocity": with_views("evt", f"""
        with daily as (select cast(published_at as date) d, news_site, count(*) n from evt
                       where published_at >= {EVT_TODAY} - 90 and news_site is not null group by 1, 2)
        select news_site, round(avg(n), 6) avg_articles_per_day, min(n) min_daily, max(n) max_daily,
               round(stddev_samp(n), 6) stddev_articles, count(distinct d) active_days
        from daily group by 1 having count(distinct d) >= 30 order by avg(n) desc, news_site limit 20"""),
    "k10_3_topic_seasonality": with_views("ord", f"""
        with g as (select topic_name, cast(month(published_at) as bigint) "month", monthname(published_at) month_name,
                          count(*) article_count
                   from ord where {NAMED} and published_at >= {ORD_TODAY} - interval 24 month group by 1, 2, 3)
        select *, {pct('article_count', 'sum(article_count) over (partition by topic_name)')} pct_of_topic_total
        from g"""),
    "k10_4_ingest_lag": with_views("ord", """
        select content_type, datediff('day', published_at, ingest_date) days_to_ingest, count(*) content_count
        from ord where ingest_date is not null and published_at is not null
        and datediff('day', published_at, ingest_date) between 0 and 365 group by 1, 2"""),
    "k10_5_source_reliability": with_views("ord", f"""
        with m as (select news_site, count(*) total_articles, count(distinct cast(published_at as date)) active_days,
                          count(distinct topic_name) topics_covered,
                          datediff('day', min(published_at), max(published_at)) + 1 span,
                          datediff('day', max(published_at), {ORD_TODAY}) days_since_last
                   from ord where news_site is not null and published_at >= {ORD_TODAY} - 180 group by 1
                   having count(*) >= 10),
             c as (select *, {half_up('active_days', 'span', 2, 100)} consistency_pct from m)
        select news_site, total_articles, active_days, topics_covered, consistency_pct, days_since_last,
               cast(round(cast(consistency_pct as decimal(9, 2)) * 0.4 + least(topics_covered * 10, 100) * 0.3
                          + greatest(100 - days_since_last * 10, 0) * 0.3, 2) as double) reliability_score
        from c order by reliability_score desc, news_site limit 30"""),
}

# The same reports from tables that follow the loads.
REPORTS |= {
    "k05_2_stored_keywords": REPORTS["k05_2_top_keywords"],
    "k05_3_stored_keywords": REPORTS["k05_3_keywords_by_topic"],
}
