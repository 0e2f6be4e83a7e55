"""The 52 reports over the adapter tables, one callable per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import adapters as A
from tidewire.operators.quality import checks_view, runs_view
from tidewire.plans import advanced, aggregates, dashboard, health, monitoring, sites, temporal, terms, topics, volume

ORD_NOW = "2001-08-02 10:30:00"


def _on(table, report, **params):
    return lambda spark, sf_dir: report(table(spark, sf_dir), **params)


def _rounded(query, *columns, digits: int = 6):
    """Deviations differ in the last binary digit between engines; compare them to six digits."""
    return lambda spark, sf_dir: (
        query(spark, sf_dir).withColumns({c: F.round(c, digits) for c in columns})
    )


ORD, EVT, DOC = A.orders_content, A.events_content, A.documents_content
ord_day = {"as_of": A.ORD_AS_OF}
evt_day = {"as_of": A.EVT_AS_OF}

REPORT_QUERIES = {
    "k01_1_volume_by_type": _on(ORD, volume.volume_by_type),
    "k01_2_daily_volume": _on(EVT, volume.daily_volume, **evt_day),
    "k01_3_topic_distribution": _on(ORD, volume.topic_distribution),
    "k01_4_text_lengths": _on(A.documents_texts, volume.text_lengths),
    "k01_5_featured_share": _on(ORD, volume.featured_share),
    "k01_6_image_share": _on(ORD, volume.image_share),
    "k02_1_top_sites": _on(ORD, sites.top_sites),
    "k02_2_site_months": _on(ORD, sites.site_months, **ord_day),
    "k02_3_site_specialization": _on(ORD, sites.site_specialization),
    "k02_4_site_diversity": _on(ORD, sites.site_diversity),
    "k02_5_site_frequency": _on(ORD, sites.site_frequency),
    "k03_1_top_topics": _on(ORD, topics.top_topics),
    "k03_2_topic_type_matrix": _on(ORD, topics.topic_type_matrix),
    "k03_3_trending_topics": _on(ORD, topics.trending_topics, **ord_day),
    "k03_4_emerging_topics": _on(EVT, topics.emerging_topics, **evt_day),
    "k04_1_monthly_volume": _on(ORD, temporal.monthly_volume, **ord_day),
    "k04_2_weekly_volume": _on(EVT, temporal.weekly_volume, **evt_day),
    "k04_3_weekday_pattern": _on(EVT, temporal.weekday_pattern, **evt_day),
    "k04_4_hourly_pattern": _on(EVT, temporal.hourly_pattern, **evt_day),
    "k04_5_monthly_growth": _on(ORD, temporal.monthly_growth, **ord_day),
    "k05_1_top_entities": _on(DOC, terms.top_entities),
    "k05_2_top_keywords": _on(DOC, terms.top_keywords),
    "k05_3_keywords_by_topic": _on(DOC, terms.keywords_by_topic),
    "k05_4_entity_pairs": _on(DOC, terms.entity_pairs),
    "k06_1_freshness": _on(ORD, health.freshness, now=ORD_NOW, **ord_day),
    "k06_2_completeness": _on(DOC, health.completeness),
    "k06_3_duplicate_current": _on(A.raw_lineitems, health.duplicate_current),
    "k06_4_version_histogram": _on(A.customer_state, health.version_histogram),
    "k06_5_ingest_quality": _on(A.raw_lineitems, health.ingest_quality, as_of="2001-06-01"),
    "k06_6_version_audit": _on(A.customer_state, health.version_audit, as_of="2001-08-05"),
    "k07_1_topic_trend_report": _on(A.stored_trends, aggregates.topic_trend_report, **ord_day),
    "k07_2_site_activity_report": _on(A.stored_activity, aggregates.site_activity_report, **ord_day),
    "k07_3_topic_growth": _on(A.stored_trends, aggregates.topic_growth, **ord_day),
    "k07_4_best_months": _on(A.stored_trends, aggregates.best_months),
    "k08_1_executive_summary": _on(ORD, dashboard.executive_summary, **ord_day),
    "k08_2_week_in_days": _on(EVT, dashboard.week_in_days, **evt_day),
    "k08_3_type_distribution": _on(ORD, dashboard.type_distribution),
    "k08_4_leading_topics": _on(ORD, dashboard.leading_topics),
    "k08_5_leading_sites": _on(ORD, dashboard.leading_sites),
    "k08_6_highlights": _on(ORD, dashboard.highlights),
    "k08_7_activity_heatmap": _on(EVT, dashboard.activity_heatmap, very_high=340, high=330, medium=320, **evt_day),
    "k09_1_recent_runs": lambda s, d: monitoring.recent_runs(runs_view(A.daily_runs(s, d))),
    "k09_2_failed_runs": lambda s, d: monitoring.failed_runs(runs_view(A.daily_runs(s, d)), now=ORD_NOW, **ord_day),
    "k09_3_recent_checks": lambda s, d: monitoring.recent_checks(checks_view(A.daily_checks(s, d))),
    "k09_4_failed_checks": lambda s, d: monitoring.failed_checks(checks_view(A.daily_checks(s, d)), **ord_day),
    "k09_5_stale_types": _on(ORD, monitoring.stale_types, as_of="2001-08-03"),
    "k09_6_volume_anomalies": _rounded(
        _on(EVT, monitoring.volume_anomalies, **evt_day), "avg_daily", "stddev_daily"
    ),
    "k10_1_topic_pairs": _on(EVT, advanced.topic_pairs),
    "k10_1b_topic_pairs_orders": _on(ORD, advanced.topic_pairs),
    "k10_2_site_velocity": _rounded(
        _on(EVT, advanced.site_velocity, **evt_day), "avg_articles_per_day", "stddev_articles"
    ),
    "k10_3_topic_seasonality": _on(ORD, advanced.topic_seasonality, **ord_day),
    "k10_4_ingest_lag": _on(ORD, advanced.ingest_lag),
    "k10_5_source_reliability": _on(ORD, advanced.source_reliability, **ord_day),
}
