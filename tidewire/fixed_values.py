"""These must stay exactly as they are for results to match."""

# Topic dictionary, in priority order (the first topic wins a tie).
TOPIC_KEYWORDS = {
    "ISS": ["iss", "international space station", "station", "expedition"],
    "Mars": ["mars", "perseverance", "curiosity", "ingenuity", "martian"],
    "Moon": ["moon", "lunar", "artemis", "chandrayaan", "luna"],
    "SpaceX": ["spacex", "starship", "falcon", "dragon", "starlink", "musk"],
    "NASA": ["nasa", "artemis", "sls", "orion"],
    "Astronomy": ["telescope", "james webb", "hubble", "galaxy", "exoplanet", "star"],
    "Satellite": ["satellite", "orbit", "cubesat", "starlink"],
    "Launch": ["launch", "rocket", "liftoff", "countdown"],
    "Science": ["research", "experiment", "discovery", "mission", "data"],
    "Commercial": ["commercial", "private", "company", "industry"],
}

FALLBACK_TOPIC = "Other"

# Entity dictionary by kind.
ENTITY_NAMES = {
    "spacecraft": ["iss", "hubble", "james webb", "perseverance", "curiosity", "dragon", "starship", "soyuz"],
    "company": ["spacex", "nasa", "esa", "blue origin", "virgin galactic", "roscosmos", "cnsa"],
    "person": ["elon musk", "jeff bezos", "richard branson"],
    "celestial_body": ["mars", "moon", "earth", "jupiter", "saturn", "venus"],
}

# Topic values that are really years and are left out of topic reports.
NOISE_TOPICS = ["2018", "2019", "2020", "2021", "2022", "2023", "2024"]

CONTENT_TYPES = ["articles", "blogs", "reports"]
ENDPOINTS = ["articles", "blogs", "reports", "info"]
SOURCE_SYSTEM = "spaceflight_news_api_v4"

OPEN_END = "9999-12-31 23:59:59"
HASH_COLUMNS = ["id", "title", "url", "published_at", "summary"]

# Columns of the staging files, in their order.
STAGING_COLUMNS = [
    "id", "content_id", "content_type", "source_system", "title", "url", "summary", "image_url", "news_site", "featured",
    "published_at", "updated_at", "keywords", "entities", "topic_name", "published_year", "published_month",
    "published_day", "authors_json", "launches_json", "events_json", "ingest_date", "ingest_run_id", "record_hash",
    "processed_at",
]
TOPIC_TREND_COLUMNS = ["year_month", "topic_name", "content_type", "content_count", "ingest_date", "calculated_at"]
SITE_ACTIVITY_COLUMNS = ["year_month", "news_site", "content_type", "content_count", "ingest_date", "calculated_at"]
