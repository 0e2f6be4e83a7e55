"""Text enrichment as native column expressions (no Python worker in the plan)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.dictionary import LARGE, best_of, names_found, names_in_order, topic_totals
from tidewire.fixed_values import ENTITY_NAMES, FALLBACK_TOPIC, TOPIC_KEYWORDS

WORD = r"[\p{L}\p{N}_]"

TopicWords = Mapping[str, Iterable[str]]


def analysis_text(title: str = "title", summary: str = "summary") -> Column:
    return F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(summary), F.lit("")))


def tokenize(text: Column, min_length: int = 3) -> Column:
    """Lower-case words of at least ``min_length`` letters, digits or underscores, in text order.

    A word is a maximal run of word characters, so one regex pass that asks for long enough
    runs does the work of replace, split and filter. NULL or empty text gives an empty list.
    """
    return F.coalesce(_words(F.lower(text), min_length), F.array().cast("array<string>"))


def _words(lowered: Column, min_length: int = 3) -> Column:
    return F.regexp_extract_all(lowered, F.lit(f"{WORD}{{{min_length},}}"), 0)


def _word_hit(joined: Column, word: str) -> Column:
    """Is the word one of the tokens? ``joined`` is the token list as ',a,b,c,'."""
    return joined.contains(f",{word},")


def _keyword_points(lowered: Column, joined: Column, keyword: str, match: str) -> Column:
    """Two points when the keyword occurs, one for each of its distinct words among the tokens."""
    words = list(dict.fromkeys(keyword.split()))
    if match == "token":
        occurs = joined.contains("," + ",".join(keyword.split()) + ",")
    else:
        occurs = lowered.contains(keyword)
    if words == [keyword]:
        # The token can only be there when the text contains it: nested, so that a miss costs one search.
        return F.when(occurs, F.when(_word_hit(joined, keyword), 3).otherwise(2)).otherwise(0)
    points = F.when(occurs, 2).otherwise(0)
    for word in words:
        points = points + F.when(_word_hit(joined, word), 1).otherwise(0)
    return points


def topic_scores(lowered: Column, joined: Column, topics: TopicWords, match: str = "substring") -> Column:
    """Array of scores, one per topic in dictionary order."""
    scores = []
    for keywords in topics.values():
        points = [_keyword_points(lowered, joined, keyword, match) for keyword in keywords]
        total = F.lit(0)
        for point in points:
            total = total + point
        scores.append(total)
    return F.array(*scores)


def best_topic(scores: Column, topics: TopicWords, fallback: str = FALLBACK_TOPIC) -> Column:
    """Highest score wins, the first topic wins a tie, no points gives the fallback."""
    names = F.array(*[F.lit(name) for name in topics])
    best = F.array_max(scores)
    return F.when(best > 0, F.element_at(names, F.array_position(scores, best).cast("int"))).otherwise(fallback)


def positive_topics(scores: Column, topics: TopicWords) -> Column:
    """Every topic that scored, as comma-joined text in dictionary order."""
    return F.concat_ws(",", *[F.when(scores[i] > 0, F.lit(name)) for i, name in enumerate(topics)])


def entity_list(lowered: Column, entities: TopicWords = ENTITY_NAMES, found: Column | None = None) -> Column:
    """Known names found in the text, comma-joined in dictionary order; '' when there are none. ``found``: those of a large
    dictionary, where they are known."""
    names = dict.fromkeys(name for group in entities.values() for name in group)
    if len(names) > LARGE:
        return F.array_join(names_in_order(lowered, names, found), ",")
    return F.concat_ws(",", *[F.when(lowered.contains(name), F.lit(name)) for name in names])


def entity_records(lowered: Column, entities: TopicWords = ENTITY_NAMES) -> Column:
    """Array of (type, name) for the names found."""
    hits = [
        F.when(lowered.contains(name), F.struct(F.lit(kind).alias("type"), F.lit(name).alias("name")))
        for kind, names in entities.items()
        for name in names
    ]
    return F.array_compact(F.array(*hits))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it.

    A filter on a derived column moves below the projection that derives it and takes the whole
    expression along; named columns would then be copied into every place that refers to them.
    The item of a one-element array stays a variable wherever the expression goes.
    """
    return F.transform(F.array(value), lambda item: use(item))[0]


def enrich_text(
    df: DataFrame, topics: TopicWords = TOPIC_KEYWORDS, entities: TopicWords = ENTITY_NAMES,
    match: str = "substring",
) -> DataFrame:
    """Add keywords (as joined text and as a list), entities and topic_name from title and summary.

    Dictionaries of over ``LARGE`` names are searched as a whole, at a cost that hardly grows with them.

    Built in narrow steps, so that the lowered text, the token list and the scores are each
    computed once per row and then only searched. The results leave through ``inline`` of a
    one-row array: a filter on a generated column stays above the generator, while a filter on
    a projected column would move below and repeat the whole text work for every mention.
    """
    lowered, joined, scores = F.col("_lowered"), F.col("_joined"), F.col("_scores")
    many = sum(len(list(keywords)) for keywords in topics.values()) > LARGE
    # The same names as keywords and as entities: the text is searched for them once.
    words, names = ({w for group in d.values() for w in group} for d in (topics, entities))
    once = F.col("_found") if many and match == "substring" and words == names and len(names) > LARGE else None
    scored = topic_totals(lowered, joined, topics, match, once) if many else topic_scores(lowered, joined, topics, match)
    lowered_rows = df.withColumn("_lowered", F.lower(analysis_text()))
    steps = (
        (lowered_rows if once is None else lowered_rows.withColumn("_found", names_found(lowered, names)))
        .withColumn("_list", _words(lowered))
        .withColumn("_words", F.concat_ws(",", "_list"))
        .withColumn("_joined", F.concat(F.lit(","), F.col("_words"), F.lit(",")))
        .withColumn("_scores", scored)
    )
    facts = F.struct(
        F.col("_words").alias("keywords"),
        F.col("_list").alias("keyword_list"),
        entity_list(lowered, entities, once).alias("entities"),
        (best_of(scores, topics, FALLBACK_TOPIC) if many else best_topic(scores, topics)).alias("topic_name"),
    )
    return steps.select(*df.columns, F.inline(F.array(facts)))


def split_list(joined: Column) -> Column:
    """Trimmed items of comma-joined text."""
    items = F.split(joined, ",")
    # A lambda of one argument: F.trim itself takes two, and would get the position as the second.
    return F.when(joined.contains(" "), F.transform(items, lambda item: F.trim(item))).otherwise(items)


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, leave the path as it is."""
    head = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
    host = F.regexp_extract(url, head, 1)
    rest = F.substr(url, F.length(host) + 1)
    return F.when(F.length(host) > 0, F.concat(F.lower(host), rest)).otherwise(url)


def is_web_address(url: Column, min_length: int = 10) -> Column:
    return (url.startswith("http://") | url.startswith("https://")) & (F.length(url) > min_length)


def register_sql_functions(
    spark: SparkSession, topics: TopicWords = TOPIC_KEYWORDS, entities: TopicWords = ENTITY_NAMES
) -> None:
    """SQL names for the three text functions, as SQL expressions that Catalyst inlines."""

    def quoted(word: str) -> str:
        return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"

    words = f"regexp_extract_all(lower(t), '{WORD}{{3,}}', 0)".replace("\\", "\\\\")
    totals = []
    for keywords in topics.values():
        points = [f"2 * int(contains(x.lowered, {quoted(k)}))" for k in keywords]
        points += [f"int(contains(x.joined, {quoted(f',{w},')}))" for k in keywords for w in dict.fromkeys(k.split())]
        totals.append(" + ".join(points) or "0")
    labels = f"array({', '.join(quoted(name) for name in topics)})"
    names = ", ".join(quoted(n) for n in dict.fromkeys(n for group in entities.values() for n in group))
    # Items of one-element arrays: the words and the scores are computed once, however often they are named.
    text = f"struct(lower(t) AS lowered, concat(',', concat_ws(',', {words}), ',') AS joined)"
    best = f"CASE WHEN array_max(s) > 0 THEN element_at({labels}, int(array_position(s, array_max(s)))) END"
    topic = f"transform(array({text}), x -> transform(array(array({', '.join(totals)})), s -> {best})[0])[0]"
    bodies = {
        "tokenize_text_udf": ("ARRAY<STRING>", f"coalesce({words}, cast(array() as array<string>))"),
        "classify_topic_udf": ("STRING", f"coalesce({topic}, {quoted(FALLBACK_TOPIC)})"),
        "extract_entities_udf": (
            "ARRAY<STRING>",
            f"coalesce(transform(array(lower(t)), l -> filter(array({names}), e -> contains(l, e)))[0], "
            "cast(array() as array<string>))",
        ),
    }
    for name, (result, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {result} RETURN {body}")
