"""Joins, aggregates, rankings and ad-hoc queries over the star schema."""

from datetime import date

from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates
from textpulse.operators import recent, summary, textindex
from textpulse.operators.star import Criteria, Star, drill_down
from textpulse.plans import adhoc, bi
from workload import inputs, sql
from workload.registry import register

_JOINED = """sentiment_class, sentiment_score, created_at, text, word_count, hashtags_count,
  source_name, topic_name"""
_ADHOC = "created_at, source_name, topic_name, sentiment_class, sentiment_score, text"
_COUNTS = ", ".join(
    f"count(*) FILTER (sentiment_class = '{c}') AS {c}" for c in ("negative", "positive", "neutral")
)
_NEWEST = "ORDER BY created_at DESC, fact_id"


def _facts(tail: str) -> str:
    return f"WITH {sql.FACTS} {tail}"


# Joins

@register("join_star", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT f.sentiment_class, f.sentiment_score, f.created_at, f.text, f.word_count, f.hashtags_count,
  s.source_name, t.topic_name
FROM facts f JOIN dim_source s ON f.source_id = s.source_id JOIN dim_topic t ON f.topic_id = t.topic_id""")
def join_star(spark, sf_dir):
    return inputs.star(spark, sf_dir).joined().drop("fact_id")


@register("join_star_adhoc", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT f.created_at, s.source_name, t.topic_name, f.sentiment_class, f.sentiment_score, f.text
FROM facts f JOIN dim_source s ON f.source_id = s.source_id JOIN dim_topic t ON f.topic_id = t.topic_id
WHERE f.sentiment_class <> 'neutral'""")
def join_star_adhoc(spark, sf_dir):
    criteria = Criteria(sentiments=("negative", "positive"))
    return adhoc.adhoc_rows(inputs.star(spark, sf_dir), criteria).drop("fact_id")


@register("join_dim_date", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT f.fact_id, d.date_id, d.date_value, d."year", d."month", d."day"
FROM facts f JOIN dim_date d ON f.date_id = d.date_id""")
def join_dim_date(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    return star.with_calendar(star.facts.select("fact_id", "date_id"))


# Filters

@register("filter_drilldown", _facts(f"""SELECT {_JOINED} FROM facts
WHERE source_name = 'src3' AND topic_name = 'AI & Tech'"""))
def filter_drilldown(spark, sf_dir):
    criteria = drill_down(source="src3", topic="AI & Tech")
    return inputs.star(spark, sf_dir).joined(criteria).drop("fact_id")


@register("filter_negative", _facts(f"SELECT {_JOINED} FROM facts WHERE sentiment_class = 'negative'"))
def filter_negative(spark, sf_dir):
    criteria = Criteria(sentiments=("negative",))
    return inputs.star(spark, sf_dir).joined(criteria).drop("fact_id")


@register("filter_date_range", _facts("""SELECT fact_id, created_at FROM facts
WHERE created_at BETWEEN '2024-01-03 00:00:00' AND '2024-01-10 23:59:59'"""))
def filter_date_range(spark, sf_dir):
    criteria = Criteria(days=(date(2024, 1, 3), date(2024, 1, 10)))
    return inputs.star(spark, sf_dir).narrowed(criteria).select("fact_id", "created_at")


@register("filter_in_list", _facts("""SELECT fact_id, source_name, topic_name, sentiment_class FROM facts
WHERE source_name IN ('src1', 'src2', 'unknown') AND sentiment_class IN ('positive', 'neutral')
  AND topic_name IN ('Crypto', 'Gaming', 'Other')"""))
def filter_in_list(spark, sf_dir):
    criteria = Criteria(
        sources=("src1", "src2", "unknown"),
        sentiments=("positive", "neutral"),
        topics=("Crypto", "Gaming", "Other"),
    )
    joined = inputs.star(spark, sf_dir).joined(criteria)
    return joined.select("fact_id", "source_name", "topic_name", "sentiment_class")


@register("filter_ilike", _facts("SELECT fact_id, text FROM facts WHERE text ILIKE '%BitCoin W%'"))
def filter_ilike(spark, sf_dir):
    criteria = Criteria(keyword="BitCoin W")
    return inputs.star(spark, sf_dir).narrowed(criteria).select("fact_id", "text")


@register("filter_ilike_indexed", _facts("SELECT fact_id, text FROM facts WHERE text ILIKE '%BitCoin W%'"))
def filter_ilike_indexed(spark, sf_dir):
    """The same search where only folders are opened that hold all three-letter strings of the keyword."""
    tables = inputs.warehouse(spark, sf_dir)
    textindex.build(tables)
    criteria = Criteria(keyword="BitCoin W")
    return Star.searching(tables, criteria.keyword).narrowed(criteria).select("fact_id", "text")


_CRITERIA = Criteria(
    sources=("src0", "src1", "src2", "src3", "src4", "unknown"),
    topics=("Crypto", "AI & Tech", "Politics", "Other"),
    sentiments=("positive", "neutral"),
    days=(date(2024, 1, 2), date(2024, 12, 20)),
    keyword="THE",
)


@register("adhoc_builder", _facts(f"""SELECT {_ADHOC} FROM facts
WHERE created_at >= '2024-01-02' AND created_at < '2024-12-21' AND text ILIKE '%the%'
  AND source_name IN ('src0', 'src1', 'src2', 'src3', 'src4', 'unknown')
  AND topic_name IN ('Crypto', 'AI & Tech', 'Politics', 'Other')
  AND sentiment_class IN ('positive', 'neutral') {_NEWEST} LIMIT 1000"""))
def adhoc_builder(spark, sf_dir):
    return adhoc.adhoc(inputs.star(spark, sf_dir), _CRITERIA)


# Aggregates

@register("kpi_overview", _facts("""SELECT count(*) AS messages,
  round(count(*) FILTER (sentiment_class = 'positive') / count(*), 6) AS positive_rate,
  round(count(*) FILTER (sentiment_class = 'negative') / count(*), 6) AS negative_rate,
  round(avg(sentiment_score), 6) AS avg_score,
  round(avg(word_count) + 3 * avg(hashtags_count), 6) AS engagement FROM facts"""))
def kpi_overview(spark, sf_dir):
    return summary.kpis(summary.summarise(inputs.star(spark, sf_dir)))


def _register_rollups():
    for grain in dates.GRAINS:
        key = "rollup_sentiment_time" if grain == "Hour" else f"rollup_sentiment_{grain.lower()}"
        check = f"SELECT {sql.bucket('created_at', grain)} AS bucket, {_COUNTS} FROM facts GROUP BY ALL"

        @register(key, _facts(check))
        def rollup(spark, sf_dir, grain=grain):
            return summary.over_time(summary.summarise_by_time(inputs.star(spark, sf_dir), grain))


_register_rollups()


@register("rollup_long", _facts(f"""SELECT * FROM
(SELECT {sql.bucket('created_at', 'Day')} AS bucket, {_COUNTS} FROM facts GROUP BY ALL)
UNPIVOT (messages FOR sentiment IN (negative, positive, neutral))"""))
def rollup_long(spark, sf_dir):
    daily = summary.summarise_by_time(inputs.star(spark, sf_dir), "Day")
    return summary.as_long(summary.over_time(daily))


@register("class_distribution", _facts("""SELECT sentiment_class, count(*) AS messages,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM facts GROUP BY ALL"""))
def class_distribution(spark, sf_dir):
    return summary.class_shares(summary.summarise(inputs.star(spark, sf_dir)))


@register("row_count", _facts("SELECT count(*) AS row_count FROM facts"))
def row_count(spark, sf_dir):
    return summary.row_count(inputs.star(spark, sf_dir).facts)


@register("distinct_filter_values", _facts("""SELECT 'source_name' AS filter, v AS value FROM
  (SELECT DISTINCT source_name AS v FROM facts ORDER BY v LIMIT 100)
UNION ALL SELECT 'topic_name', v FROM (SELECT DISTINCT topic_name AS v FROM facts ORDER BY v LIMIT 100)"""))
def distinct_filter_values(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    sources = summary.distinct_values(star.sources, "source_name")
    topics = summary.distinct_values(star.topics, "topic_name")
    return sources.select(F.lit("source_name").alias("filter"), F.col("source_name").alias("value")).unionByName(
        topics.select(F.lit("topic_name").alias("filter"), F.col("topic_name").alias("value"))
    )


@register("rollup_calendar", _facts(f"""SELECT year(created_at)::BIGINT AS "year",
  month(created_at)::BIGINT AS "month", day(created_at)::BIGINT AS "day", count(*) AS messages, {_COUNTS}
FROM facts GROUP BY ALL"""))
def rollup_calendar(spark, sf_dir):
    return summary.calendar_rollup(inputs.star(spark, sf_dir))


# Rankings

@register("load_recent", _facts(f"SELECT {_JOINED} FROM facts {_NEWEST} LIMIT {rules.LOAD_LIMIT}"))
def load_recent(spark, sf_dir):
    return recent.load_recent(inputs.star(spark, sf_dir)).drop("fact_id")


@register("adhoc_latest", _facts(f"SELECT {_ADHOC} FROM facts {_NEWEST} LIMIT {rules.ADHOC_LIMIT}"))
def adhoc_latest(spark, sf_dir):
    return adhoc.adhoc(inputs.star(spark, sf_dir), Criteria())


@register("top_topics", _facts("""SELECT topic_name, count(*) AS messages FROM facts
GROUP BY ALL ORDER BY messages DESC, topic_name LIMIT 10"""))
def top_topics(spark, sf_dir):
    return summary.top_topics(summary.summarise(inputs.star(spark, sf_dir)))


@register("top_negative_topics", _facts("""SELECT topic_name, count(*) AS negative FROM facts
WHERE sentiment_class = 'negative' GROUP BY ALL ORDER BY negative DESC, topic_name LIMIT 5"""))
def top_negative_topics(spark, sf_dir):
    return summary.top_negative_topics(summary.summarise(inputs.star(spark, sf_dir)))


@register("top_negative_sources", _facts("""SELECT source_name, count(*) AS negative FROM facts
WHERE sentiment_class = 'negative' GROUP BY ALL ORDER BY negative DESC, source_name LIMIT 5"""))
def top_negative_sources(spark, sf_dir):
    return summary.top_negative_sources(summary.summarise(inputs.star(spark, sf_dir)))


@register("negative_examples", _facts(f"""SELECT created_at, source_name, topic_name, text FROM facts
WHERE sentiment_class = 'negative' {_NEWEST} LIMIT 10"""))
def negative_examples(spark, sf_dir):
    return recent.negative_examples(inputs.star(spark, sf_dir))


# Jobs

_TOP = """SELECT '{panel}' AS panel, NULL::TIMESTAMP AS bucket, {name} AS name, n::DOUBLE AS value, NULL AS text FROM
  (SELECT {name}, count(*) AS n FROM facts {where} GROUP BY ALL ORDER BY n DESC, {name} LIMIT {limit})"""
_NEGATIVE = "WHERE sentiment_class = 'negative'"


@register("job_bi", _facts(f""", measures AS (SELECT count(*) AS messages,
  count(*) FILTER (sentiment_class = 'positive') / count(*) AS positive_rate,
  count(*) FILTER (sentiment_class = 'negative') / count(*) AS negative_rate,
  avg(sentiment_score) AS avg_score, avg(word_count) + 3 * avg(hashtags_count) AS engagement FROM facts)
SELECT 'kpis' AS panel, NULL::TIMESTAMP AS bucket, name, round(value, 6) AS value,
  NULL::VARCHAR AS text FROM
  (SELECT messages::DOUBLE AS messages, positive_rate, negative_rate, avg_score, engagement FROM measures)
  UNPIVOT (value FOR name IN (messages, positive_rate, negative_rate, avg_score, engagement))
UNION ALL SELECT 'over_time', bucket, sentiment, n::DOUBLE, NULL FROM
  (SELECT {sql.bucket('created_at', 'Hour')} AS bucket, {_COUNTS} FROM facts GROUP BY ALL)
  UNPIVOT (n FOR sentiment IN (negative, positive, neutral))
UNION ALL SELECT 'class_shares', NULL, sentiment_class, round(count(*) / sum(count(*)) OVER (), 6), NULL
  FROM facts GROUP BY sentiment_class
UNION ALL {_TOP.format(panel='top_topics', name='topic_name', where='', limit=10)}
UNION ALL {_TOP.format(panel='top_negative_topics', name='topic_name', where=_NEGATIVE, limit=5)}
UNION ALL {_TOP.format(panel='top_negative_sources', name='source_name', where=_NEGATIVE, limit=5)}
UNION ALL SELECT 'negative_examples', created_at, source_name || ' / ' || topic_name, NULL, text
  FROM (SELECT * FROM facts {_NEGATIVE} {_NEWEST} LIMIT 10)"""))
def job_bi(spark, sf_dir):
    """The page's panels, one under the other."""
    panels = bi.page(inputs.star(spark, sf_dir))
    kpis = panels["kpis"]
    flat = {
        "kpis": kpis.select(*[F.col(c).cast("double").alias(c) for c in kpis.columns])
        .unpivot([], kpis.columns, "name", "value")
        .withColumn("bucket", F.lit(None).cast("timestamp")),
        "over_time": panels["over_time"].selectExpr("bucket", "sentiment AS name", "messages AS value"),
        "class_shares": panels["class_shares"].selectExpr(
            "CAST(NULL AS TIMESTAMP) AS bucket", "sentiment_class AS name", "share AS value"
        ),
        "negative_examples": panels["negative_examples"].selectExpr(
            "created_at AS bucket",
            "source_name || ' / ' || topic_name AS name",
            "CAST(NULL AS DOUBLE) AS value",
            "text",
        ),
    }
    for panel, name, measure in (
        ("top_topics", "topic_name", "messages"),
        ("top_negative_topics", "topic_name", "negative"),
        ("top_negative_sources", "source_name", "negative"),
    ):
        flat[panel] = panels[panel].selectExpr(
            "CAST(NULL AS TIMESTAMP) AS bucket", f"{name} AS name", f"{measure} AS value"
        )
    rows = [
        panel.select(
            F.lit(name).alias("panel"), "bucket", "name", F.col("value").cast("double").alias("value"),
            F.col("text") if "text" in panel.columns else F.lit(None).cast("string").alias("text"),
        )
        for name, panel in flat.items()
    ]
    page = rows[0]
    for more in rows[1:]:
        page = page.unionByName(more)
    return page


@register("job_adhoc", _facts("""SELECT topic_name, sentiment_class, count(*) AS messages,
  round(avg(word_count), 6) AS avg_words FROM facts GROUP BY ALL"""))
def job_adhoc(spark, sf_dir):
    """Free SQL over the star schema's views."""
    return adhoc.raw_sql(
        inputs.star(spark, sf_dir),
        """SELECT t.topic_name, f.sentiment_class, count(*) AS messages, avg(f.word_count) AS avg_words
           FROM fact_sentiment f JOIN dim_topic t ON f.topic_id = t.topic_id
           GROUP BY t.topic_name, f.sentiment_class""",
    )
