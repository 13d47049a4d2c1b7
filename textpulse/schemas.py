"""Declared schemas; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _LONG, _INT, _TIME = StringType(), LongType(), IntegerType(), TimestampType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


MESSAGE = _struct(source=_STRING, text=_STRING, created_at=_STRING)

# Current messages as a table for SQL users; the text is the key.
RAW_DATA = _struct(id=_STRING, source=_STRING, text=_STRING, created_at=_STRING)

# Append-only staging log. ``run``, ``batch_id`` and ``kind`` are partition folders; ``arrival``, ``part``,
# ``position`` and ``line`` say in which order messages of one batch came.
STAGING_LOG = _struct(
    message_key=_STRING, source=_STRING, text=_STRING, created_at=_STRING, value=_STRING,
    arrival=_LONG, part=_STRING, position=_LONG, line=_LONG, run=_STRING, batch_id=_LONG, kind=_STRING,
)

TRAINING = _struct(id=_LONG, entity=_STRING, sentiment=_STRING, text=_STRING)

WIKI_CHANGE = _struct(server_name=_STRING, type=_STRING, title=_STRING, comment=_STRING)

TWEET_PAGE = _struct(tweets=ArrayType(_struct(text=_STRING, full_text=_STRING)))

DIM_SOURCE = _struct(source_id=_LONG, source_name=_STRING, source_type=_STRING, load_dt=_TIME)
DIM_DATE = _struct(
    date_id=_LONG, date_value=DateType(), year=_INT, month=_INT, day=_INT, load_dt=_TIME
)
DIM_TOPIC = _struct(topic_id=_LONG, topic_name=_STRING, load_dt=_TIME)

# ``date_id`` is the partition folder. ``fact_id`` is the message key, so reloads add nothing.
FACT = _struct(
    fact_id=_STRING, source_id=_LONG, topic_id=_LONG, text=_STRING,
    sentiment_class=_STRING, sentiment_score=FloatType(), word_count=_INT, hashtags_count=_INT,
    created_at=_TIME, date_id=_LONG,
)

# Beside each fact folder: filters over its ids, and its measures per hour. Then the staged batches that loads have taken in.
KEY_FILTERS = _struct(level=_INT, word=_LONG, bits=_LONG, date_id=_LONG)
FACT_HOURS = _struct(
    source_id=_LONG, topic_id=_LONG, sentiment_class=_STRING, created_at=_TIME, messages=_LONG,
    score_sum=DoubleType(), word_sum=_LONG, hashtag_sum=_LONG, date_id=_LONG,
)
LEDGER = _struct(run=_STRING, batch_id=_LONG, load=_STRING)

METRICS = _struct(
    accuracy=DoubleType(), precision=DoubleType(), recall=DoubleType(), f1=DoubleType(),
    confusion_matrix=ArrayType(ArrayType(_LONG)),
)

# Live roll-up, one folder per stream and micro-batch.
LIVE_COUNTS = _struct(bucket=_TIME, category=_STRING, messages=_LONG, run=_STRING, batch_id=_LONG)
LIVE_ADDITIONS = _struct(
    bucket=_TIME, category=_STRING, messages=_LONG, late=_LONG, newest=_TIME, run=_STRING, batch_id=_LONG
)

STAR_TABLES = {
    "dim_source": DIM_SOURCE,
    "dim_date": DIM_DATE,
    "dim_topic": DIM_TOPIC,
    "fact_sentiment": FACT,
}
