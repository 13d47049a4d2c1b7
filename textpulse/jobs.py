"""Command line for spark-submit: python -m textpulse.jobs <job> --help

Sessions, masters, Kafka secrets and the shared scratch folder come from Spark's configuration.
"""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from textpulse import rules, storage
from textpulse.functions.dates import GRAINS
from textpulse.operators import recent, staging, summary
from textpulse.operators import textindex
from textpulse.operators.star import Criteria, Star
from textpulse.plans import adhoc, bi, etl, training
from textpulse.session import build_session, use_utc
from textpulse.sinks import publish
from textpulse.sources import feeds, files, messages
from textpulse.sources.models import load_metrics, load_model
from textpulse.sources.warehouse import Warehouse
from textpulse.streaming.ingest import ingest


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")


def _star(spark: SparkSession, args: argparse.Namespace) -> Star:
    return Star.of(Warehouse(spark, args.warehouse))


def _criteria(args: argparse.Namespace) -> Criteria:
    days = (args.first_day, args.last_day) if args.first_day and args.last_day else None
    return Criteria(
        sources=tuple(args.source),
        topics=tuple(args.topic),
        sentiments=tuple(args.sentiment),
        days=days,
        keyword=args.keyword,
    )


def publish_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed feeds to the topic: a tweet archive, encyclopedia changes, tweet search pages."""
    feed = {
        "tweets": lambda: files.archived_tweets(spark, args.input),
        "changes": lambda: feeds.wiki_messages(
            feeds.parse_changes(spark.read.text(args.input)), args.run_ts
        ),
        "search": lambda: feeds.search_messages(spark.read.text(args.input), args.run_ts),
    }[args.feed]()
    if args.servers:
        publish.to_kafka(feed, args.servers, args.topic_path)
    else:
        publish.to_files(feed, args.topic_path)


def ingest_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Topic to staging log, until stopped or, with --drain, until nothing is left."""
    if args.servers:
        stream = messages.kafka_stream(spark, args.servers, args.topic_path)
    else:
        stream = messages.file_stream(spark, args.topic_path)
    trigger = {"availableNow": True} if args.drain else None
    ingest(stream, args.log, args.checkpoint, trigger).awaitTermination()


def train_job(spark: SparkSession, args: argparse.Namespace) -> None:
    training.train(spark, args.dataset, args.model, args.metrics, args.split)
    show(load_metrics(spark, args.metrics))


def etl_job(spark: SparkSession, args: argparse.Namespace) -> None:
    scorer = etl.model_scorer(load_model(args.model), args.clean)
    warehouse = Warehouse(spark, args.warehouse)
    etl.load(spark, args.log, warehouse, scorer, args.run_ts, args.since_batch, args.since_run)


def page_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Overview and diagnostics, panel by panel, over all facts or the newest ones."""
    star = Star.rolled_up(Warehouse(spark, args.warehouse))
    if args.limit:
        star = recent.limited(star, args.limit)
    scratch = storage.fresh_dir(spark, "page")
    try:
        for name, panel in bi.page(star, args.grain, _criteria(args), scratch).items():
            print(name)
            deliver(panel, args.output and f"{args.output}/{name}")
    finally:
        storage.delete(spark, scratch)


def adhoc_job(spark: SparkSession, args: argparse.Namespace) -> None:
    criteria = _criteria(args)
    star = Star.searching(Warehouse(spark, args.warehouse), criteria.keyword) if criteria.keyword else _star(spark, args)
    deliver(adhoc.adhoc(star, criteria, args.limit), args.output, args.limit)


def index_job(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"indexed {textindex.build(Warehouse(spark, args.warehouse))} folders")


def recent_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """The newest joined rows, written as Parquet."""
    rows = recent.load_recent(_star(spark, args), args.limit, _criteria(args))
    rows.drop("fact_id").write.parquet(args.output)


def values_job(spark: SparkSession, args: argparse.Namespace) -> None:
    star = _star(spark, args)
    show(summary.distinct_values(star.sources, "source_name"), rules.FILTER_VALUES_LIMIT)
    show(summary.distinct_values(star.topics, "topic_name"), rules.FILTER_VALUES_LIMIT)


def sql_job(spark: SparkSession, args: argparse.Namespace) -> None:
    deliver(adhoc.raw_sql(_star(spark, args), args.statement), args.output)


SCREEN_ROWS, SCREEN_WIDTH = 100, 60


def deliver(df: DataFrame, output: str | None, n: int = SCREEN_ROWS) -> None:
    """Whole results as Parquet where a folder is given, else a view on the screen."""
    if output:
        df.write.parquet(output)
    else:
        show(df, n)


def show(df: DataFrame, n: int = SCREEN_ROWS) -> None:
    df.show(n, truncate=SCREEN_WIDTH)
    print(f"At most {n} rows, cells cut at {SCREEN_WIDTH} characters; --output, where offered, writes all.")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="textpulse.jobs")
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, run, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def criteria(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        for many in ("source", "topic", "sentiment"):
            sub.add_argument(f"--{many}", action="append", default=[])
        for day in ("first-day", "last-day"):
            sub.add_argument(f"--{day}", type=date.fromisoformat)
        sub.add_argument("--keyword", default="")
        return sub

    sub = job("publish", publish_job, "input", "topic-path")
    sub.add_argument("--feed", choices=["tweets", "changes", "search"], required=True)
    sub.add_argument("--servers", help="Kafka servers; without them the topic is a folder")
    sub.add_argument("--run-ts", default=_now())

    sub = job("ingest", ingest_job, "topic-path", "log", "checkpoint")
    sub.add_argument("--servers", help="Kafka servers; without them the topic is a folder")
    sub.add_argument("--drain", action="store_true")

    sub = job("train", train_job, "dataset", "model", "metrics")
    sub.add_argument("--split", choices=["hash", "random"], default="hash")

    sub = job("etl", etl_job, "log", "warehouse", "model")
    sub.add_argument("--run-ts", default=_now())
    sub.add_argument("--since-batch", type=int)
    sub.add_argument("--since-run", default=staging.LOADS, help="run folder that --since-batch counts in")
    sub.add_argument("--clean", choices=["train", "serve"], default="train")

    sub = criteria(job("page", page_job, "warehouse"))
    sub.add_argument("--grain", choices=list(GRAINS), default="Hour")
    sub.add_argument("--limit", type=int)
    sub.add_argument("--output", help="folder for whole panels")
    job("index", index_job, "warehouse")
    sub = criteria(job("adhoc", adhoc_job, "warehouse"))
    sub.add_argument("--limit", type=int, default=rules.ADHOC_LIMIT)
    sub.add_argument("--output", help="folder for all rows")
    criteria(job("recent", recent_job, "warehouse", "output")).add_argument(
        "--limit", type=int, default=rules.LOAD_LIMIT
    )
    job("values", values_job, "warehouse")
    sub = job("sql", sql_job, "warehouse")
    sub.add_argument("statement", nargs="?", default=adhoc.DEFAULT_SQL)
    sub.add_argument("--output", help="folder for all rows")
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(use_utc(spark or build_session(f"textpulse-{args.job}")), args)


if __name__ == "__main__":
    main()
