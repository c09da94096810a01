"""Command line: ``spark-submit --packages … run.py <job> …`` or ``python -m roompulse <job> …``.

Connections come from the environment variables BROKER, TOPIC, ELASTIC, ELASTIC_PORT and INDEX.
"""

from __future__ import annotations

import argparse

from roompulse.config import Settings
from roompulse.functions.logs import LOG_PATTERNS
from roompulse.operators.comfort_model import load
from roompulse.operators.occupancy import DEVICES_PER_PERSON, SLIDE_SECONDS, WATERMARK, WINDOW_SECONDS
from roompulse.plans import jobs
from roompulse.session import STATE_PARTITIONS, build_session
from roompulse.streaming.watch import StreamWatch
from roompulse.workspace import shared_root


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roompulse")
    top.add_argument("--checkpoints", help="checkpoint folder; default: below spark.checkpoint.dir")
    top.add_argument("--stream-format", default="kafka")
    top.add_argument("--stream-root", help="folder of the topics for a file format")
    top.add_argument("--index-format", default="es")
    top.add_argument("--index-root", help="folder of the indices for a file format")
    top.add_argument("--starting-offsets", help="where a stream without a checkpoint begins: earliest, latest or JSON")
    top.add_argument("--min-partitions", type=int, help="tasks that read a topic, at least")
    top.add_argument("--state-partitions", type=int, help="partitions of a stream's state, fixed with its checkpoint")
    top.add_argument("--max-offsets", type=int, help="messages per micro-batch at most")
    top.add_argument("--max-bytes", type=int, help="bytes of files per micro-batch at most")
    top.add_argument("--follow", action="store_true", help="read what is appended to log files, not only new files")
    top.add_argument("--once-within", help="read a message that is published again within this time once, e.g. '1 hour'")
    top.add_argument("--watch", help="folder for failures, dropped rows and lost messages of the streams")
    top.add_argument("--quiet", action="store_true", help="no console output of streams")
    top.add_argument("--once", action="store_true", help="process what is there and stop")
    job = top.add_subparsers(dest="job", required=True)
    for name in ("ship-log", "route-log"):
        job.add_parser(name).add_argument("logs")
    job.add_parser("publish-scans").add_argument("path")
    convert = job.add_parser("convert-scans")
    convert.add_argument("path")
    convert.add_argument("logs")
    job.add_parser("dump-topic").add_argument("path")
    for name in ("ingest-environment", "ingest-devices"):
        job.add_parser(name)
    rooms = job.add_parser("occupancy")
    rooms.add_argument("--form", choices=sorted(jobs.OCCUPANCY_FORMS), default="approx")
    rooms.add_argument("--window", type=int, default=WINDOW_SECONDS, help="seconds")
    rooms.add_argument("--slide", type=int, default=SLIDE_SECONDS, help="seconds")
    rooms.add_argument("--watermark", default=WATERMARK)
    rooms.add_argument("--devices-per-person", type=float, default=DEVICES_PER_PERSON)
    rooms.add_argument("--show-windows", action="store_true", help="all windows to the console; keeps them all in state")
    job.add_parser("newest-occupancy")
    panes = job.add_parser("keep-panes")
    panes.add_argument("path")
    panes.add_argument("--watermark", default=WATERMARK)
    kept = job.add_parser("pane-occupancy")
    kept.add_argument("path")
    kept.add_argument("--window", type=int, default=WINDOW_SECONDS, help="seconds")
    kept.add_argument("--slide", type=int, default=SLIDE_SECONDS, help="seconds")
    late = job.add_parser("keep-late")
    late.add_argument("path")
    late.add_argument("--watermark", default=WATERMARK)
    label = job.add_parser("label-log")
    label.add_argument("logs")
    label.add_argument("path")
    fit = job.add_parser("train")
    fit.add_argument("csv")
    fit.add_argument("--save")
    fit.add_argument("--rejects", help="folder for rows without all features or a label")
    batch = job.add_parser("score-file")
    batch.add_argument("csv")
    batch.add_argument("model")
    batch.add_argument("--rejects", help="folder for rows without all features")
    batch.add_argument("--features", nargs="*", help="the order of the features of a model saved without its assembler")
    live = job.add_parser("live-scores")
    source = live.add_mutually_exclusive_group(required=True)
    source.add_argument("--model", help="folder of a saved model")
    source.add_argument("--train", help="training CSV to fit at start")
    live.add_argument("--features", nargs="*", help="the order of the features of a model saved without its assembler")
    live.add_argument("--strict", action="store_true", help="fail on readings with missing values")
    parse = job.add_parser("parse-logs")
    parse.add_argument("logs")
    parse.add_argument("format", choices=[*LOG_PATTERNS, "logfmt", "json", "docker"])
    parse.add_argument("path")
    parse.add_argument("--fields", nargs="*", help="keys of logfmt or JSON lines to keep")
    export = job.add_parser("export")
    export.add_argument("index", nargs="+")
    export.add_argument("path")
    export.add_argument("--first", action="store_true", help="only the first 1,000 documents")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    settings = Settings.from_env(
        stream_format=args.stream_format, stream_root=args.stream_root,
        index_format=args.index_format, index_root=args.index_root,
        starting_offsets=args.starting_offsets or ("earliest" if args.once else None),
        min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets, max_bytes_per_trigger=args.max_bytes,
        follow_appended=args.follow, once_within=args.once_within,
    )
    conf = settings.index_options()
    if args.state_partitions:
        conf |= {STATE_PARTITIONS: str(args.state_partitions)}
    spark = build_session("roompulse", conf)
    checkpoints = args.checkpoints or f"{shared_root(spark)}/roompulse"
    trigger = {"availableNow": True} if args.once else None
    console = not args.quiet
    watch = StreamWatch(spark, args.watch).start() if args.watch else None

    if args.job == "ship-log":
        jobs.ship_log(spark, settings, args.logs, checkpoints, trigger)
    elif args.job == "route-log":
        jobs.route_log(spark, settings, args.logs, checkpoints, trigger)
    elif args.job == "publish-scans":
        jobs.publish_scans(spark, settings, args.path)
    elif args.job == "convert-scans":
        jobs.convert_scans(spark, args.path, args.logs)
    elif args.job == "dump-topic":
        jobs.dump_topic(spark, settings, args.path)
    elif args.job == "ingest-environment":
        jobs.ingest_environment(spark, settings, checkpoints, console, trigger)
    elif args.job == "ingest-devices":
        jobs.ingest_devices(spark, settings, checkpoints, console, trigger)
    elif args.job == "occupancy":
        jobs.occupancy(
            spark, settings, checkpoints, args.show_windows, trigger, args.form, watermark=args.watermark,
            window_seconds=args.window, slide_seconds=args.slide,
            devices_per_person=args.devices_per_person,
        )
    elif args.job == "newest-occupancy":
        jobs.newest_occupancy(spark, settings, checkpoints).show()
    elif args.job == "keep-panes":
        jobs.keep_panes(spark, settings, args.path, checkpoints, trigger, watermark=args.watermark)
    elif args.job == "pane-occupancy":
        jobs.pane_occupancy(spark, args.path, window_seconds=args.window, slide_seconds=args.slide).show()
    elif args.job == "keep-late":
        jobs.keep_late(spark, settings, args.path, checkpoints, args.watermark, trigger)
    elif args.job == "label-log":
        jobs.label_log(spark, settings, args.logs, args.path, checkpoints, trigger)
    elif args.job == "train":
        _, report, saved = jobs.train_model(spark, args.csv, args.save, args.rejects)
        report.confusion.show()
        print(f"area under ROC {report.auc}, accuracy {report.accuracy}, rejected {report.rejected}, saved {saved}")
    elif args.job == "score-file":
        scored, confusion, rejected = jobs.score_file(spark, args.csv, args.model, args.rejects, args.features)
        confusion.show()
        print(f"{rejected.count()} rows rejected")
        scored.show(100)
    elif args.job == "live-scores":
        model = load(args.model, args.features) if args.model else jobs.train_model(spark, args.train)[0]
        jobs.live_scores(spark, settings, model, checkpoints, args.strict, console, trigger)
    elif args.job == "parse-logs":
        jobs.parse_logs(spark, args.logs, args.format, args.path, args.fields)
    elif args.job == "export":
        if len(args.index) == 1:
            print(f"{jobs.export_index(spark, settings, args.index[0], args.path, args.first)} hits")
        else:
            for index, hits in jobs.export_indices(spark, settings, args.index, args.path, args.first).items():
                print(f"{index}: {hits} hits")

    # A failure of any stream ends the job; with --once each stream ends by itself.
    try:
        if args.once:
            for query in spark.streams.active:
                query.awaitTermination()
        elif spark.streams.active:
            spark.streams.awaitAnyTermination()
    finally:
        if watch is not None:
            watch.stop()


if __name__ == "__main__":
    main()
