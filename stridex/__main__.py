"""Command line jobs (the reference's runnable programs, re-aimed as Spark jobs):

  python -m stridex train   --training PATH --tree-model PATH --forest-model PATH [--user-cap N] ...
  python -m stridex predict --live PATH --model PATH --out PATH [--users u1,u2] [--n 100]
  python -m stridex stream  --live PATH --model PATH --out PATH [--checkpoint PATH] [--every "5 seconds"]

Under spark-submit the session comes from the submit configuration; paths are any Spark-readable location.
"""
from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import apply_recommended
from .schema import DEFAULT_GAP, DEFAULT_LATEST_N, DEFAULT_WIDTH


def _model(path: str, kind: str):
    from .sources.models import load_forest, load_tree
    return load_forest(path) if kind == "forest" else load_tree(path)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stridex")
    sub = p.add_subparsers(dest="job", required=True)

    t = sub.add_parser("train", help="samples -> labelled points -> tree and forest -> report (C1)")
    t.add_argument("--training", required=True)
    t.add_argument("--format", default="parquet")
    t.add_argument("--tree-model", required=True)
    t.add_argument("--forest-model", required=True)
    t.add_argument("--gap", type=int, default=DEFAULT_GAP)
    t.add_argument("--width", type=int, default=DEFAULT_WIDTH)
    t.add_argument("--anchor", choices=["stop", "start"], default="stop")
    t.add_argument("--user-cap", type=int, default=0, help="first users by id only; 0 = all users")
    t.add_argument("--method", choices=["auto", "chunk", "range"], default="auto", help="sessionization")
    t.add_argument("--partitions", type=int, default=0, help="of the fit, part of the forest's definition; 0: by the points")
    t.add_argument("--split", choices=["hash", "random"], default="hash")
    t.add_argument("--seed", type=int, default=12345)

    for name, help_ in [("predict", "newest N samples -> prediction rows, once (C2, R3/R4)"),
                        ("stream", "continuous prediction (C3, R5)")]:
        q = sub.add_parser(name, help=help_)
        q.add_argument("--live", required=True)
        q.add_argument("--format", default="parquet")
        q.add_argument("--model", required=True)
        q.add_argument("--kind", choices=["forest", "tree"], default="forest")
        q.add_argument("--vote", choices=["majority", "average"], default="majority")
        q.add_argument("--out", required=True)
        q.add_argument("--n", type=int, default=DEFAULT_LATEST_N)
        if name == "predict":
            q.add_argument("--users", default="", help="comma-separated user ids (default: every user)")
            q.add_argument("--run", default="", help="publish once under this id, however often the job is run")
        else:
            q.add_argument("--checkpoint", default="", help="default: in the output folder, so a restart goes on")
            q.add_argument("--every", default="5 seconds", help='trigger interval, or "once" for available data')
            q.add_argument("--stateless", action="store_true", help="ST1: re-read the table per batch")
            q.add_argument("--console", type=int, default=0, help="print the first k predictions of each batch")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    spark = apply_recommended(spark or SparkSession.builder.appName(f"stridex-{args.job}").getOrCreate())
    if args.job == "train":
        from .plans.training import train
        from .sources.readers import read_training
        trained = train(read_training(spark, args.training, args.format), gap=args.gap, width=args.width,
                        anchor=args.anchor, user_cap=args.user_cap or None, how=args.split, seed=args.seed,
                        method=args.method, partitions=args.partitions or None, tree_path=args.tree_model, forest_path=args.forest_model)
        report = trained.report()
        report.show(truncate=False)
        return report
    from .sources.readers import read_live, stream_live
    if args.job == "predict":
        model = _model(args.model, args.kind)
        from .plans.prediction import predict_and_store
        users = [u for u in args.users.split(",") if u] or None
        return predict_and_store(read_live(spark, args.live, args.format), model, args.out, n=args.n,
                                 users=users, vote=args.vote, run=args.run or None)
    from .streaming import start_prediction_stream
    from .sources.models import PublishedModel, latest, load_forest, load_tree
    model = (PublishedModel(args.model, load_forest if args.kind == "forest" else load_tree) if latest(args.model)
             else _model(args.model, args.kind))              # a published model is looked up before each batch
    trigger = {"availableNow": True} if args.every == "once" else {"processingTime": args.every}
    q = start_prediction_stream(stream_live(spark, args.live, args.format), model, args.out,
                                args.checkpoint or f"{args.out.rstrip('/')}/_checkpoint",
                                table=lambda: read_live(spark, args.live, args.format), n=args.n,
                                stateful=not args.stateless, vote=args.vote, trigger=trigger,
                                console=args.console)
    q.awaitTermination()
    return q


if __name__ == "__main__":
    main(sys.argv[1:])
