"""Command line: ``python -m ratewise <job> ...`` runs one of the end-to-end jobs.

  load        --movies PATH --ratings PATH --base DIR
  statistics  --base DIR
  offline     --base DIR [--rank N --iterations N --reg X --k N]
  tune        --base DIR [--ranks 50,100,200,300 --lambdas 0.01,0.1,1]
  stream      --base DIR --checkpoint DIR (--kafka SERVERS --topic T | --text-dir DIR)
              [--group NAME --max-per-batch N] [--recent PATH] [--interval "2 seconds" | --available-now]

``--recent`` names stored recent lists (uid int, items array<string> of
'mid:score', newest first); without it the newest stored ratings are used.

The session comes from ``spark-submit`` / the environment; only settings
that are not configured get the defaults of ``ratewise.session``.
"""

from __future__ import annotations

import argparse

from ratewise.operators import als, recommend
from ratewise.plans import jobs
from ratewise.session import get_session
from ratewise.sources import text


def _floats(s: str) -> tuple[float, ...]:
    return tuple(float(x) for x in s.split(",") if x)


def _ints(s: str) -> tuple[int, ...]:
    return tuple(int(x) for x in s.split(",") if x)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ratewise")
    sub = p.add_subparsers(dest="job", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--movies", required=True)
    ld.add_argument("--ratings", required=True)
    for name in ("load", "statistics", "offline", "tune", "stream"):
        sp = ld if name == "load" else sub.add_parser(name)
        sp.add_argument("--base", required=True)
        if name == "offline":
            sp.add_argument("--rank", type=int, default=als.REFERENCE_RANK)
            sp.add_argument("--iterations", type=int, default=als.REFERENCE_ITERATIONS)
            sp.add_argument("--reg", type=float, default=als.REFERENCE_LAMBDA)
            sp.add_argument("--k", type=int, default=recommend.USER_TOP_K)
        if name == "tune":
            sp.add_argument("--ranks", type=_ints, default=als.REFERENCE_GRID_RANKS)
            sp.add_argument("--lambdas", type=_floats, default=als.REFERENCE_GRID_LAMBDAS)
        if name == "stream":
            sp.add_argument("--checkpoint", required=True)
            sp.add_argument("--kafka")
            sp.add_argument("--topic")
            sp.add_argument("--group")
            sp.add_argument("--max-per-batch", type=int)
            sp.add_argument("--text-dir")
            sp.add_argument("--recent")
            sp.add_argument("--ratings-dir", help="folder of rating lines that feed the profiles kept in the stream's state")
            sp.add_argument("--interval", default="2 seconds")
            sp.add_argument("--available-now", action="store_true")
    a = p.parse_args(argv)
    spark = get_session(app_name=f"ratewise-{a.job}")
    if a.job == "load":
        jobs.load_job(spark, a.movies, a.ratings, a.base)
    elif a.job == "statistics":
        jobs.statistics_job(spark, a.base)
    elif a.job == "offline":
        jobs.offline_job(spark, a.base, rank=a.rank, max_iter=a.iterations, reg=a.reg, k=a.k)
    elif a.job == "tune":
        best = jobs.tuning_job(spark, a.base, ranks=a.ranks, lambdas=a.lambdas).first()
        print(f"best rank={best['rank']} lambda={best['lambda']} rmse={best['rmse']}")
    elif a.job == "stream":
        if a.kafka:
            lines = text.kafka_lines(spark, a.kafka, a.topic, group=a.group, max_per_batch=a.max_per_batch)
        elif a.text_dir:
            lines = text.text_stream_lines(spark, a.text_dir)
        else:
            p.error("stream needs --kafka/--topic or --text-dir")
        trigger = {"availableNow": True} if a.available_now else {"processingTime": a.interval}
        if a.ratings_dir:
            jobs.profile_streaming_job(spark, a.base, lines, text.text_stream_lines(spark, a.ratings_dir), a.checkpoint, trigger=trigger).awaitTermination()
            return
        # read anew for every micro-batch
        recent = (lambda: text.parse_recent_lists(spark.read.parquet(a.recent))) if a.recent else None
        jobs.streaming_job(spark, a.base, lines, a.checkpoint, recent=recent, trigger=trigger).awaitTermination()


if __name__ == "__main__":
    main()
