import io
import random

from ratewise.session import scratch_path
from ratewise.sources import log_source

SEGMENTS = {"000": "a\nbb\n\n", "001": "ccc é\n", "002": "", "003": "dd\ne" * 20 + "\n"}
LINES = [x for t in SEGMENTS.values() for x in t.splitlines()]


def put(tmp_path, more=()):
    for name, t in (more or SEGMENTS).items():
        (tmp_path / name).write_text(t)


def reader(tmp_path, **options):
    return log_source.LineLogReader({"path": str(tmp_path), **options})


def read(r, start, end):
    return [line for p in r.partitions(start, end) for (line,) in r.read(p)]


def test_any_cut_gives_each_line_once():
    rng = random.Random(2)
    text = "".join("x" * rng.randrange(5) + "\n" for _ in range(40)) + "tail without end"
    data = text.encode()
    for _ in range(50):
        cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(rng.randrange(9)))})
        got = [x for a, z in zip(cuts, cuts[1:]) for x in log_source.lines_in(io.BytesIO(data), a, z)]
        assert got == text.split("\n")


def test_limit_replay_and_latest(tmp_path):
    put(tmp_path)
    (tmp_path / "_hidden").write_text("no\n")
    r = reader(tmp_path, startingOffsets="earliest", maxBytesPerTrigger="7", splitBytes="3")
    places = [r.initialOffset()]
    while (at := r.latestOffset()) != places[-1]:
        places.append(at)
    assert len(places) > 8 and [x for a, z in zip(places, places[1:]) for x in read(r, a, z)] == LINES
    # any range again, also by another reader
    again = reader(tmp_path, splitBytes="1000")
    assert read(again, places[2], places[5]) == [x for a, z in zip(places[2:5], places[3:6]) for x in read(r, a, z)]
    late = reader(tmp_path)
    assert late.initialOffset() == late.latestOffset() == places[-1]
    put(tmp_path, {"004": "new\n"})
    assert read(late, places[-1], late.latestOffset()) == ["new"]


def test_a_group_goes_on_where_it_was(tmp_path):
    put(tmp_path)
    first = reader(tmp_path, startingOffsets="earliest", maxBytesPerTrigger="7", group="g")
    a, b = first.initialOffset(), first.latestOffset()
    head = read(first, a, b)
    second = reader(tmp_path, startingOffsets="earliest", group="g")
    assert head + read(second, b, second.latestOffset()) == LINES


def test_stream_restarts_without_loss(spark):
    base = scratch_path(spark, "t-log").removeprefix("file:")
    spark.createDataFrame([(f"line {i}",) for i in range(500)], "value string").repartition(3).write.text(f"{base}/log")

    def run(seen_enough):
        lines = log_source.log_lines(spark, f"{base}/log", "earliest", "g", 900, split_bytes=250)
        q = lines.writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt").trigger(processingTime="0 seconds").start(f"{base}/out")
        try:
            while not seen_enough(q):
                q.awaitTermination(0.2)
        finally:
            q.stop()
        return q

    q = run(lambda q: len(q.recentProgress) >= 2)
    assert q.exception() is None
    run(lambda q: q.processAllAvailable() is None)
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r["value"] for r in out.collect()) == sorted(f"line {i}" for i in range(500))
