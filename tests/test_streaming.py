import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from letbook.operators import dedup
from letbook.streaming import jobs

AT = dt.datetime(2024, 5, 1)
SCHEMA = "source string, flatshare_id string, postcode string, url string, fetched_at timestamp, page_idx int, pos int"


def batch(spark, start, n, ids=7):
    return spark.createDataFrame(
        [("s", str(i % ids), f"P{i % 2}", f"u{i}", AT + dt.timedelta(seconds=i), 0, i) for i in range(start, start + n)],
        SCHEMA,
    )


@pytest.fixture
def inbox(spark, tmp_path):
    path = str(tmp_path / "inbox")

    def add(rows):
        rows.coalesce(1).write.mode("append").parquet(path)

    def stream(files=1):
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(path)

    return add, stream


def test_dedup_over_batches_equals_one_batch(spark, inbox, tmp_path):
    add, stream = inbox
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    first, second = batch(spark, 0, 40, ids=5), batch(spark, 40, 60, ids=9)
    add(first)
    jobs.dedup_exact(stream(), out, checkpoint)
    add(second)
    add(batch(spark, 100, 3, ids=9))
    jobs.dedup_exact(stream(), out, checkpoint)
    got = spark.read.schema(SCHEMA).parquet(out).collect()
    want = dedup.first_listing(batch(spark, 0, 40, 5).union(second).union(batch(spark, 100, 3, 9))).collect()
    assert sorted((r.flatshare_id, r.postcode, r.url) for r in got) == sorted(
        (r.flatshare_id, r.postcode, r.url) for r in want
    )


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = batch(spark, 0, 10)
    jobs.write_batch(rows, path, 0)
    jobs.write_batch(rows, path, 1)
    jobs.write_batch(rows, path, 1)
    assert spark.read.schema(SCHEMA).parquet(path).count() == 20
    assert jobs.read_batches(rows, path, before=1).count() == 10
    assert jobs.read_batches(rows, path, before=0).count() == 0
    assert jobs.read_batches(rows, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("delay", [None, "1 day"])
@pytest.mark.parametrize("spread", [None, ["url"]])
def test_dedup_in_state(spark, inbox, tmp_path, spread, delay):
    add, stream = inbox
    add(batch(spark, 0, 30, ids=3))
    add(batch(spark, 30, 30, ids=4))
    query = (
        jobs.dedup_stateful(stream(), delay=delay, spread_by=spread)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("flatshare_id", "postcode").collect()
    assert sorted(map(tuple, got)) == sorted({(str(i % k), f"P{i % 2}") for k, a in ((3, 0), (4, 30)) for i in range(a, a + 30)})


def test_continuous_shards(spark, inbox, tmp_path):
    add, stream = inbox
    add(batch(spark, 0, 120))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    jobs.shard_stream(stream(), out, checkpoint, rows_per_file=50)
    add(batch(spark, 120, 10))
    jobs.shard_stream(stream(), out, checkpoint, rows_per_file=50)
    sizes = sorted(pq.ParquetFile(p).metadata.num_rows for p in (tmp_path / "out").glob("*.parquet"))
    assert sizes == [10, 20, 50, 50]
    assert spark.read.parquet(out).select("url").distinct().count() == 130


def test_resume_after_a_failed_batch(spark, inbox, tmp_path):
    """The rows of a batch are written, its ledger is not; the restart repeats it whole."""
    add, stream = inbox
    add(batch(spark, 0, 20))
    add(batch(spark, 20, 20))
    rows_path, ledger_path, checkpoint = (str(tmp_path / p) for p in ("rows", "ledger", "cp"))

    def run(events):
        jobs.collect_with_ledger(stream(), rows_path, ledger_path, checkpoint, lambda b: b.select("url"), events)

    def breaks(rows):
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        run(breaks)
    add(batch(spark, 40, 20))
    run(lambda b: b.groupBy("postcode").agg(F.count(F.lit(1)).alias("n")))
    urls = [r.url for r in spark.read.schema("url string").parquet(rows_path).collect()]
    assert sorted(urls) == sorted(f"u{i}" for i in range(60))
    assert spark.read.schema("postcode string, n bigint").parquet(ledger_path).agg(F.sum("n")).first()[0] == 60


def test_a_batch_reads_only_the_folders_of_its_keys(spark, inbox, tmp_path):
    """The longer the history, the more folders; a batch of one key reads one of them."""
    add, stream = inbox
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    read, n = [], 0
    seen = jobs.SeenKeys(f"{out}-seen", tuple(dedup.LISTING_KEYS), 50)
    for size in (40, 200, 800):
        add(batch(spark, n, size, ids=10**6))
        add(batch(spark, max(0, n - 7), 7, ids=10**6))
        n += size
        jobs.dedup_exact(stream(), out, checkpoint, bucket_rows=50)
        one = batch(spark, 0, 1, ids=10**6)
        level = seen._sizes(spark, 10**6)[1]
        assert len(seen.of_level(one, level, 10**6).select("bucket").distinct().collect()) > n / 50 / 2 - 1
        history = seen.touched(one, level, 10**6)
        assert history.join(one, dedup.LISTING_KEYS, "left_semi").count() == 1
        plan = history._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan[plan.index("PartitionFilters: [") :].split("]")[0]
        read.append(history.count())
    got = spark.read.schema(SCHEMA).parquet(out)
    assert got.count() == n == got.select(*dedup.LISTING_KEYS).distinct().count()
    assert read[2] < 150 and read[2] < n / 5


def test_a_repeated_batch_keeps_the_history_right(spark, tmp_path):
    path = str(tmp_path / "seen")
    seen = jobs.SeenKeys(path, tuple(dedup.LISTING_KEYS), 10)
    for batch_id, start in ((0, 0), (1, 30), (1, 30), (2, 60), (2, 60)):  # batches 1 and 2 come twice
        rows = batch(spark, start, 30, ids=10**6)
        level = seen.level_for(rows, batch_id)
        assert seen.touched(rows, level, batch_id).join(rows, dedup.LISTING_KEYS, "left_semi").count() == 0
        seen.add(rows, level, batch_id)
    every = seen.of_level(rows, level, 3)
    assert every.count() == 90 and seen._sizes(spark, 3)[0] == 90
