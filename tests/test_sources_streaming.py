from dataclasses import replace
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from pulsefold.operators.clean import resolve_glucose, resolve_time
from pulsefold.plans.batch import run_batch
from pulsefold.plans.federated import RoundSettings
from pulsefold.schema import FILL_VALUES, NA_TOKENS, PROCESSED_COLUMNS, STREAM_SCHEMA
from pulsefold.session import shared_root
from pulsefold.sources.readings import number_rows, read_csv, read_jsonl
from pulsefold.plans import queries
from pulsefold.sources import sinks
from pulsefold.sources.sinks import write_by_institution, write_csv, write_jsonl, write_replay
from pulsefold.streaming import flow


def test_csv_missing_tokens_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,bg\n" + "".join(f"2024-01-01,{t}\n" for t in NA_TOKENS) + "2024-01-01,5.5\n")
    (tmp_path / "b.csv").write_text("time,bg\n" + "".join(f"2024-01-02,{i}\n" for i in range(50)))
    (tmp_path / "ignored.txt").write_text("time,bg\nx,y\n")
    df = resolve_glucose(resolve_time(number_rows(read_csv(spark, str(tmp_path), file_order=True))))
    rows = df.orderBy("event_id").collect()
    n = len(NA_TOKENS)
    assert [r["event_id"] for r in rows] == list(range(n + 51))
    assert [r["glucose"] for r in rows] == [None] * n + [5.5] + [float(i) for i in range(50)]


def test_file_order_survives_many_blocks(spark, tmp_path):
    (tmp_path / "big.csv").write_text("glucose\n" + "".join(f"{i}\n" for i in range(20_000)))
    (tmp_path / "small.csv").write_text("glucose\n" + "".join(f"{i}\n" for i in range(20_000, 20_100)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        numbered = number_rows(read_csv(spark, str(tmp_path), file_order=True))
        assert numbered.where("cast(glucose as bigint) <> event_id").count() == 0
        assert numbered.select("event_id").distinct().count() == 20_100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("time,bg\n2024-01-01,1\n")
    (tmp_path / "b.csv").write_text("bg,time\n1,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_writers(spark, tmp_path):
    df = spark.sql("select 'institution_1' institution, timestamp_ntz'2024-01-01 00:05:00' timestamp, "
                   "1.123456789012345D glucose, cast(null as double) glucose_roc, 3 steps")
    write_jsonl(df, str(tmp_path / "j"))
    line = next((tmp_path / "j" / "institution=institution_1").glob("*.json")).read_text()
    assert json.loads(line) == {"timestamp": "2024-01-01 00:05:00", "glucose": 1.123456789, "glucose_roc": None, "steps": 3}
    assert read_jsonl(spark, str(tmp_path / "j")).first()["steps"] == 3
    write_by_institution(df, str(tmp_path / "p"))
    assert dict(spark.read.parquet(str(tmp_path / "p")).dtypes)["timestamp"] == "timestamp_ntz"
    write_csv(df, str(tmp_path / "c"))
    assert str(resolve_time(read_csv(spark, str(tmp_path / "c"))).first()["ts"]) == "2024-01-01 00:05:00"


@pytest.fixture
def feed(spark):
    """250 readings with gaps and one unreadable time."""
    i = F.col("id")
    return spark.range(250).select(
        F.when(i == 7, "garbage").otherwise(F.concat(F.lit("2024-01-01 00:00:"), F.lpad((i % 60).cast("string"), 2, "0"))).alias("timestamp"),
        F.when(i % 10 != 0, (40 + i).cast("double")).alias("glucose"), F.lit(None).cast("double").alias("glucose_ma_1h"),
        F.lit(1.0).alias("glucose_std_1h"), F.lit(0.0).alias("glucose_roc"), i.cast("int").alias("steps"),
        F.when(i % 3 == 0, F.lit(60)).alias("heart_rate"), (i % 24).cast("int").alias("hour"),
        (i % 7).cast("int").alias("day_of_week"), F.when(i < 30, 1).otherwise(0).alias("hypo_risk"),
    )


def rows_of(df):
    return sorted(map(str, df.drop("processing_time").select(*sorted(set(df.columns) - {"processing_time"})).collect()))


def test_replay_files_are_small_ordered_and_whole(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "r"))
    files = sorted((tmp_path / "r").glob("*.json"))
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert sum(sizes) == 250 and max(sizes) <= 100
    for f in files:
        times = [json.loads(line)["timestamp"] for line in f.read_text().splitlines()]
        assert times == sorted(times)


@pytest.mark.parametrize("most, records", [(4_000, 100), (5, 50)])
def test_replay_files_are_bounded_however_long_the_table(spark, tmp_path, monkeypatch, most, records):
    monkeypatch.setattr(sinks, "REPLAY_FILES", most)
    spark.range(2_000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) as ts", "id % 7 as user_id",
        "'view' as event_type", "cast(id % 90 as double) + 30 as value", "'{\"k\": 1}' as props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    source = str(tmp_path / "replay")
    monkeypatch.setattr(queries, "shared_path", lambda *_: source)
    queries._json_stream(spark, str(tmp_path))
    sizes = [len(f.read_text().splitlines()) for f in Path(source).glob("*.json")]
    # The ranges of the writer may each end in a short file.
    assert sum(sizes) == 2_000 and max(sizes) <= max(records, 2_000 / most)
    assert len(sizes) <= min(most, 2_000 // 100) + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_stream_equals_batch(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "in"), records_per_file=50)
    stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in")))
    query = flow.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    flow.drain(query)
    assert len(query.recentProgress) > 1  # one file at a time
    batch = flow.enrich(read_jsonl(spark, str(tmp_path / "in")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(out.withColumn("glucose_category", F.col("glucose_category").cast("string"))) == rows_of(batch)
    row = batch.where("steps = 0").first()
    assert row["glucose"] == FILL_VALUES["glucose"] and row["is_night"] == 1 and row["glucose_category"] == "normal"
    assert batch.where("timestamp is null").count() == 1
    assert sorted(p.name for p in (tmp_path / "out").glob("glucose_category=*")) == [
        "glucose_category=high", "glucose_category=low", "glucose_category=normal"]


def test_restart_loses_and_repeats_nothing(spark, feed, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    Path(source).mkdir()
    write_replay(feed.where("steps < 100"), f"{source}/first")
    for part in ("steps < 100", "steps >= 100"):
        if part != "steps < 100":
            write_replay(feed.where(part), f"{source}/second")
        stream = flow.enrich(flow.json_source(spark, f"{source}/*"))
        flow.drain(flow.to_parquet(stream, out, state, available_now=True))
    got = spark.read.parquet(out)
    assert got.count() == 250 and got.select("steps").distinct().count() == 250


def test_fan_out_repeats_a_batch_without_copies(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "in"), records_per_file=60)
    paths = {str(tmp_path / "all"): lambda b: b, str(tmp_path / "risk"): lambda b: b.where("hypo_risk = 1")}
    for state in ("one", "two"):  # a second run from scratch writes the same batches again
        stream = flow.json_source(spark, str(tmp_path / "in"), max_files_per_trigger=2)
        flow.drain(flow.fan_out(stream, paths, str(tmp_path / state), available_now=True))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 250
    assert spark.read.parquet(str(tmp_path / "risk")).count() == 30


def test_running_statistics(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "in"), records_per_file=60)
    stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in"), max_files_per_trigger=2))
    flow.drain(flow.to_statistics(stream, str(tmp_path / "stats"), str(tmp_path / "state"), available_now=True))
    row = flow.latest_statistics(spark, str(tmp_path / "stats")).first()
    assert row["total_records"] == 250 and row["hypo_events"] == 30 and row["total_steps"] == sum(range(250))


def test_statistics_before_any_data_are_empty_and_snapshots_stay_few(spark, feed, tmp_path):
    (tmp_path / "in").mkdir()
    stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in")))
    query = flow.to_statistics(stream, str(tmp_path / "stats"), str(tmp_path / "state"), compact_every=2)
    try:
        assert flow.latest_statistics(spark, str(tmp_path / "stats")).count() == 0
        write_replay(feed, str(tmp_path / "in" / "a"), records_per_file=30)
        for f in (tmp_path / "in" / "a").glob("*.json"):
            f.rename(tmp_path / "in" / f.name)
        query.processAllAvailable()
    finally:
        query.stop()
    assert flow.latest_statistics(spark, str(tmp_path / "stats")).first()["total_records"] == 250
    batches = query.lastProgress["batchId"] + 1
    assert batches >= 5
    # Two bases at most, and the changes since the older one.
    bases = flow.completed(spark, str(tmp_path / "stats" / "base"), "upto")
    assert len(bases) == 2 and flow.completed(spark, str(tmp_path / "stats" / "changes"), "batch") == [-1, *range(bases[0] + 1, batches)]


def test_a_batch_writes_only_the_keys_it_met(spark, feed, tmp_path):
    path = str(tmp_path / "stats")
    parts = ("event_id < 100", "event_id between 100 and 199", "event_id >= 200")
    for number, part in enumerate(parts):
        (
            feed.withColumn("event_id", F.col("steps")).where(part).withColumn("k", F.lit(f"k{number}")).coalesce(1)
            .write.mode("append").json(str(tmp_path / "in"))
        )
        stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in"), T.StructType([*STREAM_SCHEMA, T.StructField("k", T.StringType())])))
        flow.drain(flow.to_statistics(stream, path, str(tmp_path / "state"), ("k",), available_now=True))
        written_keys = {r["k"] for r in spark.read.parquet(f"{path}/changes/batch={number}").collect()}
        assert written_keys == {f"k{number}"}
    assert {r["k"]: r["total_records"] for r in flow.latest_statistics(spark, path, ("k",)).collect()} == {"k0": 100, "k1": 100, "k2": 50}


def test_a_removed_folder_is_an_error_not_a_gap(spark, feed, tmp_path):
    path = str(tmp_path / "stats")
    write_replay(feed, str(tmp_path / "in"), records_per_file=60)
    stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in"), max_files_per_trigger=2))
    flow.drain(flow.to_statistics(stream, path, str(tmp_path / "state"), available_now=True))
    known = flow.latest_statistics(spark, path)
    flow.remove(spark, f"{path}/changes/batch={flow.completed(spark, path + '/changes', 'batch')[-1]}")
    with pytest.raises(Exception, match="(?i)not.exist|not.found|FILE_NOT_EXIST"):
        known.collect()


def test_a_batch_that_breaks_after_writing_is_written_once(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "in"), records_per_file=40)
    whole, broken = str(tmp_path / "all"), {"left": 1}

    def shape(batch):
        return batch

    def breaking(batch):
        if broken["left"] and (tmp_path / "all" / "batch_id=1").exists():
            broken["left"] = 0
            raise RuntimeError("lost")
        return batch.where("hypo_risk = 1")

    paths = {whole: shape, str(tmp_path / "risk"): breaking}
    source = lambda: flow.json_source(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    with pytest.raises(Exception, match="lost"):
        flow.drain(flow.fan_out(source(), paths, str(tmp_path / "state"), available_now=True))
    # Batch 1 has written its first table, but is not done: it comes again.
    assert flow.completed(spark, whole, "batch_id") == [0, 1]
    flow.drain(flow.fan_out(source(), paths, str(tmp_path / "state"), available_now=True))
    assert spark.read.parquet(whole).count() == 250 and spark.read.parquet(str(tmp_path / "risk")).count() == 30


def test_a_stopped_stream_goes_on(spark, feed, tmp_path):
    write_replay(feed, str(tmp_path / "in"), records_per_file=20)
    done = []
    for stop in (2, 3, None):
        rows = flow.enrich(flow.json_source(spark, str(tmp_path / "in")))
        query = flow.to_parquet(rows, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
        done.append(flow.stop_after(query, stop or 10_000))
    assert done[0] >= 2 and done[1] >= 3
    table = spark.read.parquet(str(tmp_path / "out"))
    assert table.count() == 250 and table.agg(F.sum("steps")).first()[0] == sum(range(250))


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "yarn"
        getConf = staticmethod(dict)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session)


def test_memory_and_console_sinks_and_timed_run(spark, feed, tmp_path, capfd):
    write_replay(feed, str(tmp_path / "in"))
    stream = flow.enrich(flow.json_source(spark, str(tmp_path / "in")))
    flow.drain(flow.to_console(stream, "shown", str(tmp_path / "c"), available_now=True))
    other = flow.to_memory(stream, "untouched")
    query, seen = flow.to_memory(stream, "kept"), []
    flow.timed_run([query], 15, 1.0, lambda passed: seen.append(spark.table("kept").count()))
    assert seen[-1] == 250 and not query.isActive and other.isActive
    other.stop()


def test_batch_run_from_csv(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    values = [(i * 37 % 211) + 30 for i in range(600)]
    (raw / "cgm.csv").write_text("CGM\n" + "".join(f"{v if i % 11 else 'NA'}\n" for i, v in enumerate(values)))
    settings = RoundSettings(rounds=2, local_epochs=2, hidden=(8,))
    result, summary, comparison = run_batch(spark, str(raw), str(tmp_path / "out"), 3, "2024-01-01", settings, 10)
    assert summary.first()["total_rounds"] == 2
    assert {r["metric"] for r in comparison.collect()} == {"loss", "accuracy", "precision", "recall", "f1", "auc"}
    stored = spark.read.parquet(str(tmp_path / "out" / "batch"))
    assert set(PROCESSED_COLUMNS) <= set(stored.columns)
    assert dict(map(tuple, stored.groupBy("institution").count().collect())) == {f"institution_{i}": 200 for i in (1, 2, 3)}
    assert read_jsonl(spark, str(tmp_path / "out" / "stream_input"), STREAM_SCHEMA).count() == 600
    assert len(result.params) > 0 and (tmp_path / "out" / "central_model").exists()
    rejected = spark.read.parquet(str(tmp_path / "out" / "rejected"))
    assert {r["institution"]: r["rejected"] for r in rejected.collect()} == {f"institution_{i}": 0 for i in (1, 2, 3)}
    assert spark.read.parquet(str(tmp_path / "out" / "left_out")).count() == 0
    written = spark.read.json(str(tmp_path / "out" / "history")).first()
    assert written["rounds"] == [1, 2] and len(written["train_accuracy"]) == 2
    # A second run replaces the tables and finds its rounds done.
    again, _, _ = run_batch(spark, str(raw), str(tmp_path / "out"), 3, "2024-01-01", settings, 10)
    assert list(again.params) == list(result.params) and spark.read.parquet(str(tmp_path / "out" / "batch")).count() == 600
    with pytest.raises(ValueError, match="holds another run"):
        run_batch(spark, str(raw), str(tmp_path / "out"), 3, "2024-01-01", replace(settings, local_epochs=3), 10)


def test_shared_root_follows_the_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert not configured or shared_root(spark) == configured.rstrip("/")


def parts(path, suffix):
    """Number of data files in each institution's folder."""
    return {d.name.partition("=")[2]: len(list(d.glob(f"*.{suffix}"))) for d in path.iterdir() if d.is_dir()}


def test_partitioned_tables_have_as_many_files_as_their_bytes_need(spark, tmp_path):
    named = F.when(F.col("id") < 90_000, "big").when(F.col("id") < 95_000, "mid").when(F.col("id") < 99_000, "small")
    df = spark.range(100_000).select(named.alias("institution"), "id").repartition(40)
    write_by_institution(df, str(tmp_path / "p"))
    assert parts(tmp_path / "p", "parquet") == {"big": 1, "mid": 1, "small": 1, "__HIVE_DEFAULT_PARTITION__": 1}
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "100k")
    try:
        write_jsonl(df, str(tmp_path / "j"))
    finally:
        spark.conf.set(advisory, before)
    files = parts(tmp_path / "j", "json")
    assert 2 <= files["big"] <= 40 and sum(files.values()) <= 60
    assert spark.read.json(str(tmp_path / "j")).select("id").distinct().count() == 100_000


@pytest.mark.parametrize("write", [write_by_institution, write_jsonl, write_csv])
def test_a_failing_write_leaves_the_table_before_it(spark, tmp_path, write):
    target = tmp_path / "t"
    good = spark.range(20).select(F.lit("a").alias("institution"), "id")
    write(good, str(target))
    before = sorted(p.name for p in target.rglob("*"))
    bad = good.withColumn("id", F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("broken row")).cast("bigint")))
    with pytest.raises(Exception, match="broken row"):
        write(bad, str(target))
    assert sorted(p.name for p in target.rglob("*")) == before
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_table_may_be_replaced_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_by_institution(spark.range(10).select(F.lit("a").alias("institution"), "id"), path)
    write_by_institution(spark.read.parquet(path).where("id < 4"), path)
    assert spark.read.parquet(path).count() == 4
    write_by_institution(spark.read.parquet(path).where("id < 0"), path)
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
