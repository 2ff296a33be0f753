import datetime as dt
import os

from pyspark.sql import functions as F

from skyroute.operators.aggregate import tokens, wordcount
from skyroute.operators.trips import best_trips
from skyroute.sources.keyed import KeyedTable
from skyroute.sources.versions import current_version
from skyroute.streaming import running as R
from skyroute.streaming.control import run_until_marker
from skyroute.streaming.sources import batch_streams, stream_source
from skyroute.streaming.two_leg import stream_two_leg
from tests.conftest import rows
from tests.test_trips import LEGS, SCHEMA

WORD_BATCHES = ["a b  a", "b,c a", "", "end a,b", "after z"]


def _write_text_batches(tmp_path, batches):
    d = tmp_path / "words"
    d.mkdir()
    for i, text in enumerate(batches):
        p = d / f"b{i:03d}.txt"
        p.write_text(text + "\n")
        os.utime(p, (1_000_000 + i, 1_000_000 + i))   # file order = batch order
    return str(d)


def test_running_counts_equal_batch(spark, tmp_path):
    src = _write_text_batches(tmp_path, WORD_BATCHES)
    s = stream_source(spark, "text", src, max_files_per_trigger=1)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    R.run(R.running_counts(tokens(s, "value"), "word", out, ck))
    batch = wordcount(spark.read.text(src), "value")
    assert rows(R.current(spark, out, "word")) == rows(batch)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == len(WORD_BATCHES)


def test_restart_resumes_from_checkpoint(spark, tmp_path):
    d = tmp_path / "words"
    d.mkdir()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for i, text in enumerate(WORD_BATCHES[:2]):
        (d / f"b{i}.txt").write_text(text + "\n")
    s = stream_source(spark, "text", str(d), max_files_per_trigger=1)
    R.run(R.running_counts(tokens(s, "value"), "word", out, ck))
    for i, text in enumerate(WORD_BATCHES[2:], start=2):       # more data arrives, job restarts
        (d / f"b{i}.txt").write_text(text + "\n")
    s = stream_source(spark, "text", str(d), max_files_per_trigger=1)
    R.run(R.running_counts(tokens(s, "value"), "word", out, ck))
    assert rows(R.current(spark, out, "word")) == rows(wordcount(spark.read.text(str(d)), "value"))


def test_seeded_counts(spark, tmp_path):
    src = _write_text_batches(tmp_path, WORD_BATCHES[:2])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    seed = spark.createDataFrame([("hello", 1), ("world", 1), ("a", 1)], "word string, count long")
    stream = stream_source(spark, "text", src, max_files_per_trigger=1)
    R.run(R.running_counts(tokens(stream, "value"), "word", out, ck, seed=seed))
    got = dict(rows(R.current(spark, out, "word")))
    assert got["hello"] == 1 and got["world"] == 1 and got["a"] == 4 and got["b"] == 1


def test_stop_after_marker_batch(spark, tmp_path):
    src = _write_text_batches(tmp_path, ["one", "two", "three", "0.75 marker", "later", "later2"])
    seen = []
    s = stream_source(spark, "text", src, max_files_per_trigger=1)
    run_until_marker(s, F.col("value").contains("0.75"),
                     lambda b, i: seen.extend(r.value for r in b.collect()),
                     str(tmp_path / "ck"))
    assert seen == ["one", "two", "three", "0.75 marker"]
    # the batches after the marker were not committed: a restart gets every one of them
    run_until_marker(s, F.lit(False), lambda b, i: seen.extend(r.value for r in b.collect()),
                     str(tmp_path / "ck"))
    assert seen == ["one", "two", "three", "0.75 marker", "later", "later2"]


def test_stream_two_leg_across_batches_and_replay(spark, tmp_path):
    df = spark.createDataFrame(LEGS, SCHEMA)
    src = str(tmp_path / "legs")
    # first legs and second legs arrive in different micro-batches; batch 2 replays batch 0
    first = df.filter(F.col("dep_min") < 720)
    second = df.filter(F.col("dep_min") >= 720)
    first.write.parquet(src + "/b=0")
    second.write.parquet(src + "/b=1")
    first.write.parquet(src + "/b=2")
    for i in range(3):
        for f in os.listdir(f"{src}/b={i}"):
            os.utime(f"{src}/b={i}/{f}", (2_000_000 + i, 2_000_000 + i))
    s = stream_source(spark, "files", src, schema=SCHEMA + ", b int", max_files_per_trigger=1)
    out, ck = str(tmp_path / "trips"), str(tmp_path / "ck")
    R.run(stream_two_leg(s, 2008, out, ck))
    cols = ["origin1", "dest1", "dest2", "startdate", "flightnum1", "flightnum2", "total_delay"]
    assert rows(R.read_snapshot(spark, out), *cols) == rows(best_trips(df, 2008), *cols)
    kept = sorted(f for f in os.listdir(out) if f.startswith("version="))
    assert len(kept) == 2 and current_version(spark, out) == int(kept[-1].split("=")[1]) >= 2


def test_per_batch_counts(spark, tmp_path):
    src = _write_text_batches(tmp_path, WORD_BATCHES[:3])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    fn = lambda b: wordcount(b, "value")
    R.run(R.per_batch(stream_source(spark, "text", src, max_files_per_trigger=1), fn, out, ck))
    got = rows(spark.read.parquet(out), "batch_id", "word", "count")
    assert (0, "a", 2) in got and (1, "b,c", 1) in got and (2, "", 1) in got
    # a replay of the same batch id rewrites its own folder only
    R.write_batch(wordcount(spark.createDataFrame([("q",)], "value string"), "value"), out, 1)
    assert rows(spark.read.parquet(out).filter("batch_id = 1"), "word", "count") == [("q", 1)]


def test_incremental_two_leg_equals_batch(spark, tmp_path):
    from skyroute.streaming.two_leg import stream_two_leg_incremental
    df = spark.createDataFrame(LEGS, SCHEMA)
    src = str(tmp_path / "legs")
    # second legs first, then first legs, then a replay of the second legs;
    # one trip spans a month boundary (May 31 -> Jun 2)
    extra = spark.createDataFrame([
        (dt.date(2008, 5, 31), 1, 60, "AUS", "DEN", 600, 700, 3.0, False, False),
        (dt.date(2008, 6, 2), 1, 61, "DEN", "SEA", 900, 1000, -1.0, False, False)], SCHEMA)
    allf = df.unionByName(extra)
    second = allf.filter(F.col("dep_min") >= 720)
    first = allf.filter(F.col("dep_min") < 720)
    for i, part in enumerate([second, first, second]):
        part.write.parquet(f"{src}/b={i}")
        for f in os.listdir(f"{src}/b={i}"):
            os.utime(f"{src}/b={i}/{f}", (3_000_000 + i, 3_000_000 + i))
    s = stream_source(spark, "files", src, schema=SCHEMA + ", b int", max_files_per_trigger=1)
    out = str(tmp_path / "trips")
    R.run(stream_two_leg_incremental(s, 2008, str(tmp_path / "l"), out, str(tmp_path / "ck")))
    cols = ["origin1", "dest1", "dest2", "startdate", "flightnum1", "flightnum2", "total_delay"]
    got = rows(KeyedTable.open(spark, out).read(), *cols)
    assert got == rows(best_trips(allf, 2008), *cols)
    assert ("AUS", "DEN", "SEA", "31/05/2008", 60, 61, 2.0) in got


def test_incremental_ranked_equals_batch(spark, tmp_path):
    from skyroute.operators.aggregate import mean_by
    from skyroute.operators.ranking import top_k_by
    schema = "origin string, carrier long, delay double"
    batches = [
        [("ORD", 1, 5.0), ("ORD", 2, 1.0), ("LAX", 1, 3.0)],
        [("ORD", 1, -9.0), ("SFO", 3, 2.0)],                 # LAX untouched here
        [("ORD", 3, 0.0), ("ORD", 2, 4.0), ("LAX", 2, -1.0)],
    ]
    src = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(src / f"b={i}"))
        for f in os.listdir(src / f"b={i}"):
            os.utime(src / f"b={i}" / f, (4_000_000 + i, 4_000_000 + i))
    s = stream_source(spark, "files", str(src), schema=schema + ", b int", max_files_per_trigger=1)
    agg = R.running_sum_count(s, ["origin", "carrier"], "delay")

    def derive(b):
        m = b.select("origin", "carrier", (F.col("total") / F.col("n")).alias("m"))
        return top_k_by(m, "origin", ["m", "carrier"], 2)
    out = str(tmp_path / "out")
    R.run(R.incremental_ranked(agg, "origin", ["origin", "carrier"], derive,
                               str(tmp_path / "state"), out, str(tmp_path / "ck")))
    allb = spark.createDataFrame([r for b in batches for r in b], schema)
    want = top_k_by(mean_by(allb, ["origin", "carrier"], "delay", "m"), "origin", ["m", "carrier"], 2)
    assert rows(KeyedTable.open(spark, out).read(), "origin", "carrier", "m", "rank") == \
        rows(want, "origin", "carrier", "m", "rank")


def test_a_batch_of_state_is_computed_once(spark, tmp_path):
    """Merging a batch into the keyed table does not run the stateful step again for a second use of its rows."""
    schema, keys = "origin string, carrier long, delay double", ["origin", "carrier"]
    batches = [[("A", c, 5.0) for c in range(30)], [("A", c, 1.0) for c in range(20, 40)], [("B", 1, 2.0)]]
    src = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).write.parquet(str(src / f"part={i}"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(total):
        seen.add(1)
        return total

    def best(b):
        return b.groupBy("origin").agg(F.min(F.col("total") / F.col("n")).alias("m"))
    out = str(tmp_path / "out")
    R.drain(batch_streams(spark, str(src), 3, schema), lambda s: R.incremental_ranked(
        R.running_sum_count(s, keys, "delay").withColumn("total", counted("total")), "origin", keys, best,
        str(tmp_path / "st"), out, str(tmp_path / "ck")))
    assert rows(KeyedTable.open(spark, out).read(), "origin", "m") == [("A", 1.0), ("B", 2.0)]
    assert KeyedTable.open(spark, str(tmp_path / "st")).read().count() == 41
    assert seen.value == sum(map(len, batches))


def test_null_groups_rank_as_in_batch(spark, tmp_path):
    from skyroute.operators.aggregate import mean_by
    from skyroute.operators.ranking import top_k_by
    schema = "origin string, dest string, delay double"
    batches = [[("A", None, 5.0), (None, "Y", 1.0)], [("A", None, 1.0), (None, "Y", 4.0), ("A", "B", 2.0)]]
    src = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).write.parquet(str(src / f"part={i}"))
    keys = ["origin", "dest"]

    def derive(b):
        return top_k_by(b.select(*keys, (F.col("total") / F.col("n")).alias("m")), "origin", ["m", "dest"], 5)
    out = str(tmp_path / "out")
    R.drain(batch_streams(spark, str(src), 2, schema), lambda s: R.incremental_ranked(
        R.running_sum_count(s, keys, "delay"), "origin", keys, derive, str(tmp_path / "st"), out, str(tmp_path / "ck")))
    want = top_k_by(mean_by(spark.createDataFrame(batches[0] + batches[1], schema), keys, "delay", "m"), "origin",
                    ["m", "dest"], 5)
    assert rows(KeyedTable.open(spark, out).read(), *keys, "m", "rank") == rows(want, *keys, "m", "rank")


def test_two_leg_stream_with_unknown_airports_and_a_long_gap(spark, tmp_path):
    from skyroute.streaming.two_leg import stream_two_leg_incremental
    d = dt.date
    legs = [(d(2008, 1, 31), 1, 1, None, "B", 600, 700, 1.0, False, False),
            (d(2008, 3, 31), 1, 2, "B", None, 900, 950, 2.0, False, False),
            (d(2008, 3, 31), 1, 3, "B", "C", 900, 950, 3.0, False, False),
            (d(2008, 1, 31), 1, 4, "A", None, 600, 700, 1.0, False, False),
            (d(2008, 3, 31), 1, 5, None, "D", 900, 950, 1.0, False, False)]
    src = tmp_path / "legs"
    for i, part in enumerate([legs[1:3] + legs[4:], legs[:1] + legs[3:4], legs[1:2]]):
        spark.createDataFrame(part, SCHEMA).write.parquet(str(src / f"part={i}"))
    out = str(tmp_path / "trips")
    R.drain(batch_streams(spark, str(src), 3, SCHEMA), lambda s: stream_two_leg_incremental(
        s, 2008, str(tmp_path / "l"), out, str(tmp_path / "ck"), gap_days=60))
    cols = ["origin1", "dest1", "dest2", "startdate", "flightnum1", "flightnum2", "total_delay"]
    got = rows(KeyedTable.open(spark, out).read(), *cols)
    assert got == rows(best_trips(spark.createDataFrame(legs, SCHEMA), 2008, gap_days=60), *cols)
    assert len(got) == 2 and {r[0] for r in got} == {None}


def test_files_per_batch_grow_with_the_input(spark, tmp_path):
    from skyroute.streaming.sources import split_to_batches
    for splits in (2, 6):
        df = spark.range(0, 600, 1, splits).withColumn("v", F.col("id").cast("string"))
        split_to_batches(df, str(tmp_path / str(splits)), F.pmod(F.col("id"), F.lit(3)))
        for i in range(3):
            files = os.listdir(tmp_path / str(splits) / f"part={i}")
            assert sum(f.endswith(".parquet") for f in files) == splits


def test_changelog_compaction(spark, tmp_path):
    from tests.explain_util import explain
    src = _write_text_batches(tmp_path, WORD_BATCHES)
    s = stream_source(spark, "text", src, max_files_per_trigger=1)
    out, ck, base = str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "base")
    R.run(R.running_counts(tokens(s, "value"), "word", out, ck, base_root=base, compact_every=2))
    assert current_version(spark, base) == 3
    want = rows(wordcount(spark.read.text(src), "value"))
    assert rows(R.current(spark, out, "word", base_root=base)) == want
    assert rows(R.current(spark, out, "word")) == want
    plan = explain(R.current(spark, out, "word", base_root=base))
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "> 3" in plan


def _forget_last_commit(ck):
    """As after a crash between a batch's sink and Spark's commit: the batch is run again."""
    done = sorted((int(f) for f in os.listdir(f"{ck}/commits") if f.isdigit()))
    os.remove(f"{ck}/commits/{done[-1]}")
    crc = f"{ck}/commits/.{done[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def test_two_stages_count_replayed_batches_once(spark, tmp_path):
    from skyroute.streaming.partials import commit_batch, committed, merge_partials, merge_partials_stream, read_merged
    from skyroute.streaming.partials import stage_partials
    out, ck, final, ck2 = (str(tmp_path / x) for x in ("out", "ck", "final", "ck2"))
    src = _write_text_batches(tmp_path, ["a b", "b a", "b"])
    words = tokens(stream_source(spark, "text", src, max_files_per_trigger=1), "value")

    def stage1():
        R.run(stage_partials(words, "word", None, out, ck))

    def stage2():
        R.run(merge_partials_stream(spark, out, "word", final, ck2, metric=False))
        return rows(read_merged(spark, final, "word", "count", metric=False))
    stage1()
    want = [("a", 2), ("b", 3)]
    assert stage2() == want
    # the first stage's last batch is run again, and one is rewritten by hand: both are committed already
    _forget_last_commit(ck)
    stage1()
    again = spark.createDataFrame([("a", 2), ("b", 1)], "word string, n long")
    assert not commit_batch(again, out, 1)
    # what a lost attempt left is read by nobody
    again.write.parquet(f"{out}/data/batch_id=2/attempt=0123lost")
    assert stage2() == want
    # the second stage's last batch is run again after its sums were added
    _forget_last_commit(ck2)
    assert stage2() == want
    assert rows(merge_partials(spark, out, "word", "n", metric=False)) == want
    assert committed(spark, out).select("batch_id").distinct().count() == 3
    # new batches are added to what is there
    assert commit_batch(spark.createDataFrame([("c", 7), ("a", 1)], "word string, n long"), out, 3)
    assert stage2() == [("a", 3), ("b", 3), ("c", 7)]


def test_two_stages_keep_means_and_null_keys(spark, tmp_path):
    from skyroute.streaming.partials import commit_batch, merge_partials, merge_partials_stream, read_merged
    out, final, ck2 = (str(tmp_path / x) for x in ("out", "final", "ck2"))
    kind = "k string, total double, n long"
    for i, part in enumerate([[("a", 3.0, 1), (None, 8.0, 2)], [("a", 1.0, 3), (None, 1.0, 1)]]):
        commit_batch(spark.createDataFrame(part, kind), out, i)
        R.run(merge_partials_stream(spark, out, "k", final, ck2))
    want = [(None, 3.0), ("a", 1.0)]
    assert rows(read_merged(spark, final, "k", "m")) == sorted(want, key=lambda t: tuple(map(str, t)))
    assert rows(merge_partials(spark, out, "k", "m")) == rows(read_merged(spark, final, "k", "m"))


def test_marker_is_observed_while_the_batch_is_written(spark, tmp_path):
    """One read of the source a batch; batches without rows are no markers."""
    src = _write_text_batches(tmp_path, ["one", "0.75 marker", "later"])
    reads, out = spark.sparkContext.accumulator(0), []

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b
    s = stream_source(spark, "text", src, max_files_per_trigger=1).mapInPandas(counted, "value string")
    run_until_marker(s, F.col("value").contains("0.75"), lambda b, i: out.extend(r.value for r in b.collect()),
                     str(tmp_path / "ck"))
    assert out == ["one", "0.75 marker"] and reads.value - out.count("later") <= 3
    run_until_marker(s.where("false"), F.col("value").contains("0.75"), lambda b, i: out.extend(b.collect()), str(tmp_path / "ck2"))
    assert len(out) == 2


def test_documents_without_an_id_are_replayed(spark, tmp_path):
    from skyroute.plans.replay import document_streams
    docs = spark.createDataFrame([(1, "a b"), (None, "b c"), (7, "c")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out, ck = str(tmp_path / "o"), str(tmp_path / "k")
    R.drain(document_streams(spark, str(tmp_path)), lambda s: R.running_counts(tokens(s, "text"), "word", out, ck))
    assert rows(R.current(spark, out, "word")) == [("a", 1), ("b", 2), ("c", 2)]


def test_one_file_for_each_batch(spark, tmp_path):
    src = _write_text_batches(tmp_path, WORD_BATCHES[:2])
    out = tmp_path / "out"
    s = stream_source(spark, "text", src, max_files_per_trigger=1)
    R.run(R.per_batch(s, lambda b: wordcount(b.repartition(6), "value"), str(out), str(tmp_path / "ck"), files=1))
    assert [len(list((out / f"batch_id={i}").glob("*.parquet"))) for i in (0, 1)] == [1, 1]


def test_published_counts_are_rebuilt_from_the_state(spark, tmp_path):
    from skyroute.streaming.recover import rebuild, state_rows
    src = _write_text_batches(tmp_path, WORD_BATCHES)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    counts = tokens(stream_source(spark, "text", src, max_files_per_trigger=1), "value")
    R.run(R.running_counts(counts, "word", out, ck))
    want = rows(R.current(spark, out, "word"))
    lost = str(tmp_path / "lost")
    rebuild(state_rows(spark, ck, ["word"], ["count"]), lost, spark, ck)
    assert rows(R.current(spark, lost, "word")) == want
    # the stream goes on into the restored table
    (tmp_path / "words" / "z.txt").write_text("a new\n")
    R.run(R.running_counts(tokens(stream_source(spark, "text", src, max_files_per_trigger=1), "value"), "word", lost, ck))
    assert rows(R.current(spark, lost, "word")) == rows(wordcount(spark.read.text(src), "value"))
