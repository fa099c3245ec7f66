"""Sources, formats, templates, flows and streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from meterflow.operators.filters import simple_filter
from meterflow.operators.lookup import enrich
from meterflow.operators.mapping import map_values
from meterflow.operators.normalize import to_metrics
from meterflow.operators.routing import Route
from meterflow.operators.timeops import shift_time
from meterflow.plans.flow import FINISHED, SKIPPED, Flow, Modifiers, Output, Task, Transform
from meterflow.plans.templates import repeat_query, runs
from meterflow.sinks.formats import documents, envelope, json_arrays, json_lines
from meterflow.sinks.writers import documents_to, lines_to, send_batches, table_to, write_documents, write_lines
from meterflow.sources.generated import random_metrics
from meterflow.sources.payloads import infer_json_type, json_records, read_json, read_text
from meterflow.sources.reports import QUOTA_MEASURES, glob_filter, unpivot_report
from meterflow.sources.sql import jdbc_source, sql_source
from meterflow.sources.summaries import LEVELS, level_summary, run_summaries, run_summary
from meterflow.sources.topics import read_topic, write_topic
from meterflow.streaming.run import interval_counts, latest_updates, run_stream, write_updates
from meterflow.streaming.workspace import workspace

AT = dt.datetime(2024, 5, 6, 7, 8, 9)


def values(df, name="value"):
    return [r[name] for r in df.collect()]


# sources

def test_sql_counts_of_the_example(spark):
    table = spark.createDataFrame([(i, "title_b" if i % 3 == 0 else "title_a") for i in range(20)], "number int, title string")
    got = sql_source(spark, "SELECT title, COUNT(*) AS n FROM test WHERE number >= :least GROUP BY title", {"least": 0}, {"test": table})
    frame = to_metrics(got, "t", "n")
    assert {r["attributes"]["title"]: r["metric"] for r in frame.collect()} == {"title_a": 13, "title_b": 7}


def test_jdbc_options_are_checked(spark):
    with pytest.raises(ValueError):
        jdbc_source(spark, "jdbc:none:", "SELECT 1", partition_column="id")
    with pytest.raises(ValueError):
        jdbc_source(spark, "jdbc:none:", "SELECT 1")


def test_json_payloads(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"name": {"letter": "a"}, "value": 1}, {"name": {"letter": "b"}, "value": 2}]')
    (tmp_path / "one.json").write_text('{"name": {"letter": "c"}, "value": 3}')
    got = to_metrics(read_json(spark, str(tmp_path)), "t", "value")
    assert sorted((r["metric"], r["attributes"]["name"]["letter"]) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_json_columns(spark):
    texts = ['[{"a": 1}, {"a": 2.5, "b": {"c": [1]}}]', '[]', '[{"b": {"d": "x"}}]', "not json", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    with pytest.raises(Exception, match="MALFORMED"):
        infer_json_type(df, "doc")
    with pytest.raises(Exception, match="MALFORMED"):
        json_records(df, "doc", "array<struct<a:double>>").collect()
    kind = infer_json_type(df.where("id <> 3"), "doc")
    assert kind.simpleString() == "array<struct<a:double,b:struct<c:array<bigint>,d:string>>>"
    got = [(r["id"], r["a"], r["b"] and r["b"]["d"]) for r in json_records(df, "doc", keep=["id"], malformed="drop").collect()]
    assert got == [(0, 1.0, None), (0, 2.5, None), (2, None, "x")]
    single = spark.createDataFrame([('{"a": 1}',), ('[{"a": 2}, {"a": 3}]',)], "doc string")
    assert values(json_records(single, "doc", "a INT"), "a") == [1, 2, 3]
    with pytest.raises(ValueError):
        json_records(single, "doc", "array<int>")


def test_raw_text_file(spark, tmp_path):
    (tmp_path / "x.txt").write_text("first\nsecond")
    got = to_metrics(read_text(spark, str(tmp_path), "message_field"), "t", None, allow_none=True)
    assert [r["attributes"]["message_field"] for r in got.collect()] == ["first\nsecond"]


def test_report_and_paths(spark):
    df = spark.createDataFrame(
        [("/q/a", 1, 10, "ok"), ("/q/b", None, 20, "ok"), ("/q/skip/x", 5, 6, "ok")], "path string, used int, files int, state string"
    )
    got = unpivot_report(df, ["used", "files"], ["state", "pattern"], path="path", patterns=["/q/*", "/q/a", "/q/*/*"], skip=["*skip*"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("ok", "/q/*", "used", 1), ("ok", "/q/*", "files", 10), ("ok", "/q/a", "used", 1), ("ok", "/q/a", "files", 10),
        ("ok", "/q/*", "used", None), ("ok", "/q/*", "files", 20),
    ]))
    assert glob_filter(df, "path", ["/q/*"]).count() == 2


def test_quota_report(spark):
    row = {m: i for i, m in enumerate(QUOTA_MEASURES)} | {"gid": "g", "quota": "q", "space": "/s", "statusbytes": "ok", "statusfiles": "ok", "extra": 1}
    got = unpivot_report(spark.createDataFrame([row])).collect()
    assert {r["metric_key"]: r["metric"] for r in got} == {m: i for i, m in enumerate(QUOTA_MEASURES)}
    assert "extra" not in got[0] and got[0]["space"] == "/s"


def test_random_metrics(spark):
    got = random_metrics(spark, 500, lo=-5, hi=5, seed=1, attributes={"k": "v", "n": {"m": 1}}).collect()
    assert len(got) == 500 and all(-5 <= r["metric"] < 5 and r["k"] == "v" and r["n"]["m"] == 1 for r in got)
    assert len({r["metric"] for r in got}) > 400
    # a reversed range starts at lo and spans the same width
    assert all(5 <= v < 15 for v in values(random_metrics(spark, 50, lo=5, hi=-5), "metric"))


def test_run_summaries(spark):
    day = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    rows = [("okay", day(1)), ("failed", day(1, 30)), ("okay", day(2)), ("other", day(1)), (None, None)]
    df = spark.createDataFrame(rows, "result string, finished_at timestamp")
    got = {r["result"]: r["metric"] for r in run_summary(df, day(1), day(2)).collect()}
    assert got == {"okay": 1, "skipped": 0, "failed": 1}
    empty = {r["result"]: r["metric"] for r in run_summary(df.limit(0), day(1), day(2)).collect()}
    assert empty == {"okay": 0, "skipped": 0, "failed": 0}
    got = [(r["timestamp_from"].hour, r["result"], r["metric"]) for r in run_summaries(df, "1h").collect()]
    assert sorted(got) == [(1, "failed", 1), (1, "okay", 1), (1, "skipped", 0), (2, "failed", 0), (2, "okay", 1), (2, "skipped", 0)]


def test_levels(spark):
    df = spark.createDataFrame([("info",), ("ERROR",), ("ERROR",), ("trace",)], "level string")
    assert {r["log_level"]: r["metric"] for r in level_summary(df, "info").collect()} == {20: 1, 30: 0, 40: 2, 50: 0}
    numbers = df.select(F.lit(LEVELS["ERROR"]).alias("level"))
    assert {r["log_level"]: r["metric"] for r in level_summary(numbers, "WARNING").collect()} == {30: 0, 40: 4, 50: 0}


def test_levels_of_an_interval(spark):
    df = spark.createDataFrame([("info", AT), ("info", AT + dt.timedelta(hours=1))], "level string, ts timestamp_ntz")
    got = level_summary(df, "info", start=AT, end=AT + dt.timedelta(minutes=1)).collect()
    assert {r["log_level"]: r["metric"] for r in got} == {20: 1, 30: 0, 40: 0, 50: 0}
    assert {r["timestamp_from"] for r in got} == {AT}


# templates

def test_runs_pair_values():
    assert runs({"a": [1, 2], "b": ["x", "y"]}) == [{"a": 1, "b": "x", "i": 0}, {"a": 2, "b": "y", "i": 1}]
    with pytest.raises(ValueError):
        runs({"a": [1, 2], "b": [1]})


def test_repeat_query(spark):
    spark.range(3).createOrReplaceTempView("table_a")
    spark.range(5).createOrReplaceTempView("table_b")
    got = repeat_query(
        spark, "SELECT COUNT(*) AS files, :i AS j FROM IDENTIFIER(:t) WHERE id >= :least",
        {"t": ["table_a", "table_b"], "least": [1, 4]}, task="stats_${i}_$other",
    )
    assert sorted((r["task_name"], r["task_index"], r["files"], r["j"]) for r in got.collect()) == [
        ("stats_0_$other", 0, 2, 0), ("stats_1_$other", 1, 1, 1),
    ]
    with pytest.raises(ValueError):
        repeat_query(spark, "SELECT 1", {"t": ["a", "b"]}, task="same")


# formats

@pytest.fixture(scope="module")
def series(spark):
    df = spark.createDataFrame([(66, "series1", 0), (34, "sérié \"2\"", 1), (28, None, 2)], "metric bigint, attr string, n int")
    return to_metrics(df, "Snow", attributes=["attr"], ts=F.lit(AT), seq="n")


def test_lines(series):
    assert values(json_lines(series)) == [
        '{"metric":66,"attr":"series1"}', '{"metric":34,"attr":"sérié \\"2\\""}', '{"metric":28,"attr":null}',
    ]
    assert values(json_lines(series, width=20)) == ['{"metric":66,"att...', '{"metric":34,"att...', '{"metric":28,"att...']
    assert values(json_lines(series, width=30))[0] == '{"metric":66,"attr":"series1"}'


def test_lines_of_any_field_name(spark):
    df = spark.createDataFrame([(1, 2.5, 3, 4, 5, 6, "}x")], "a int, b double, c int, d int, e int, f int, k string")
    wide = to_metrics(df, "t", "[a-f]")
    assert [json.loads(v) for v in values(json_lines(wide))] == [
        {n: float(v), "k": "}x"} for n, v in zip("abcdef", (1, 2.5, 3, 4, 5, 6))
    ]
    bare = to_metrics(df, "t", "[a-f]", attributes=[])
    assert json.loads(values(json_lines(bare))[1]) == {"b": 2.5}
    none = to_metrics(df.select("k"), "t", None, allow_none=True)
    assert values(json_lines(none)) == ['{"k":"}x"}']
    text = map_values(wide, {1: "x}"}, "metric", missing="original")
    assert json.loads(values(json_lines(text))[0]) == {"a": "x}", "k": "}x"}
    joined = wide.unionByName(to_metrics(df, "u", "b", attributes=["k"]))
    assert json.loads(values(json_lines(joined))[-1]) == {"b": 2.5, "k": "}x"}


def test_union_of_frames_keeps_each_name(spark):
    a = to_metrics(spark.createDataFrame([(1, "x")], "a int, k string"), "t", "a")
    b = to_metrics(spark.createDataFrame([(2, "y")], "b int, k string"), "t", "b")
    both = a.unionByName(b)
    assert [json.loads(v) for v in values(json_lines(both))] == [{"a": 1, "k": "x"}, {"b": 2, "k": "y"}]
    assert [json.loads(v)["data"] for v in values(envelope(both, "p"))] == [{"a": 1, "k": "x"}, {"b": 2, "k": "y"}]


def test_envelopes(series):
    got = values(envelope(shift_time(series, "1d"), "me", "dev", "snw", {"some": 2, "type": "own"}))
    assert got[0] == (
        '{"data":{"attr":"series1","metric":66},"environment":"dev","producer":"me","some":2,'
        '"timestamp":1714953600.000000,"type":"own","type_prefix":"snw"}'
    )
    assert [json.loads(v)["data"]["metric"] for v in got] == [66, 34, 28]
    named = json.loads(values(envelope(series, "me", name_field="field"))[2])
    assert named["data"] == {"attr": None, "field": "metric", "metric": 28}
    assert (named["type"], named["type_prefix"], named["environment"]) == ("Snow", "raw", "default")


def test_arrays_and_documents(spark, series, tmp_path):
    batch = json_lines(series).withColumn("batch_id", (F.col("seq") / 2).cast("int"))
    got = {r["batch_id"]: (r["n_rows"], json.loads(r["payload"])) for r in json_arrays(batch, "batch_id", "seq").collect()}
    assert got[0] == (2, [{"metric": 66, "attr": "series1"}, {"metric": 34, "attr": 'sérié "2"'}]) and got[1][0] == 1
    assert json.loads(values(documents(series, "at"))[0])["at"] == "2024-05-06T07:08:09.000000Z"
    assert write_documents(series, str(tmp_path / "d"), "at") == 3
    assert write_lines(series, str(tmp_path / "l"), width=9) == 3
    assert sorted(r["metric"] for r in spark.read.json(str(tmp_path / "d")).collect()) == [28, 34, 66]


def test_documents_equal_the_written_rows(spark, tmp_path):
    payload = [{"metric": i, "index": f"doc_{i}", "env": "test"} for i in range(20)]
    df = spark.createDataFrame([(p["metric"], p["index"], p["env"]) for p in payload], "metric int, index string, env string")
    assert write_documents(to_metrics(df, "t"), str(tmp_path / "d")) == 20
    got = spark.read.text(str(tmp_path / "d"))
    assert sorted((json.loads(v) for v in values(got)), key=lambda d: d["metric"]) == payload


def test_sent_batches_are_bounded(spark, tmp_path):
    folder = str(tmp_path)

    def send(batch):
        with open(os.path.join(folder, batch[0]), "w") as f:
            f.write("\n".join(batch))

    send_batches(spark.range(0, 100, 1, 3).select(F.col("id").cast("string").alias("value")), send, "16/1s")
    sent = [open(tmp_path / n).read().split("\n") for n in os.listdir(tmp_path)]
    assert max(map(len, sent)) == 16 and sorted(int(v) for b in sent for v in b) == list(range(100))


# flows

def test_flow_runs_into_accepting_outputs(spark, tmp_path):
    source = spark.createDataFrame([(0, "a"), (4, "b"), (9, "c")], "metric int, k string")
    empty = Task("nothing", source.limit(0), "db")
    one = Task("Stats_A", lambda s: source, "DB", ts=F.lit(AT), modifiers=Modifiers(offset="1h"))
    flow = Flow(
        [one, empty],
        [Transform(lambda df: simple_filter(df, "gt 0"), Route(include_inputs="db"))],
        [
            Output(documents_to(str(tmp_path / "docs"), "at"), Route(include_tasks="x-stats*"), Modifiers("1d")),
            Output(table_to(str(tmp_path / "table")), modifiers=Modifiers(0)),
            Output(lines_to(str(tmp_path / "lines")), Route(exclude_inputs="db")),
            Output(lines_to(str(tmp_path / "off")), enabled=False),
        ],
        task_prefix="x-",
    )
    assert [t.name for t in flow.tasks] == ["x-stats_a", "x-nothing"]
    for _ in range(2):
        assert flow.run(spark, "r1") == {"x-stats_a": FINISHED, "x-nothing": SKIPPED}
    docs = [json.loads(v) for v in values(spark.read.text(str(tmp_path / "docs")))]
    assert sorted(d["metric"] for d in docs) == [4, 9] and {d["at"] for d in docs} == {"2024-05-06T00:00:00.000000Z"}
    kept = spark.read.parquet(str(tmp_path / "table")).collect()
    assert len(kept) == 2 and {r["metric_ts"] for r in kept} == {AT - dt.timedelta(hours=1)}
    assert not (tmp_path / "lines").exists() and not (tmp_path / "off").exists()
    assert Flow([one], outputs=flow.outputs, disable_outputs=True).sinks(one) == []
    assert flow.unmatched() == []
    odd = Flow([one], [Transform(lambda df: df, Route(include_tasks=["stats*", "q*"], exclude_inputs="web"))])
    assert odd.unmatched() == [("task", "q*"), ("input", "web")]
    with pytest.raises(ValueError):
        Flow([one, one])


def test_modifiers_chain(spark):
    df = to_metrics(spark.createDataFrame([(1,)], "metric int"), "t", ts=F.lit(AT))
    got = Modifiers("1d").apply(Modifiers(offset="1h:1m").apply(df))
    assert values(got, "metric_ts") == [dt.datetime(2024, 5, 6)]


# streams

def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).alias("metric"), F.col("id").alias("k"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    task = Task("s", rows, ts=F.lit(AT), attributes=["k"])
    flow = Flow(
        [task], [Transform(lambda df: map_values(simple_filter(df, "ge 3"), {3: 30}, "metric", missing="original"))],
        [Output(documents_to(str(tmp_path / "docs"))), Output(table_to(str(tmp_path / "table")))],
    )
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_stream(flow, task, stream, str(tmp_path / "cp")).awaitTermination()
    folders = [n for n in os.listdir(tmp_path / "table") if n.startswith("run=")]
    assert len(folders) >= 2
    want = sorted((r["metric"], r["attributes"]["k"]) for r in flow.plan(task, rows).collect())
    got = spark.read.parquet(str(tmp_path / "table"))
    assert sorted((r["metric"], r["attributes"]["k"]) for r in got.collect()) == want
    assert len(values(spark.read.text(str(tmp_path / "docs")))) == len(want)


def test_interval_counts_equal_batch(spark, tmp_path):
    at = F.timestamp_seconds(F.col("id") * 37 + 1_700_000_000)
    rows = spark.range(500).select(at.alias("ts"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("key"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = interval_counts(stream, "ts", "10 minutes", ["key"], late="1 day")
    write_updates(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = latest_updates(spark.read.parquet(str(tmp_path / "out")), ["window_start", "window_end", "key"])
    want = rows.groupBy(F.window("ts", "10 minutes").start.alias("s"), "key").count()
    assert sorted((r["window_start"], r["key"], r["n"]) for r in got.collect()) == sorted(map(tuple, want.collect()))


def test_topics(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"metric": 1, "k": "x"}\n{"metric": 2, "k": "y"}\n')
    stream = read_topic(spark, "metric INT, k STRING", "text", {"path": str(tmp_path / "in")})
    frame = to_metrics(stream, "t", ts=F.lit(AT), drop_absent=True)
    sent = write_topic(json_lines(frame), str(tmp_path / "cp"), "text", {"path": str(tmp_path / "out")})
    sent.trigger(availableNow=True).start().awaitTermination()
    assert sorted(values(spark.read.text(str(tmp_path / "out")))) == ['{"metric":1,"k":"x"}', '{"metric":2,"k":"y"}']


def test_workspace_uses_the_session_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    a, b = workspace(spark, "x"), workspace(spark, "x")
    assert a.startswith(before or "/") and a != b


def test_lookup_and_mapping_on_a_stream(spark, tmp_path):
    """Transforms applied to the stream itself, against a static table."""
    rows = spark.range(30).select((F.col("id") % 5).alias("metric"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("k"))
    rows.write.parquet(str(tmp_path / "in"))
    dim = spark.createDataFrame([("k0", "zero"), ("k1", "one")], "id string, word string")

    def plan(df):
        frame = simple_filter(to_metrics(df, "s", ts=F.lit(AT)), "gt 0")
        frame = map_values(frame, {1: 10}, "metric", missing="original")
        return json_lines(enrich(frame, dim, "k", "id", include=["word"], defaults={"word": "none"}))

    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    writer = plan(stream).writeStream.format("text").option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(values(spark.read.text(str(tmp_path / "out")))) == sorted(values(plan(rows)))
