import json
import os

import pytest

from stratus import cli
from stratus.sources.lake import write_partitioned
from stratus.sources.messages import encode_messages, untidy_messages
from stratus.sources.observations import observations

SF = "/root/testdata/sf0.001"


def run(capsys, *argv):
    cli.main(list(argv))
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_cli_batch_commands(spark, tmp_dir, capsys):
    obs = observations(spark, SF)
    table = os.path.join(tmp_dir, "weather_events")
    write_partitioned(obs, table, mode="overwrite")
    n = obs.count()

    out = run(capsys, "analytics", "--table", table, "--out", os.path.join(tmp_dir, "analytics"))
    assert out["jobs_run"] == 8 and out["records_processed"] == n

    out = run(capsys, "models", "--table", table, "--mart", os.path.join(tmp_dir, "mart"))
    assert out["rows"] > 0

    with pytest.raises(SystemExit) as failed:  # humidity > 100 on some rows
        cli.main(["quality", "--table", table])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert failed.value.code == 1 and out["rules"] == 14 + 6 + 2 + 5
    assert {r["column_name"] for r in out["failed"]} == {"humidity"}

    out = run(capsys, "maintain", "--table", table, "--compacted", os.path.join(tmp_dir, "compacted"))
    assert out["report"]["after"]["num_files"] >= 1


def test_cli_route_and_ingest(spark, tmp_dir, capsys):
    obs = observations(spark, SF, with_parts=False)
    raw_dir = os.path.join(tmp_dir, "raw")
    untidy_messages(obs).select("value").write.text(raw_dir)
    out = run(capsys, "route", "--raw", raw_dir, "--out", os.path.join(tmp_dir, "topics"))
    topics = spark.read.parquet(out["out"]).groupBy("topic").count().collect()
    counts = {r["topic"]: r["count"] for r in topics}
    assert counts["raw_weather_stream"] == obs.count()
    assert counts["validated_weather_stream"] + counts["invalid_weather_stream"] == obs.count()

    src = os.path.join(tmp_dir, "messages")
    encode_messages(obs, broken_every=None).write.parquet(src)
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    out = run(capsys, "ingest", "--source", src, "--sink", sink, "--checkpoint", ckpt, "--available-now")
    assert spark.read.parquet(sink).count() == obs.count()


def test_cli_ingest_dedup_and_enrich_modes(spark, tmp_dir, capsys):
    from stratus.operators.enrich import with_replay
    obs = observations(spark, SF, with_parts=False)
    src = os.path.join(tmp_dir, "messages")
    # the table and a replay of it in one batch: dedup keeps one row per (city, recorded_at)
    encode_messages(with_replay(obs), broken_every=None).write.parquet(src)
    for mode, expected in (("dedup", obs.count()), ("enrich", obs.count())):
        sink, ckpt = os.path.join(tmp_dir, mode, "sink"), os.path.join(tmp_dir, mode, "ckpt")
        run(capsys, "ingest", "--source", src, "--sink", sink, "--checkpoint", ckpt,
            "--available-now", "--mode", mode)
        back = spark.read.parquet(sink)
        assert back.count() == expected, mode
        if mode == "enrich":
            assert {"temperature_category", "heat_index", "wind_category", "query_id", "batch_id"} <= set(back.columns)
