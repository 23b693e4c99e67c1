"""Damaged call logs: every line is a call or a reject, with its file."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.sources import read_call_log, read_call_log_stream

GOOD = {"install_id": 1, "ts": "2024-05-01T10:00:00.123456", "seq": 1, "op": "track", "category": "ui", "name": "open", "properties": {"a": "1"},
        "source_app": "app", "unknown": 5}
LINES = [json.dumps(GOOD), "", '{"install_id": 2, "seq": 4', "no json", "[1, 2]", "7", "null", json.dumps({**GOOD, "seq": None}),
         json.dumps({**GOOD, "seq": "x"}), json.dumps({**GOOD, "ts": "yesterday"}), json.dumps({"install_id": 3}), "  "]


def test_json_lines(spark):
    d = tempfile.mkdtemp(prefix="fs-log-")
    for i, lines in enumerate((LINES, [json.dumps({**GOOD, "seq": 2})])):
        with open(os.path.join(d, f"part{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
    calls, rejects = read_call_log(spark, d, "json")
    got = calls.orderBy("seq").collect()
    assert [(r.seq, r.ts.microsecond, r.properties, os.path.basename(r.source_file)) for r in got] == [
        (1, 123456, {"a": "1"}, "part0.json"), (2, 123456, {"a": "1"}, "part1.json")]
    assert [f.name for f in calls.schema] == [f.name for f in schemas.CALLS] + ["source_file"]
    bad = {(r.reason, r.raw) for r in rejects.collect()}
    assert rejects.count() == 9
    assert bad >= {("malformed_record", LINES[2]), ("malformed_record", "no json"), ("malformed_record", LINES[8]), ("malformed_record", LINES[9]),
                   ("missing_field", None)}
    assert {r.install_id for r in rejects.filter("reason = 'missing_field'").collect()} >= {1, 3}
    assert rejects.filter(~F.col("source_file").endswith("part0.json")).isEmpty()


def test_stream_and_parquet(spark):
    d = tempfile.mkdtemp(prefix="fs-log-")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write("\n".join(LINES))
    for k, part in enumerate(read_call_log_stream(spark, d, "json", max_files=1)):
        name = f"log_{k}"
        part.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == (1, 9)[k]
    p = tempfile.mkdtemp(prefix="fs-log-")
    calls, _ = read_call_log(spark, d, "json")
    calls.drop("source_file").unionByName(calls.drop("source_file").withColumn("op", F.lit(None).cast("string"))).write.mode("overwrite").parquet(p)
    ok, bad = read_call_log(spark, p)
    assert ok.count() == 1 and [(r.reason, r.seq, r.op) for r in bad.collect()] == [("missing_field", 1, None)]
