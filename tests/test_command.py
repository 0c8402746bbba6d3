"""The command line, end to end."""

import json

from rowtide.__main__ import main
from rowtide.session import shared_dir
from tests.test_operators import event

SMALL = ["--conf", "spark.sql.adaptive.coalescePartitions.initialPartitionNum=8"]


def test_control_batch_and_stream(spark, capsys):
    root = shared_dir(spark, "cli")
    items = [{"database": "s", "table": "a", "table_id": "id", "last_date": "2024-01-01", "first_load": True}]
    spark.createDataFrame([(json.dumps(i),) for i in items], "value string").write.text(f"{root}/rows")
    names = "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string"
    spark.createDataFrame([("s", "a", "id", "int"), ("s", "a", "v", "varchar")], names).write.parquet(f"{root}/catalog")
    spark.createDataFrame([(1, "snap")], "id int, v string").write.parquet(f"{root}/snap/s/a")
    spark.createDataFrame([(event("a", id=2, v="x"),)], "value string").write.text(f"{root}/in")

    assert main(["control", "--root", f"{root}/batch", "--rows", f"{root}/rows", *SMALL]) == 0
    common = ["--catalog", f"{root}/catalog", "--buckets", "2", *SMALL]
    assert main(["batch", "--root", f"{root}/batch", *common, "--snapshots", f"{root}/snap/{{database}}/{{table}}", "--changes", f"{root}/none"]) == 0
    assert [(r.id, r.v) for r in spark.table("hudi_s.a").collect()] == [(1, "snap")]
    # the next day has no change files yet: the table is reported and does not move on
    assert main(["batch", "--root", f"{root}/batch", *common, "--snapshots", "unused", "--changes", f"{root}/none", "--all-days"]) == 0
    assert "not there yet" in capsys.readouterr().err

    stream = ["stream", "--root", f"{root}/lake", "--control-root", f"{root}/batch", *common, "--format", "text"]
    assert main([*stream, "--path", f"{root}/in", "--checkpoint", f"{root}/c", "--every", "0"]) == 0
    assert [(r.id, r.v) for r in spark.table("hudi_s.a").collect()] == [(2, "x")]
