from __future__ import annotations

import os
import subprocess
import sys

from viewloom.session import cluster_conf, cut_lineage, ensure_checkpoint_dir


def test_partitions_follow_the_data():
    small = cluster_conf(1 << 30, 400)
    large = cluster_conf(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "800"
    assert int(large["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)


def test_cut_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) as s", "array(id) as a")
    cut = cut_lineage(df)
    assert cut.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["id"] for r in cut.collect()) == list(range(10))
    folder = os.path.basename(ensure_checkpoint_dir(spark))
    assert cut.inputFiles() and all(folder in f for f in cut.inputFiles())


def test_named_folder_is_used(tmp_path):
    code = (
        "from viewloom import build_session, cut_lineage\n"
        f"spark = build_session(master='local[1]', conf={{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "print(cut_lineage(spark.range(3)).inputFiles()[0])\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=180, check=True
    )
    assert str(tmp_path) in done.stdout


def test_written_tables_are_removed_but_the_kept_ones(spark):
    import os

    from viewloom.session import cut_lineage, remove_written, written_tables

    before = cut_lineage(spark.range(3))
    mark = written_tables()
    gone, kept = cut_lineage(spark.range(5)), cut_lineage(spark.range(7))
    paths = [df.inputFiles()[0].split(":", 1)[1] for df in (before, gone, kept)]
    remove_written(spark, mark, kept)
    assert written_tables() == mark + 1 and before.count() == 3 and kept.count() == 7
    assert [os.path.exists(p.replace("///", "/")) for p in paths] == [True, False, True]
    remove_written(spark, mark)
    assert written_tables() == mark
