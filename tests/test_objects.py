import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowframe.sinks.objects import StageWriter, finish_writes, write_objects

ROOT = Path(__file__).resolve().parent.parent

#: A store on local files that keeps metadata beside them, and fails once where it is told to.
STORE = '''
import os
from pyarrow import fs

class Store:
    opened = 0

    def __init__(self):
        self.files = fs.LocalFileSystem()

    def __getattr__(self, name):
        return getattr(self.files, name)

    def fail(self, when):
        mark = os.environ["FAIL_MARK"] + when
        if os.environ.get("FAIL_AT") == when and not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("lost")

    def open_output_stream(self, path, metadata=None):
        if not path.endswith("list.json"):
            Store.opened += 1
            if Store.opened > 1:
                self.fail("stage")
        if metadata:
            with open(path + ".meta", "w") as out:
                out.write(repr(sorted(metadata.items())))
        return self.files.open_output_stream(path)

    def move(self, source, target):
        if os.path.exists(source + ".meta"):
            os.replace(source + ".meta", target + ".meta")
        self.files.move(source, target)
        self.fail("publish")

def store(uri):
    return Store(), uri.removeprefix("file:")
'''

RUN = '''
import json, sys
from pyspark.sql import SparkSession
from flowframe.sinks.objects import write_objects
root, exists = sys.argv[1:3]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", root + "-scratch").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(60).selectExpr("concat('f', id % 6, '.txt') AS name", "CAST(id AS STRING) AS content", "id", "map('acl', concat('a', id)) AS facts")
try:
    out = write_objects(rows, root, ["name"], exists=exists, order_by=["id"], line_end="\\n", metadata="facts", store="kept_store:store")
    print("OUT" + json.dumps(sorted((r["path"].rsplit("/", 1)[1], r["rows"], r["size"], r["outcome"]) for r in out.collect())))
except Exception as error:
    print("OUT" + json.dumps("FileExistsError" in str(error)))
'''


@pytest.mark.parametrize("fail_at", ["stage", "publish"])
def test_tasks_that_die_leave_each_row_once(tmp_path, fail_at):
    (tmp_path / "kept_store.py").write_text(STORE)

    def run(root, exists, fails=True):
        env = os.environ | {"PYTHONPATH": f"{tmp_path}:{ROOT}", "FAIL_MARK": f"{root}-{exists}-mark-", "FAIL_AT": fail_at if fails else ""}
        done = subprocess.run([sys.executable, "-c", RUN, str(root), exists], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
        line, = [x for x in done.stdout.splitlines() if x.startswith("OUT")]
        assert not fails or Path(f"{root}-{exists}-mark-{fail_at}").exists()
        assert not list(Path(root).glob(".staging-*"))
        return json.loads(line[3:])

    def lines(root):
        return {x.name: x.read_text().splitlines() for x in Path(root).glob("*.txt")}

    once = {f"f{k}.txt": [str(i) for i in range(k, 60, 6)] for k in range(6)}
    root = tmp_path / "a"
    out = run(root, "replace")
    assert [x[:2] + x[3:] for x in out] == [[name, 10, "written"] for name in sorted(once)]
    assert lines(root) == once and (root / "f3.txt.meta").read_text() == "[('acl', 'a3')]"
    if fail_at == "stage":
        assert run(root, "append") == out and lines(root) == {k: v + v for k, v in once.items()}
        (root / "f2.txt").unlink()
        assert {x[3] for x in run(root, "ignore", fails=False)} == {"written", "ignored"}
        assert lines(root) == {k: v if k == "f2.txt" else v + v for k, v in once.items()}
        assert run(tmp_path / "b", "fail") == out and lines(tmp_path / "b") == once
        (tmp_path / "b/f0.txt").unlink()
        before = lines(tmp_path / "b")
        assert run(tmp_path / "b", "fail", fails=False) is True and lines(tmp_path / "b") == before


def test_many_rows_for_one_name(spark, tmp_path):
    rows = spark.range(200).repartition(8).selectExpr("'one.txt' AS name", "CAST(id AS STRING) AS content", "id")
    for exists, times in (("replace", 1), ("replace", 1), ("append", 2), ("ignore", 2)):
        write_objects(rows, str(tmp_path), ["name"], exists=exists, order_by=["id"], line_end="\n")
        assert (tmp_path / "one.txt").read_text().split() == [str(i) for i in range(200)] * times


def test_shares_and_the_order_without_one(spark, tmp_path):
    rows = spark.range(25).selectExpr("IF(id < 20, 'a/one.tar', 'plain') AS name", "CAST(id AS STRING) AS content", "-id AS down")
    out = write_objects(rows, str(tmp_path), ["name"], order_by=["down"], line_end=",", share_rows=8)
    assert {x["path"].split(f"{tmp_path}/")[1]: x["rows"] for x in out.collect()} == {
        "a/one-00000.tar": 8, "a/one-00001.tar": 8, "a/one-00002.tar": 4, "plain-00000": 5,
    }
    assert (tmp_path / "a/one-00002.tar").read_text() == "3,2,1,0,"
    write_objects(rows, str(tmp_path), ["name"], line_end=",")
    assert (tmp_path / "plain").read_text() == "20,21,22,23,24,"


def test_nulls_and_empty_frames(spark, tmp_path):
    rows = spark.createDataFrame([("x", None), ("x", "b"), (None, "cc")], "name string, content string")
    out = write_objects(rows.withColumn("dir", F.when(F.col("name").isNull(), "e").otherwise("d")), str(tmp_path), ["dir", "name"], line_end="\n")
    assert sorted((r["rows"], r["size"]) for r in out.collect()) == [(1, 3), (2, 3)]
    assert (tmp_path / "d/x").read_text() == "\nb\n" and (tmp_path / "e").read_text() == "cc\n"
    assert write_objects(rows.filter("false"), str(tmp_path), ["name"]).collect() == []


def test_a_failed_run_changes_nothing_and_a_lost_driver_is_made_good(spark, tmp_path):
    (tmp_path / "there").write_text("old")
    rows = spark.createDataFrame([("there", "new"), ("other", "new")], "name string, content string")
    with pytest.raises(PySparkException):
        write_objects(rows, str(tmp_path), ["name"], exists="fail")
    assert sorted(x.name for x in tmp_path.iterdir()) == ["there"]
    # Staged and committed, but the driver was lost before it could publish; and one that was not committed.
    import pyarrow as pa

    options = {"exists": "append", "store": "flowframe.plans.scratch:task_store", "lineend": ""}
    for run in ("committed", "open"):
        writer = StageWriter(options | {"folder": f"file:{tmp_path}/.staging-{run}"})
        batch = pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/there"], "data": [run.encode()], "facts": pa.nulls(1, pa.map_(pa.string(), pa.string()))})
        message = writer.write(iter([batch]))
        if run == "committed":
            writer.commit([message, None])
    assert finish_writes(spark, str(tmp_path)) == 1
    assert (tmp_path / "there").read_text() == "oldcommitted" and sorted(x.name for x in tmp_path.iterdir()) == ["there"]
