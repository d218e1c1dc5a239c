"""Steps whose cost must follow their input: scoring, dimension files, frame listings."""

import time

import pandas as pd

from framewise.operators import inference as INF
from framewise.sources import dims as DM
from framewise.sources import mot as MOT


class _Rows:
    sparkSession = None

    def mapInPandas(self, run, schema):
        return run


def test_scored_batches_go_back_together(monkeypatch):
    monkeypatch.setattr(INF, "ship_package", lambda spark: None)
    sizes = []

    def factory():
        def model(pdf):
            sizes.append(len(pdf))
            return pd.DataFrame({"k": pdf["x"] * 2})
        return model

    run = INF.score_in_batches(_Rows(), factory, None, batch_size=32)
    back = list(run([pd.DataFrame({"x": range(100)}), pd.DataFrame({"x": range(5)})]))
    assert [len(b) for b in back] == [100, 5] and sizes == [32, 32, 32, 4, 5]
    assert back[0]["k"].tolist() == [2 * i for i in range(100)]


def test_long_anchor_line(spark, tmp_path):
    n = 30_000
    (tmp_path / "classes").write_text("a\nb\n")
    (tmp_path / "anchors").write_text(",  ".join(f"{i}, {i + 1}" for i in range(n)) + ", 7\nnot read\n")
    start = time.time()
    _, anchors = DM.load_dimensions(spark, str(tmp_path / "classes"), str(tmp_path / "anchors"))
    rows = sorted(anchors.collect())
    assert time.time() - start < 60
    assert len(rows) == n and tuple(rows[-1]) == (n - 1, n - 1.0, float(n))


def test_frame_tree_is_listed_by_tasks(spark, tmp_path):
    for s, f, name in (("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 7, "z.png")):
        d = tmp_path / f"sequence={s}" / f"frame_no={f}"
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_text("1")
    (tmp_path / "sequence=b" / "notes").write_text("no frame")
    deep = tmp_path / "sequence=b" / "frame_no=8" / "more"
    deep.mkdir(parents=True)
    (deep / "x").write_text("no frame")
    idx = MOT.read_frame_index(spark, str(tmp_path), **MOT.FRAME_TREE)
    assert sorted((r.sequence, r.frame_no) for r in idx.collect()) == [("a", 1), ("a", 2), ("a", 2), ("b", 7)]
    # a glob of all files would make each of them a root path of the listing
    assert MOT.FRAME_TREE["recursive"] and "frame_no" not in MOT.FRAME_TREE["glob"]


def test_frame_tree_is_written_by_tasks_without_a_process_a_file(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 7, None), (None, 8, "c"), (3, None, "d")], "sequence int, frame_no long, value string")
    write = type(rows.write).text
    monkeypatch.setattr(type(rows.write), "text", None)  # Spark's writer would go through Hadoop's local file system
    root = tmp_path / "tree"
    MOT.write_frame_tree(rows, f"file://{root}")
    files = sorted(str(f.parent.relative_to(root)) for f in root.rglob("*") if f.is_file())
    none = "__HIVE_DEFAULT_PARTITION__"
    assert files == ["sequence=1/frame_no=5", "sequence=2/frame_no=7", f"sequence=3/frame_no={none}", f"sequence={none}/frame_no=8"]
    assert sorted(next((root / "sequence=1" / "frame_no=5").iterdir()).read_text().split()) == ["a", "b"]
    listed = {(r.sequence, r.frame_no) for r in MOT.read_frame_index(spark, str(root), **MOT.FRAME_TREE).collect()}
    # as the partitioned writer's tree is listed
    monkeypatch.setattr(type(rows.write), "text", write)
    rows.repartition(1).write.partitionBy("sequence", "frame_no").text(str(tmp_path / "spark"))
    assert listed == {(r.sequence, r.frame_no) for r in MOT.read_frame_index(spark, str(tmp_path / "spark"), **MOT.FRAME_TREE).collect()}


def test_listing_takes_a_bounded_number_of_tasks(spark, tmp_path):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    for f in range(60):
        (tmp_path / "sequence=a" / f"frame_no={f}").mkdir(parents=True)
        (tmp_path / "sequence=a" / f"frame_no={f}" / "x").write_text("1")
    idx = MOT.read_frame_index(spark, str(tmp_path), **MOT.FRAME_TREE)
    assert idx.count() == 60 and spark.conf.get(name) == before
    assert idx.rdd.getNumPartitions() <= 8
