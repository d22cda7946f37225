"""Split exports that load again, their manifest, and the one-scan profile."""

import json
import os
import random

from pyspark.sql import functions as F

from chatloom.operators import profile as P
from chatloom.operators import trainlog as G
from chatloom.sources import files as FS
from chatloom.sources import sinks as S


def test_export_is_one_file_a_split_and_loads_again(spark, tmpdir_fresh):
    rows = [(f"q{i}é\n", None if i % 3 else "x", f"a{i}", s) for i, s in enumerate(["train"] * 50 + ["test"] * 7 + [None] * 2 + ["a/b"])]
    df = spark.createDataFrame(rows, "instruction string, input string, output string, split string").repartition(1)
    path = f"{tmpdir_fresh}/out"
    manifest = S.export_dataset(df, path, "demo").first()
    assert sorted(os.listdir(path)) == sorted(x for f in ("a%2Fb.jsonl", "dataset_info.json", "default.jsonl", "test.jsonl", "train.jsonl")
                                              for x in (f,)) or {f for f in os.listdir(path) if not f.startswith(".")} == {
        "a%2Fb.jsonl", "dataset_info.json", "default.jsonl", "test.jsonl", "train.jsonl"}
    assert (manifest.total_samples, manifest.files, manifest.dataset) == (60, 4, "demo")
    assert {c.split: c.n for c in manifest.split_counts} == {None: 2, "a/b": 1, "test": 7, "train": 50}
    with open(f"{path}/train.jsonl", encoding="utf-8") as f:
        lines = [json.loads(x) for x in f]
    assert len(lines) == 50 and "é" in open(f"{path}/test.jsonl", encoding="utf-8").read()
    assert sorted(lines[0]) == ["input", "instruction", "output", "split"]     # nulls are written too
    res = FS.scan_directory(spark, path)
    got = res.samples.collect()
    assert len(got) == 60 and {r.format for r in got} == {"alpaca"} and {r.source for r in got} >= {"train.jsonl:0", "test.jsonl:6"}
    status = {os.path.basename(r.file_path): r.format for r in res.files.collect()}
    assert status["train.jsonl"] == "alpaca" and status["dataset_info.json"] == "json"
    res.release()
    assert S.read_split_export(spark, path).count() == 60


def test_large_splits_are_numbered_and_exports_replace(spark, tmpdir_fresh):
    df = spark.range(100).select("id", F.lit("train").alias("split")).repartition(3)
    path = f"{tmpdir_fresh}/out"
    names = S.export_splits_jsonl(df, path, max_records_per_file=10)
    assert names == {"train": [f"train-{i:05d}.jsonl" for i in range(len(names["train"]))]} and len(names["train"]) >= 10
    assert S.read_split_export(spark, path).select("id").distinct().count() == 100
    one = f"{tmpdir_fresh}/one"
    for k in (5, 3):
        assert S.export_splits_jsonl(spark.range(k).select("id", F.lit("s").alias("split")).coalesce(1), one) == {"s": ["s.jsonl"]}
    assert S.read_split_export(spark, one).count() == 3
    assert S.export_splits_jsonl(df.where("false"), f"{tmpdir_fresh}/none") == {}


def test_profile_equals_the_single_statistics(spark, tmpdir_fresh):
    items = [{"instruction": f"i{i}" * 60, "input": "", "output": "o"} for i in range(20)]
    with open(f"{tmpdir_fresh}/a.jsonl", "w") as f:
        f.write("\n".join(map(json.dumps, items)))
    with open(f"{tmpdir_fresh}/b.txt", "w") as f:
        f.write("some text")
    res = FS.scan_directory(spark, tmpdir_fresh)
    s = res.samples
    rows = P.profile(s).collect()
    by = lambda k: {r.key: r.n_samples for r in rows if r.by == k}
    assert by("format") == {r.format: r.n_samples for r in P.load_stats(s).collect()}
    assert by("source") == {r.source: r.n_samples for r in P.stats_by_source(s).collect()}
    assert by("type") == {r.type: r.n_samples for r in P.stats_by_type(s).collect()}
    total = next(r for r in rows if r.by == "total")
    want, mix = P.sample_preview(s).first(), P.corpus_composition(s).first()
    assert (total.n_samples, total.preview, total.n_dialogs, total.n_texts) == (want.total, want.preview, mix.n_dialogs, mix.n_texts)
    assert len(total.preview) == 103 and total.kinds == ["dialog", "text"] and all(r.preview is None for r in rows if r.by != "total")
    assert [(r.by, r.n_samples) for r in P.profile(s.where("false")).collect()] in ([], [("total", 0)])
    res.release()


def test_best_epochs_of_a_long_run(spark):
    rng = random.Random(3)
    rows = [(r, e, rng.choice([round(rng.random() * 50 / (1 + e % 300), 2), float("nan"), None] if rng.random() < 0.1 else [round(rng.random() * 9, 1)]), 1)
            for r, n in ((0, 2000), (1, 30), (2, 1)) for e in range(n)]
    df = spark.createDataFrame(rows, "run_id long, epoch long, epoch_loss double, n_steps long")
    want = []
    for run in (0, 1, 2):
        best = None
        mine = [(e, x) for r, e, x, _ in rows if r == run]
        real = [x for _, x in mine if x is not None and x == x]
        for e, x in mine:
            if best is None or (x is not None and (x < best or best != best and x == x)):
                want.append((run, e, x is not None and x == min(real)))
            if x is not None and (best is None or best != best or x < best):
                best = x
    got = [(r.run_id, r.epoch, bool(r.is_best)) for r in G.best_epochs(df.repartition(5)).orderBy("run_id", "epoch").collect()]
    assert got == want
