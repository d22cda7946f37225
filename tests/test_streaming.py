"""Two waves are each loaded once; stream output equals the batch loader's."""

import json
import os

from chatloom.streaming.incremental import incremental_load, read_samples, read_stats, read_totals, update_totals


def test_incremental_load_two_waves(spark, tmpdir_fresh):
    inp, out, ck = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"
    os.makedirs(inp)
    with open(f"{inp}/a.jsonl", "w") as f:
        f.write(json.dumps({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}) + "\n")
        f.write("\n{broken\n")
    incremental_load(spark, inp, out, ck).awaitTermination()
    with open(f"{inp}/b.jsonl", "w") as f:
        f.write(json.dumps({"instruction": "i", "output": "o"}) + "\n")
    with open(f"{inp}/c.jsonl", "w") as f:
        f.write(json.dumps({"conversation": {"turn_1": {"Human": "h", "MOSS": "m"}}}) + "\n")
    incremental_load(spark, inp, out, ck).awaitTermination()
    incremental_load(spark, inp, out, ck).awaitTermination()      # nothing new: no new batch
    stats = [(r.batch, r.added, r.total) for r in read_stats(spark, out).orderBy("batch").collect()]
    assert stats == [(0, 1, 1), (1, 2, 3)]
    fmts = sorted(r.format for r in read_samples(spark, out).collect())
    assert fmts == ["alpaca", "moss", "sharegpt"]
    q = spark.read.parquet(f"{out}/quarantine").collect()
    assert [r.reason for r in q] == ["bad_json"]


def test_stream_of_lines_equals_batch_with_ids(spark, tmpdir_fresh):
    from chatloom.sources.files import scan_directory
    inp, out, ck = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"
    os.makedirs(inp)
    recs = [{"conversations": [{"from": "human", "value": f"q{i}"}, {"from": "gpt", "value": f"a{i}"}]} for i in range(5)]
    recs += [{"instruction": f"i{i}", "input": "x" if i % 2 else "", "output": f"o{i}"} for i in range(4)]
    with open(f"{inp}/a.jsonl", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs[:5]) + "\n")
    with open(f"{inp}/b.jsonl", "w") as f:
        f.write("\n\n{broken\n".join(json.dumps(r) for r in recs[5:]) + "\n")
    with open(f"{inp}/same.jsonl", "w") as f:  # equal lines, another dialect than the first record's, and a large file
        f.write("\n".join([json.dumps(recs[5])] * 3000 + [json.dumps(recs[0])] + [json.dumps(recs[6])] * 2000))
    incremental_load(spark, inp, out, ck).awaitTermination()
    def norm(df, cols):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())
    res = scan_directory(spark, inp)
    stream = read_samples(spark, out)
    assert norm(stream, res.samples.columns) == norm(res.samples, res.samples.columns)
    assert stream.select("sample_id").distinct().count() == stream.count() == 5 + 4 + 5000
    quar = ["file_path", "ordinal", "raw", "reason"]
    assert norm(spark.read.parquet(f"{out}/quarantine"), quar) == norm(res.quarantine, quar)
    res.release()


def test_totals_after_every_trigger(spark, tmpdir_fresh):
    from chatloom.operators.profile import load_stats
    from chatloom.sources.files import scan_directory
    inp, out, ck = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"
    os.makedirs(inp)
    for wave in range(3):
        with open(f"{inp}/w{wave}.jsonl", "w") as f:
            f.write((json.dumps({"instruction": "i", "output": "o"}) + "\n") * (wave + 2))
        with open(f"{inp}/w{wave}.txt", "w") as f:
            f.write("text")
        incremental_load(spark, inp, out, ck).awaitTermination()
        update_totals(spark, out, f"{ck}-totals").awaitTermination()
        res = scan_directory(spark, inp)
        assert {r.format: r.total for r in read_totals(spark, out).collect()} == {r.format: r.n_samples for r in load_stats(res.samples).collect()}
        res.release()
    update_totals(spark, out, f"{ck}-totals").awaitTermination()  # nothing new
    assert {r.format: r.total for r in read_totals(spark, out).collect()} == {"alpaca": 9, "txt": 3}


def test_stream_json_documents_equal_batch(spark, tmpdir_fresh):
    """Whole ``.json`` files (array, pretty object, JSON lines) stream exactly like the batch reader, ids too."""
    from pyspark.sql import functions as F
    from chatloom.sources.files import scan_directory
    inp, out, ck = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ck"
    os.makedirs(inp)
    arr = [{"instruction": f"i{i}", "input": "", "output": f"o{i}"} for i in range(3)] + [7]
    with open(f"{inp}/arr.json", "w") as f:
        json.dump(arr, f, indent=2)
    with open(f"{inp}/one.JSON", "w") as f:
        json.dump({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, f, indent=2)
    with open(f"{inp}/lines.json", "w") as f:
        f.write(json.dumps({"instruction": "x", "output": "y"}) + "\r\n\n" + json.dumps({"instruction": "z", "output": "w"}) + "\n")
    with open(f"{inp}/c.jsonl", "w") as f:
        f.write(json.dumps({"instruction": "l", "output": "m"}) + "\n")
    incremental_load(spark, inp, out, ck).awaitTermination()
    cols = ["sample_id", "ordinal", "kind", "text", "dialog", "file_path", "type", "turns", "format"]

    def norm(df):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())
    docs = F.lower("file_path").endswith(".json")
    res = scan_directory(spark, inp)
    batch = res.samples.where(docs)
    stream = read_samples(spark, out)
    assert stream.where(docs & (F.col("stream") != "documents")).count() == 0
    assert norm(stream.where(docs)) == norm(batch)
    assert batch.count() == 6
    assert stream.where(~docs).count() == 1

    def quar(df):
        return sorted((r.file_path, r.ordinal, r.reason) for r in df.where(docs).collect())
    q = spark.read.parquet(f"{out}/quarantine")
    assert quar(q) == quar(res.quarantine) and len(quar(q)) == 1       # the scalar item 7
    incremental_load(spark, inp, out, ck).awaitTermination()           # nothing new
    assert read_samples(spark, out).count() == 7
