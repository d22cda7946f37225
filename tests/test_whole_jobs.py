"""Queries that once did a part of their job, or held more than their share of it at a time."""

import duckdb

from chatloom.plans import queries_train as Q
from chatloom.plans import registry

TURNS = "conv_id long, turn long, role string, text string"


def oracle(name, folder, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in con.sql(registry.oracle_sql()[name]).fetchall())


def rows_of(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_temperature_scales_every_successor_of_every_context(spark, tmpdir_fresh):
    pairs = "".join("a" + chr(0x100 + i % 60) * (1 + i % 60 % 2) + ("a" if i % 60 % 2 else "") for i in range(600))
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", pairs), (1, 0, "user", "q"), (1, 1, "assistant", "short"), (2, 0, "user", "no answer")]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmpdir_fresh}/conversations.parquet")
    got = rows_of(Q.q_apply_temperature(spark, tmpdir_fresh))
    assert got == oracle("apply_temperature", tmpdir_fresh, "conversations")
    assert max(sum(r[0] == c for r in got) for c in {r[0] for r in got}) > 50  # more than the first fifty candidates


def test_kernels_look_at_bounded_slices_of_a_batch(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from chatloom.functions import kernels as K
    dialog = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))
    turns = [[("user", "q" * 300), ("assistant", None)], None, [], [("user", "x")] * 50, [("assistant", "é<eos>" * 40)]] * 40
    batch = pa.RecordBatch.from_arrays(
        [pa.array([str(i) for i in range(200)]), pa.array(["dialog"] * 200), pa.array([None, "text " * 30] * 100),
         pa.array([None if t is None else [{"role": r, "content": c} for r, c in t] for t in turns], dialog)],
        names=["sample_id", "kind", "text", "dialog"])
    lookup = K.CharLookup("qxté", [7, 8, 9, 10])
    whole = list(K.iter_samples(batch, lookup, False))
    monkeypatch.setattr(K.row_slices, "__defaults__", (1000,))
    parts = list(K.sample_slices(batch))
    assert len(parts) > 20 and max(p.num_rows for p in parts) < 20
    got = [s for p in parts for s in K.iter_samples(p, lookup, False)]
    assert [(a, b, t.tolist()) for a, b, t in got] == [(a, b, t.tolist()) for a, b, t in whole]
    got = [(a, np.concatenate(list(c)).tolist()) for p in parts for a, _, c in K.iter_sample_chunks(p, lookup, False)]
    assert got == [(a, t.tolist()) for a, _, t in whole]


def test_a_task_counts_small_pairs_once_and_large_ones_by_slice(monkeypatch):
    import pyarrow as pa

    from chatloom.functions import kernels as K
    from chatloom.operators import bigram as BG
    monkeypatch.setattr(K.row_slices, "__defaults__", (40,))
    ids = [[i % 5, (i * i) % 7, 3, i % 2] for i in range(100)]
    for far in (0, 70_000):
        batch = pa.RecordBatch.from_arrays([pa.array([[x + far for x in r] for r in ids], pa.list_(pa.int32()))] * 2
                                           + [pa.array([[0, 1, 1, 0]] * 100, pa.list_(pa.int8()))], names=["a", "b", "c"])
        for masked in (False, True):
            out = list(BG._pair_count_kernel(masked)([batch.slice(0, 60), batch.slice(60)]))
            assert (len(out) == 1) == (far == 0)  # one batch a task, or one a slice
            n, want = {}, {}
            for b in out:
                for p, t, k in zip(*(c.to_pylist() for c in b.columns)):
                    n[p, t] = n.get((p, t), 0) + k
            for r in ids:
                for x in (r[1:3] if masked else r):
                    want[x + far, x + far] = want.get((x + far, x + far), 0) + 1
            assert n == want


def test_penalised_logits_that_meet_others_are_ordered_by_token():
    import numpy as np

    from chatloom.operators import sampling as H
    prevs, starts, tokens, logits = H.candidate_arrays(np.zeros(4, int), np.array([5, 3, 9, 1]), np.array([2.0, 4.0, 2.0, 1.0]))
    recent = np.array([[3, -1], [9, 3], [-1, -1]])
    got = H.sample_contexts(tokens, logits, recent, np.array([3, 5, 3]), np.full(3, 0.999), 2.0, 3, 1.0)
    assert got["drawn"].tolist() == [9, 9, 9] and got["top_kept"].tolist() == [3, 4, 3]
    few = H.sample_contexts(tokens, logits, recent, None, None, 2.0, 3, 1.0, ("hits", "cut"))
    assert set(few) == {"hits", "cut"} and few["hits"].tolist() == [1, 2, 0] and few["cut"].tolist() == [2.0, 3.0, 0.0]


def tables(spark, folder):
    rows = [(c, t, r, f"{r} {c} {t}") for c in range(70) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{folder}/conversations.parquet")
    docs = [(i, None if i == 3 else f"text {i}\nline", "en") for i in range(3000)] + [(None, "no id", "en"), (5, "text 5\nline", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")


def test_a_query_writes_only_the_part_of_the_tree_that_it_reads(spark, tmpdir_fresh):
    import os

    from chatloom.plans import queries_files as QF
    tables(spark, tmpdir_fresh)
    assert len(QF.q_read_jsonl(spark, tmpdir_fresh).where("ordinal_ok").collect()) == 70
    root = QF.build_tree(spark, tmpdir_fresh, "sgpt").removeprefix("file:")
    assert os.listdir(root) == ["sgpt"]
    got = {r.format: r.n_samples for r in QF.q_scan_directory(spark, tmpdir_fresh).collect()}
    assert got == {"sharegpt": 70, "moss": 70, "alpaca": 140, "txt": 48}
    assert sorted(os.listdir(root)) == ["alpaca", "docs", "misc", "moss", "sgpt"]


def test_a_scan_holds_no_parse_and_its_report_no_record(spark, tmpdir_fresh):
    from chatloom.sources import files as FS
    spark.createDataFrame([('{"id": 1, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',)], "value string") \
        .write.text(f"{tmpdir_fresh}/in")
    from chatloom.sources.fs import rename_suffix
    rename_suffix(spark, f"{tmpdir_fresh}/in", ".txt", ".jsonl")
    res = FS.scan_directory(spark, f"{tmpdir_fresh}/in")
    assert "_v" not in res.records.columns
    assert "InMemoryTableScan" not in res.files._jdf.queryExecution().executedPlan().toString()
    assert res.samples.count() == 1 and [r.format for r in res.files.collect() if r.format != "unknown"] == ["sharegpt"]
    res.release()


def test_streamed_text_files_lie_in_one_folder(spark, tmpdir_fresh, monkeypatch):
    import os

    from chatloom.plans import queries_stream as QS
    tables(spark, tmpdir_fresh)
    root = f"{tmpdir_fresh}/stream"
    monkeypatch.setattr(QS, "work_dir", lambda spark, name: root)
    rows = QS.q_incremental_load(spark, tmpdir_fresh).collect()
    assert sum(r.format == "txt" for r in rows) == 48 and sum(r.format == "moss" for r in rows) == 70
    found = [os.path.join(root, "in/texts", x) for x in os.listdir(f"{root}/in/texts")]
    assert not any(map(os.path.isdir, found))
    texts = sorted(open(x).read() for x in found if x.endswith(".txt"))
    assert "no id\n" in texts and any(t.startswith("text 0\nline\ntext 1\nline\ntext 2\nline\n\ntext 4\nline\ntext 5\nline\ntext 5\nline\n") for t in texts)
