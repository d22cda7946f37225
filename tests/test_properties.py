"""Properties: round trips, window shape, permutation, batches, partition independence, folds."""

from pyspark.sql import functions as F

from chatloom.operators import batches as B
from chatloom.operators import tokenize as tok
from chatloom.operators import trainlog as G
from chatloom.operators.vocab import vocab_from_samples
from chatloom.operators.windows import build_windows
from chatloom.plans.catalog import kept_dialogs
from chatloom.plans.queries_train import train_log

from conftest import SF001, SF01


def _windows(spark, d=SF001):
    s = kept_dialogs(spark, d).cache()
    v = vocab_from_samples(s).cache()
    return s, v, build_windows(s, v)


def test_decode_encode_round_trip(spark):
    s, v, _ = _windows(spark)
    enc = tok.encode_samples(s, v)
    dec = tok.decode_column(enc, "token_ids", v)
    expect = s.select("sample_id", F.concat(F.array_join(F.transform("dialog", lambda t: F.concat(
        F.when(t["role"] == "user", "<user>").when(t["role"] == "assistant", "<assistant>").otherwise(""),
        t["content"])), ""), F.lit("<eos>")).alias("e"))
    bad = dec.join(expect, "sample_id").where(F.col("decoded") != F.col("e")).count()
    assert bad == 0


def test_window_shape_and_pairs(spark):
    _, _, w = _windows(spark)
    r = w.select(F.size("input_ids").alias("a"), F.size("target_ids").alias("b"), F.size("loss_mask").alias("c"),
                 (F.slice("input_ids", 2, 255) == F.slice("target_ids", 1, 255)).alias("shift")).distinct().collect()
    assert [tuple(x) for x in r] == [(256, 256, 256, True)]


def test_mask_only_after_assistant(spark):
    _, _, w = _windows(spark)
    # a masked position is never an <assistant>, <user> or <eos> token
    z = F.arrays_zip("input_ids", "loss_mask")
    bad = w.select(F.explode(z).alias("p")).where((F.col("p.loss_mask") == 1) & F.col("p.input_ids").isin(3, 4, 5))
    assert bad.count() == 0


def test_shuffle_is_permutation_and_batches(spark):
    _, _, w = _windows(spark)
    b = B.batch_windows(w.select("sample_id", "window_no"), seed=7, epochs=2, batch_size=8).cache()
    n = w.count()
    for e in (0, 1):
        x = b.where(F.col("epoch") == e)
        assert x.count() == n and x.select("pos").distinct().count() == n
        assert x.agg(F.min("pos"), F.max("pos")).first() == (0, n - 1)
        sizes = [r[1] for r in x.groupBy("batch_id").count().orderBy("batch_id").collect()]
        assert all(s == 8 for s in sizes[:-1]) and 1 <= sizes[-1] <= 8
    o0 = [r.sample_id for r in b.where("epoch = 0").orderBy("pos").limit(20).collect()]
    o1 = [r.sample_id for r in b.where("epoch = 1").orderBy("pos").limit(20).collect()]
    assert o0 != o1


def test_results_independent_of_partitioning(spark):
    s, v, w = _windows(spark)
    lk = tok.collect_lookup(v)

    def digest(df):
        return df.select(F.sum(F.crc32(F.concat_ws("|", "sample_id", F.col("window_no").cast("string"),
                                                      F.array_join(F.col("input_ids").cast("array<string>"), ","),
                                                      F.array_join(F.col("loss_mask").cast("array<string>"), "")))
                               )).first()[0]
    base = digest(w)
    for n in (1, 3, 16):
        assert digest(build_windows(s.repartition(n), lk)) == base
    pos = [B.batch_windows(w.select("sample_id", "window_no"), 1, 1, 8, ).select(
        F.sum(F.crc32(F.concat_ws("|", "sample_id", F.col("pos").cast("string"))))).first()[0]]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        pos.append(B.batch_windows(w.select("sample_id", "window_no"), 1, 1, 8).select(
            F.sum(F.crc32(F.concat_ws("|", "sample_id", F.col("pos").cast("string"))))).first()[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert pos[0] == pos[1]


def test_early_stop_anchor(spark):
    s = G.early_stop_epoch(G.epoch_loss(train_log(spark, SF01, 50)))
    got = {r.run_id: r.stop_epoch for r in s.collect()}
    assert got == {0: 14, 1: 10, 2: 13, 3: 11, 4: 11}


def test_batch_loss_null_when_unsupervised(spark):
    tl = spark.createDataFrame([(0, 1, 2.0, 0), (0, 1, 3.0, 0), (0, 2, 1.0, 1)],
                               "run_id long, batch_id long, nll double, mask int")
    got = {r.batch_id: r.loss for r in G.masked_batch_loss(tl).collect()}
    assert got == {1: None, 2: 1.0}


def test_hot_dialog_turn_path_equals_kernel_path(spark):
    from chatloom.operators.windows import turn_table_windows
    from chatloom.sources.tables import assemble_dialogs
    rows = []
    for t in range(3000):                                   # one dialog holds most of the rows
        rows.append((7, t, "user" if t % 2 == 0 else "assistant", f"msg {t} <eos>" if t % 97 == 0 else f"m{t}é"))
    for c in range(20):
        for t in range(6):
            rows.append((100 + c, t, ["system", "user", "assistant"][t % 3], f"c{c}t{t} 😀"))
    rows.append((500, 0, "user", "no answer"))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w_turn, v = turn_table_windows(turns, max_turns=100)
    kept = assemble_dialogs(turns).where("turns > 0")
    w_ref = build_windows(kept, v)

    def digest(df):
        return df.select(F.count("*"), F.sum(F.crc32(F.concat_ws(
            "|", "sample_id", F.col("window_no").cast("string"),
            F.array_join(F.col("input_ids").cast("array<string>"), ","),
            F.array_join(F.col("loss_mask").cast("array<string>"), ""))))).first()
    assert digest(w_turn) == digest(w_ref)
    assert w_turn.where("sample_id = 'conversations:500'").count() == 0


def test_long_text_sliced_path(spark):
    from chatloom.functions.kernels import CharLookup, window_starts
    from chatloom.operators.vocab import collect_lookup
    from chatloom.sources.tables import text_samples
    unit = "abc <user>de<assistant>fg\nhé😀 "
    text = unit * (2_200_000 // len(unit))
    docs = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    s = text_samples(docs)
    v = vocab_from_samples(s)
    lk: CharLookup = collect_lookup(v)
    w = build_windows(s, lk).where("sample_id = 'documents:1'")
    toks = lk.encode(text).tolist() + [3]
    starts = window_starts(len(toks), 256, 128)
    assert w.count() == len(starts)
    r = w.where(F.col("window_no") == len(starts) - 1).first()
    st = int(starts[-1])
    assert r.input_ids == toks[st:st + 256] and r.target_ids == toks[st + 1:st + 257]
    total = w.select(F.sum(F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0]
    assert total == sum(sum(toks[int(a):int(a) + 256]) for a in starts)


def test_hot_dialog_by_size_few_long_turns(spark):
    from chatloom.operators.windows import turn_table_windows
    from chatloom.sources.tables import assemble_dialogs
    rows = [(1, 0, "user", "q" * 9000), (1, 1, "assistant", "a<user>b" * 1500), (1, 2, "user", "z" * 700),
            (2, 0, "user", "hi"), (2, 1, "assistant", "yo")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w_turn, v = turn_table_windows(turns, max_chars=5000)
    w_ref = build_windows(assemble_dialogs(turns).where("turns > 0"), v)

    def digest(df):
        return sorted((r.sample_id, r.window_no, tuple(r.input_ids), tuple(r.loss_mask)) for r in df.collect())
    assert digest(w_turn) == digest(w_ref)


def test_turn_path_keep_tail(spark):
    from chatloom.operators.windows import turn_table_windows
    from chatloom.sources.tables import assemble_dialogs
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x" * (37 + t)) for t in range(40)]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "y" * 300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w_turn, v = turn_table_windows(turns, max_turns=10, keep_tail=True)
    w_ref = build_windows(assemble_dialogs(turns).where("turns > 0"), v, keep_tail=True)

    def digest(df):
        return sorted((r.sample_id, r.window_no, tuple(r.input_ids), tuple(r.target_ids), tuple(r.loss_mask))
                      for r in df.collect())
    assert digest(w_turn) == digest(w_ref)


def test_turn_path_sample_scope_masks(spark):
    from chatloom.operators.windows import turn_table_windows
    from chatloom.sources.tables import assemble_dialogs
    rows = []
    for t in range(60):                  # long assistant answers that span windows, a system turn, specials
        role = ["user", "assistant", "assistant", "system"][t % 4]
        rows.append((1, t, role, ("ans " * (20 + t)) if role == "assistant" else ("sys<eos>" if role == "system" else "q?")))
    rows += [(2, 0, "user", "hi"), (2, 1, "assistant", "z" * 700)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for keep_tail in (False, True):
        w_turn, v = turn_table_windows(turns, max_turns=10, keep_tail=keep_tail, mask_scope="sample")
        w_ref = build_windows(assemble_dialogs(turns).where("turns > 0"), v, keep_tail=keep_tail, mask_scope="sample")

        def digest(df):
            return sorted((r.sample_id, r.window_no, tuple(r.input_ids), tuple(r.loss_mask)) for r in df.collect())
        assert digest(w_turn) == digest(w_ref)


def test_encode_turns_equals_assembled_encoding(spark):
    """E4 per turn (no dialog row) concatenates, in pos0 order, to the assembled dialog's ids."""
    from chatloom.operators.vocab import turn_table_vocab
    from chatloom.sources.tables import assemble_dialogs
    rows = []
    for t in range(3000):                                   # one dialog holds most of the rows
        rows.append((7, t, "user" if t % 2 == 0 else "assistant", f"m{t} <eos>" if t % 97 == 0 else f"m{t}é"))
    for c in range(20):
        for t in range(6):
            rows.append((100 + c, t, ["system", "user", "assistant"][t % 3], "" if t == 0 else f"c{c}t{t} 😀"))
    rows.append((500, 0, "user", "no answer"))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    v = turn_table_vocab(turns).cache()
    per_turn = tok.encode_turns(turns, v).cache()
    # positions are contiguous: each row starts where the previous one of its dialog ended
    nxt = per_turn.groupBy("sample_id").agg(F.sum("n_tokens").alias("L"), F.max(F.col("pos0") + F.col("n_tokens")).alias("E"),
                                            F.min("pos0").alias("P"))
    assert nxt.where("L != E OR P != 0").count() == 0
    glued = per_turn.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos0", "token_ids"))).alias("p")) \
        .select("sample_id", F.flatten(F.transform("p", lambda x: x["token_ids"])).alias("a"))
    ref = tok.encode_samples(assemble_dialogs(turns).where("turns > 0"), v).select("sample_id", F.col("token_ids").alias("b"))
    j = glued.join(ref, "sample_id", "full")
    assert j.count() == 21
    assert j.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    # the <eos> row has no turn and sits at the end
    assert per_turn.where("turn IS NULL AND n_tokens = 1").count() == 21
