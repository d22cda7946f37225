"""Prefix sums, turn places, characters of kept dialogs, line numbers: against plain Python."""
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.operators.batches import prefix_sum
from chatloom.operators.tokenize import encode_turns
from chatloom.operators.vocab import collect_lookup, turn_table_vocab
from chatloom.operators.windows import turn_table_windows
from chatloom.sources.files import line_records


def test_prefix_sums_of_a_hot_group_null_groups_and_numbers(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < .4 else rng.choice(["a", "b", None, "z"]), i, rng.choice([None, 0, 1, 5]), rng.random())
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, n long, x double")
    got = {(r.g, r.o): (r.pn, r.px) for r in prefix_sum(df, "g", ["o"], ["n", "x"], ["pn", "px"], 13).collect()}
    sums, want = {}, {}
    for g, o, n, x in sorted(rows, key=lambda r: r[1]):
        want[g, o] = sums.get(g, (0, 0.0))
        sums[g] = (want[g, o][0] + (n or 0), want[g, o][1] + x)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)
    assert prefix_sum(df.where("false"), "g", ["o"], "n", "p").collect() == []


def _turns(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"conv_id {kind}, turn long, role string, text string")


def test_turn_places_with_ties_repeats_nulls_and_a_hot_dialog(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", None]
    rows = [("hot", i // 2, rng.choice(roles), rng.choice(["ab", "ba", "", None, "<eos>x"])) for i in range(1500)]
    rows += [("t", 1, "user", "x"), ("t", 1, "user", "x"), ("t", 1, "user", "x"), ("t", 1, "assistant", "y"), ("t", None, "user", "z"),
             ("n", None, "assistant", "q"), ("none", 0, "user", "unseen"), (None, 0, "assistant", "lost")]
    t = _turns(spark, rows)
    vocab = turn_table_vocab(t)
    lookup = collect_lookup(vocab)
    got = encode_turns(t, vocab).collect()
    assert {r.sample_id for r in got} == {"conversations:hot", "conversations:t", "conversations:n"}
    mark = {"user": [4], "assistant": [5]}
    for name in ("hot", "t", "n"):
        own = sorted((r for r in got if r.sample_id == f"conversations:{name}"), key=lambda r: r.pos0)
        assert [r.pos0 for r in own] == [sum(len(x.token_ids) for x in own[:i]) for i in range(len(own))]  # no gap, no overlap
        assert own[-1].turn is None and len(own[-1].token_ids) == 1  # <eos>
        turns = [(r.turn, list(r.token_ids)) for r in own[:-1]]
        assert [k for k, _ in turns] == sorted((k for k, _ in turns), key=lambda k: (k is not None, k))
        want = [(k, mark.get(r, []) + lookup.encode(x, False).tolist()) for c, k, r, x in rows if c == name]
        assert sorted(map(str, turns)) == sorted(str(w) for w in want if w[1])


@pytest.mark.parametrize("order", ["kept first", "assistant last", "mixed"])
def test_characters_of_kept_dialogs_however_turns_lie(spark, order):
    rng = random.Random(order)
    rows = [(d, k, "assistant" if d % 3 and k == 3 else "user", chr(0x4E00 + d) + chr(0x3041 + rng.randrange(60)))
            for d in range(300) for k in range(4)] + [(None, 0, "assistant", "\U0001F600")]
    rows.sort(key={"kept first": lambda r: (r[2] != "assistant",), "assistant last": lambda r: (r[2] == "assistant",),
                   "mixed": lambda r: rng.random()}[order])
    t = _turns(spark, rows, "long").repartition(7, F.rand(1)) if order == "mixed" else _turns(spark, rows, "long")
    kept = {d for d, _, r, _ in rows if r == "assistant" and d is not None}
    want = set("".join(x for d, _, _, x in rows if d in kept)) | set("<user><assistant><eos>\n")
    assert {r.token for r in turn_table_vocab(t).where("not is_special").collect()} == want
    assert {r.token for r in turn_table_windows(t)[1].where("not is_special").collect()} == want


def test_lines_that_were_counted_in_other_splits_are_an_error(spark):
    raw = spark.createDataFrame([("f", 0, "a"), ("f", 0, " "), ("f", 0, "b")], "file_path string, block long, value string").coalesce(1)
    assert [(r.ordinal, r.line, r.value) for r in line_records(raw).orderBy("line").collect()] == [(0, 1, "a"), (1, 3, "b")]

    def cut_anew(batches):  # another start of the split in each scan, as if the files had been cut otherwise
        import time
        for b in batches:
            yield b.set_column(1, "block", pa.array([time.time_ns()] * b.num_rows, pa.int64()))

    with pytest.raises(Exception, match="split otherwise"):
        line_records(raw.mapInArrow(cut_anew, raw.schema)).collect()
