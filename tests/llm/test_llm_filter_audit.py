import random
import re
from itertools import permutations

from llm_cases import clashing, union

from chatloom.llm import filter_audit as op

SCHEMA = "doc_id long, text string, source string"


def fails(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCD", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                                         bool(re.search("[#$%&*|]", text)))) if bad}


def plain_audit(rows, labels):
    """{(part, order, step): figures} by running every order over the documents."""
    rows = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    bad = [(s, fails(t) | ({"E"} if i is not None and first[t] < i else set()), labels.get(i, (0, 0)) if i is not None else (0, 0)) for i, t, s in rows]
    out = {}
    for part in {s for s, _, _ in bad}:
        docs = [(b, lab) for s, b, lab in bad if s == part]
        gone_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                gone_by[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in b for b, _ in docs) - len(gone), sum(b == {f} for b, _ in docs),
                                                   sum(q for _, (q, _) in gone), sum(x for _, (_, x) in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(gone_by[order[step - 1]])
    return out


def corpus(rng, n=400):
    rows = []
    for i in range(n):
        vocab = [f"w{k}" for k in range(rng.choice([20, 2000]))] + rng.choice([[], ["ABC"] * 400, ["#", "é|"]]) + ["naïve", "\u0085", "\x1c"]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(rng.choices(vocab, k=rng.choice([0, 5, 199, 200, 260]))), rng.choice(["a", "b", "", None, "long name"])))
    copies = [(n + i, rng.choice(rows)[1], rng.choice(["a", "b", None])) for i in range(n // 2)]
    hot = [(5000 + i, "the same text", rng.choice("ab")) for i in range(200)]
    return rows + copies + hot + [(6000, None, "a"), (6001, None, None), (6002, "", "c")]


def check(spark, rows, labels, *clash):
    docs = clashing(spark.createDataFrame(rows, SCHEMA), *clash)
    lab = spark.createDataFrame([(i, q, t) for i, (q, t) in labels.items()], "doc_id long, quality int, toxic int")
    got = op.audit(docs.repartition(5), lab)
    out = {(r.part, r.filter_order, r.step): [r[f] for f in op.FIGURES] for r in got.collect()}
    want = plain_audit(rows, labels)
    assert out == want and len(out) == 600 * len({s or "" for _, _, s in rows})


def test_matches_every_order_run_by_hand(spark):
    rng = random.Random(3)
    rows = corpus(rng)
    check(spark, rows, {i: (rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 700, 2)} | {5003: (1, 1)}, "doc", "part", "bits", "digest", "quality", "n", "mask")


def test_null_and_repeated_ids(spark):
    rows = [(None, "x", "a"), (None, "x", "a"), (3, "x", "a"), (3, "x", "a"), (3, "x", "b"), (4, "x", "b"), (4, "x", "b"), (None, "y", None)]
    check(spark, rows, {3: (1, 0), 4: (0, 1)})


def test_repeated_labels_null_labels_and_none(spark):
    docs = spark.createDataFrame([(1, "x", "a"), (2, "y", "a"), (3, "z", "a")], SCHEMA)
    lab = spark.createDataFrame([(1, 0, None), (1, 1, 0), (2, None, 1), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    rows = op.audit(docs, lab).where("filter_order = 'ABCDE' and step = 1").collect()
    assert [(r.removed, r.good_lost, r.toxic_lost) for r in rows] == [(3, 1, 1)]
    assert [(r.removed, r.good_lost) for r in op.audit(docs).where("filter_order = 'ABCDE' and step = 1").collect()] == [(3, 0)]


def test_empty_table_long_text_and_many_parts(spark):
    docs = spark.createDataFrame([(1, "Word one# " * 300_000, "a")], SCHEMA)
    assert op.audit(docs.where("false")).collect() == []
    many = union([docs, spark.range(10, 400).selectExpr("id doc_id", "concat('t', id) text", "concat('s', id) source")])
    got = op.audit(many).where("filter_order = 'EDCBA'").collect()
    assert len(got) == 5 * 391
    assert [(r.step, r.removed) for r in sorted(got, key=lambda r: r.step) if r.part == "a"] == [(1, 0), (2, 1), (3, 0), (4, 0), (5, 0)]
