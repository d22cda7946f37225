import random

import pytest
from llm_cases import clashing

from chatloom.llm import quote_links as op

SCHEMA = "conv_id long, turn long, role string, text string"


def test_parse_nested_levels():
    text = "Hi all,\n\nOn Monday Ann wrote:\n> First thing.\n> goes on\n>\n> Second thing\n>> deeper still\n> > same level\n\nMy answer\n> late quote\nend"
    body, said, quotes = op.parse(text)
    assert body == "Hi all,\n\n\nMy answer\nend"
    h = op.passage_hash
    assert said == [h("Hi all, My answer end"), h("hi all"), h("My answer\nend")]
    assert [(q["level"], q["hash"]) for q in quotes] == [
        (1, h("First thing. goes on Second thing")), (1, h("first thing goes on")), (1, h("SECOND THING")),
        (2, h("deeper still same level")), (1, h("late quote"))]
    assert op.parse(None) == ("", [], []) and op.parse("") == ("", [], []) and op.parse(">") == ("", [], [])
    assert op.parse("no quotes\n\n") [0] == "no quotes\n\n" and op.passage_hash("?!") is None


def brute(rows):
    """[(thread, position, conv, turn, content, parent, n_quotes, n_linked)] by plain loops; distinct (conv, turn)."""
    parsed = {(c, t): op.parse(x) for c, t, _, x in rows}
    order = sorted(parsed)
    parent, linked = {}, {}
    for own in order:
        hits = []
        for q in parsed[own][2]:
            same = [k for k in order if k[0] == own[0] and q["hash"] in parsed[k][1]]
            any_ = [k for k in order if q["hash"] in parsed[k][1]]
            at = same[0] if same and same[0] < own else any_[0] if any_ and any_[0] < own else None
            if at:
                hits.append((q["level"], q["no"], at))
        linked[own] = len(hits)
        before = [k for k in order if k[0] == own[0] and k < own]
        parent[own] = min(hits)[2] if hits else before[-1] if before else None

    def up(k):
        d = 0
        while parent[k]:
            k, d = parent[k], d + 1
        return k, d
    threads = {}
    for k in order:
        root, d = up(k)
        threads.setdefault(root[0], []).append((d, *k))
    return sorted((th, n, c, t, parsed[c, t][0], parent[c, t], len(parsed[c, t][2]), linked[c, t])
                  for th, ks in threads.items() for n, (d, c, t) in enumerate(sorted(ks)))


def corpus(seed=1):
    rng = random.Random(seed)
    said = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=rng.randint(1, 6))) for _ in range(30)]
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            lines = [rng.choice(said)]
            for _ in range(rng.randint(0, 2)):
                q = rng.choice(said)
                lines += [rng.choice(["> ", ">", " > "]) * rng.choice([1, 1, 2]) + w for w in (q.upper(), "")] + [rng.choice(said), ""]
            rows.append((c, t * 2, "user", "\n".join(lines) if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("sent", [op.SAID_ROWS, -1])  # -1: more quoted hashes than are sent to the messages
def test_matches_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(op, "SAID_ROWS", sent)
    rows = corpus()
    rng = random.Random(2)
    df = clashing(spark.createDataFrame(rng.sample(rows, len(rows)), SCHEMA), "uid", "hash", "parent", "position", "depth")
    got = sorted((r.thread_id, r.position, r.conv_id, r.turn, r.content,
                  None if r.parent_conv_id is None else (r.parent_conv_id, r.parent_turn), r.n_quotes, r.n_linked)
                 for r in op.link_quotes(df).collect())
    want = brute(rows)
    assert got == want and sum(w[-1] for w in want) > 50


def test_one_long_conversation_and_a_common_passage(spark):
    rows = [(1, t, "user", f"> hello there\nturn {t}" if t else "Hello there") for t in range(300)]
    rows += [(2 + c, 0, "user", "hello there") for c in range(200)]
    got = {(r.conv_id, r.turn): r for r in op.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[1, t].depth == 1 and got[1, t].parent_turn == 0 and got[1, t].content == f"turn {t}" for t in range(1, 300))
    assert sorted(r.position for r in got.values() if r.thread_id == 1) == list(range(300))
    chain = [(5, t, "user", f"turn {t}") for t in range(130)]
    got = op.link_quotes(spark.createDataFrame(chain, SCHEMA)).collect()
    assert all(r.depth == r.turn == r.position for r in got)


def test_nulls_repeats_long_texts_and_empty_table(spark):
    long = "word " * 200_000
    rows = spark.createDataFrame([(1, 0, None, long), (1, 1, "user", "> " + long + "\nyes"), (1, 1, "user", "same turn"), (1, 1, "user", "same turn"),
                                  (None, 0, "user", "> same turn\nx"), (3, None, "user", None), (None, None, None, "")], SCHEMA)
    got = op.link_quotes(rows).collect()
    assert len(got) == 7
    yes = next(r for r in got if r.content == "yes")
    assert (yes.parent_conv_id, yes.parent_turn, yes.n_linked, yes.depth) == (1, 0, 1, 1)
    assert sorted(r.position for r in got if r.thread_id == 1) == [0, 1, 2, 3]
    assert [(r.content, r.position) for r in got if r.thread_id is None and r.content] == [("x", 0)]
    assert op.link_quotes(rows.where("false")).collect() == []


def test_words_are_looked_for_once():
    text = "One two. Three four five!\nSix, seven eight nine ten eleven twelve thirteen\nfourteen.\n\nŒuvre Straße été"
    body, said, _, parts, _ = op.parse_parts(text)
    h = op.passage_hash
    first, second = text.split("\n\n")
    assert body == text and said == [h(text), h(first), h(second)]
    lines = first.split("\n")
    want = ["one two", "three four five", "six seven eight nine ten eleven twelve thirteen fourteen", lines[1], "\n".join(lines[:2]), "\n".join(lines[1:]), second]
    assert sorted(set(parts)) == sorted({h(x) for x in want}) and h("STRASSE") == h("straße")


def test_trimmed_quotes_find_their_message(spark):
    long = "We met in the old hall. The committee will vote on the new bridge next Monday!\nBring a pen. Thanks."
    wrapped = "the first line of a paragraph that was wrapped in\nthe second line which goes on without any stop and\nends here"
    verse = "roses are red\nviolets are blue\nsugar is sweet\nand so are you"
    rows = [(1, 0, "user", long), (1, 1, "user", "Thanks.\n\nNoted"), (1, 2, "user", "> The committee will vote\n> on the new bridge next monday\nNo!"),
            (1, 3, "user", "> Bring a pen. [...]\nWhy?"), (2, 0, "user", wrapped), (2, 1, "user", verse), (2, 2, "user", "between"),
            (2, 3, "user", "> the second line which goes on without any stop and\nreally"), (2, 4, "user", "> violets are blue\n> sugar is sweet\nah"),
            (3, 0, "user", "hello"), (3, 1, "user", "> We met in the old hall.\nWhen?"), (3, 2, "user", "> never said by anyone\nhm")]
    got = {(r.conv_id, r.turn): (r.parent_conv_id, r.parent_turn, r.n_quotes, r.n_linked)
           for r in op.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1, 2] == (1, 0, 1, 1) and got[1, 3] == (1, 0, 1, 1) and got[2, 3] == (2, 0, 1, 1) and got[2, 4] == (2, 1, 1, 1)
    assert got[3, 1] == (1, 0, 1, 1) and got[3, 2] == (3, 1, 1, 0) and got[1, 1] == (1, 0, 0, 0)
