"""Chat formatting by quotation linking.

Nested ``>`` quotes are parsed, quoted passages and their parts are normalised and hashed and joined to the messages that
said them first, and conversations are rebuilt in reply order without the quotes.  Everything is keyed joins
and minima; a thread that holds a third of all messages is ranked by the distributed positions helper.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import cut, prepare
from chatloom.operators.batches import dense_positions
from chatloom.session import work_dir

_MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_SAYS = re.compile(r"\S.*\b(?:wrote|writes|said)[ \t]*:[ \t]*$", re.I)
_WORD = re.compile(r"[^\W_]+")
_BLANK = {i: " " for i in range(128) if not chr(i).isalnum()}
_STOP = re.compile(r"[.!?]+[\"')\]]*\s+|[。！？]\s*")
PARSED = ("conv_id long, turn long, role string, body string, said array<long>, n_quotes long, parts array<long>, "
          "asked array<struct<level:int,no:int,words:int,hash:long>>")
SAID_ROWS = 1_000_000  # up to so many different quoted hashes are sent to the messages; beyond, the messages' hashes are shuffled
LINE_WORDS = 8  # a single line counts as a part from so many words; shorter ones do as sentences and in twos


def _words(folded: str) -> list[str]:
    return folded.translate(_BLANK).split() if folded.isascii() else _WORD.findall(folded)


def _digest(words: list[str]) -> int | None:
    import xxhash
    if not words:
        return None
    h = xxhash.xxh64_intdigest(" ".join(words), 5)
    return h - (1 << 64) if h >> 63 else h


def passage_hash(text: str) -> int | None:
    """Hash of a passage's words (case, punctuation and line breaks aside); null without a word."""
    return _digest(_words(text.casefold()))


def _paragraphs(lines: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def _read(lines: list[str]) -> tuple[list[str], int | None, list[tuple[int, int]]]:
    """Words and hash of a paragraph, and ``(words, hash)`` of what a trimmed quote may keep of it.

    These are its sentences, lines of ``LINE_WORDS`` words and pairs of lines.  No word reaches over a full stop
    or a line's end, so every word is looked for once.
    """
    sentences = [_words(x) for x in _STOP.split("\n".join(lines).casefold())]
    words = sentences[0] if len(sentences) == 1 else [w for x in sentences for w in x]
    h = _digest(words)
    pieces = sentences if len(sentences) > 1 else []
    if len(lines) > 1:
        by_line = [_words(x.casefold()) for x in lines]
        pieces = pieces + [x for x in by_line if len(x) >= LINE_WORDS] + [x + y for x, y in zip(by_line, by_line[1:])]
    found = [(len(x), _digest(x)) for x in pieces]
    if len(sentences) == 1 or (len(lines) == 1 and len(words) >= LINE_WORDS):
        found.append((len(words), h))
    return words, h, list(dict.fromkeys((n, x) for n, x in found if x is not None))


def _passages(paras: list) -> list[tuple[int, int]]:
    """``(words, hash)`` of the whole run of paragraphs that ``_read`` gave and of each of them, in order, each hash once."""
    every = [w for words, _, _ in paras for w in words] if len(paras) > 1 else []
    found: dict = {}
    for n, h in [(len(every), _digest(every)), *[(len(words), h) for words, h, _ in paras]]:
        if h is not None:
            found.setdefault(h, n)
    return [(n, h) for h, n in found.items()]


def parse(text: str | None) -> tuple[str, list[int], list[dict]]:
    """``(body without quotes, its passage hashes, quoted passages [{level, no, hash}])`` of a message.

    A line's level is its number of leading ``>`` marks.  Consecutive lines of one level are a block; a line
    such as "... wrote:" right above a deeper block leaves with it.
    """
    return parse_parts(text)[:3]


def parse_parts(text: str | None) -> tuple[str, list[int], list[dict], list[int], list[dict]]:
    """What ``parse`` gives, the hashes of the body's parts, and ``{level, no, words, hash}`` of each quoted passage and its parts."""
    text = text or ""
    if ">" not in text:
        blocks = [(0, text.split("\n"))]
    else:
        blocks = _blocks(text)
    own = [line for level, lines in blocks if not level for line in lines]
    body = text if len(blocks) == 1 and not blocks[0][0] else "\n".join(own).strip("\n")
    quotes, asked = [], []
    for level, lines in blocks:
        if level:
            paras = [_read(x) for x in _paragraphs(lines)]
            parts = {h: found for _, h, found in paras}
            for n, h in _passages(paras):
                no = len(quotes)
                quotes.append({"level": level, "no": no, "hash": h})
                asked += [{"level": level, "no": no, "words": k, "hash": x} for k, x in dict.fromkeys([(n, h), *parts.get(h, [])])]
    paras = [_read(x) for x in _paragraphs(own)]
    own_parts = list(dict.fromkeys(h for _, _, found in paras for _, h in found))
    return body, [h for _, h in _passages(paras)], quotes, own_parts, asked


def _blocks(text: str) -> list[tuple[int, list[str]]]:
    """Runs of lines of one quote level; a line that announces a deeper run is left out."""
    blocks: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _MARK.match(line)
        level, rest = (m.group(1).count(">"), line[m.end():]) if m else (0, line)
        if not blocks or blocks[-1][0] != level:
            if blocks and level > blocks[-1][0]:
                above = blocks[-1][1]
                last = next((i for i in range(len(above) - 1, -1, -1) if above[i].strip()), None)
                if last is not None and _SAYS.match(above[last].strip()):
                    del above[last:]
            blocks.append((level, []))
        blocks[-1][1].append(rest)
    return blocks


def _kernel(batches):
    import pyarrow as pa
    kinds = (pa.string(), pa.list_(pa.int64()),
             pa.int64(), pa.list_(pa.int64()),
             pa.list_(pa.struct([("level", pa.int32()), ("no", pa.int32()), ("words", pa.int32()), ("hash", pa.int64())])))
    for b in batches:
        made = [parse_parts(t.as_py()) for t in b.column(3)]
        cols = list(zip(*[(body, said, len(quotes), parts, asked) for body, said, quotes, parts, asked in made])) or [()] * 5
        yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                         names=["conv_id", "turn", "role", "body", "said", "n_quotes", "parts", "asked"])


def _roots(edges: DataFrame) -> DataFrame:
    """``(uid, root, depth)`` for ``(uid, parent)`` edges of a forest, by pointer doubling.

    A row is done once its root has no parent; only the others are looked up again, so the rounds beyond
    the usual depth read the few long chains alone.
    """
    cur, done = cut(edges.select("uid", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))), []
    while True:
        known = reduce(DataFrame.unionByName, done, cur)
        up = known.select(F.col("uid").alias("_u"), F.col("root").alias("_r"), F.col("depth").alias("_d"))
        nxt = cut(cur.join(up, F.col("root") == F.col("_u"), "left").select(
            "uid", F.coalesce("_r", "root").alias("root"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
            F.col("_u").isNotNull().alias("moved")))
        done.append(nxt.where("not moved").drop("moved"))
        cur = nxt.where("moved").drop("moved")
        if cur.isEmpty():
            return reduce(DataFrame.unionByName, done)


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: ``(thread_id, position, depth, conv_id, turn, role, content, parent_conv_id, parent_turn, n_quotes, n_linked)``.

    ``content`` is the message without quotes.  A quoted passage (paragraph or whole block) links to the first
    message of its own conversation, else of all, that says the same words at level 0, if that one stands before the
    quoting one by (conv_id, turn).  A trimmed passage links by the longest of its own words that some message says, which
    may be sentences, lines of ``LINE_WORDS`` words or pairs of lines on both sides.  The parent is the target of the shallowest linked quote, else the turn before;
    a message without either is a root and its conv_id names the thread.  ``position`` runs over a thread by
    (depth, conv_id, turn), so every message follows what it answers.  ``n_quotes``: quoted passages; ``n_linked``:
    those that found a message.  Messages without conv_id or turn are never targets and stand by themselves (thread
    null).  Rows that repeat a turn keep their rows, in a fixed order.  Null and empty texts are empty messages
    (content ''); an empty table gives no rows; extra columns are not read.
    """
    spark = messages.sparkSession
    prepare(spark)
    parsed = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                             F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text")) \
        .mapInArrow(_kernel, PARSED)
    # frozen with its ids as a table: what follows reads the columns it needs, and the bodies only at the end
    path = f"{work_dir(spark, 'messages')}/parsed"
    parsed.withColumn("uid", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(f"{PARSED}, uid long").parquet(path)
    named = rows.where("conv_id is not null and turn is not null")
    place = F.struct("conv_id", "turn", "uid").alias("at")
    asked = named.select("uid", "conv_id", F.struct("conv_id", "turn", "uid").alias("own"), F.inline("asked"))
    said = named.select(F.explode("said").alias("hash"), place, F.lit(True).alias("whole")) \
        .union(named.select(F.explode("parts").alias("hash"), place, F.lit(False).alias("whole")))
    wanted = cut(asked.select("hash").distinct())
    if wanted.count() <= SAID_ROWS:  # only what somebody quotes is shuffled
        said = said.join(F.broadcast(wanted), "hash", "left_semi")
    same = said.groupBy("hash", F.col("at.conv_id").alias("conv_id")).agg(
        F.min(F.when(F.col("whole"), F.col("at"))).alias("same_at"), F.min("at").alias("same_part"))
    anywhere = same.groupBy("hash").agg(F.min("same_at").alias("any_at"), F.min("same_part").alias("any_part"))
    target = reduce(lambda so_far, c: so_far.when(F.col(c) < F.col("own"), F.col(c)), ("same_part", "any_at", "any_part"),
                    F.when(F.col("same_at") < F.col("own"), F.col("same_at")))
    hits = asked.join(same, ["hash", "conv_id"], "left").join(anywhere, "hash", "left") \
        .select("uid", "level", "no", "words", (F.col("conv_id") != target["conv_id"]).alias("far"), target.alias("at"))
    # the longest words of a passage that link
    links = hits.where("at is not null").groupBy("uid", "level", "no") \
        .agg(F.min(F.struct((-F.col("words")).alias("less"), "far", "at")).alias("best")).select("uid", "level", "no", "best.at")
    found = links.groupBy("uid").agg(
        F.count("at").alias("n_linked"),
        F.min(F.when(F.col("at").isNotNull(), F.struct("level", "no", "at"))).alias("first"))
    placed = dense_positions(named.select("uid", "conv_id", "turn"), ["conv_id"], ["turn", "uid"], "nth")
    before = placed.select(F.struct("conv_id", "turn", "uid").alias("prev"), F.col("conv_id").alias("_c"), (F.col("nth") + 1).alias("_n"))
    parents = cut(placed.join(before, (F.col("conv_id") == F.col("_c")) & (F.col("nth") == F.col("_n")), "left")
                  .join(found, "uid", "left")
                  .select("uid", F.coalesce("first.at", "prev").alias("parent"), F.coalesce("n_linked", F.lit(0)).alias("n_linked")))
    forest = _roots(parents.where("parent is not null").select("uid", F.col("parent.uid").alias("parent")))
    root_of = forest.select(F.col("uid").alias("_fu"), "root", "depth")
    conv_of = rows.select(F.col("uid").alias("_ru"), F.col("conv_id").alias("thread_id"))
    threads = rows.select("uid", "conv_id", "turn") \
        .join(root_of, F.col("uid") == F.col("_fu"), "left") \
        .select("uid", "conv_id", "turn", F.coalesce("root", "uid").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth")) \
        .join(conv_of, F.col("root") == F.col("_ru")) \
        .select("uid", "conv_id", "turn", "depth", F.when(F.col("turn").isNotNull(), F.col("thread_id")).alias("thread_id"))
    known = threads.where("thread_id is not null")
    order = dense_positions(known, ["thread_id"], ["depth", "conv_id", "turn", "uid"], "position") \
        .select(F.col("uid").alias("_u"), "thread_id", "position", "depth")
    facts = parents.select(F.col("uid").alias("_p"), "parent", "n_linked")
    return rows.join(order, F.col("uid") == F.col("_u"), "left").join(facts, F.col("uid") == F.col("_p"), "left").select(
        "thread_id", F.coalesce("position", F.lit(0)).alias("position"), F.coalesce("depth", F.lit(0)).alias("depth"),
        "conv_id", "turn", "role", F.col("body").alias("content"), F.col("parent.conv_id").alias("parent_conv_id"),
        F.col("parent.turn").alias("parent_turn"), "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
