"""Records of JSON documents read in splits: a parallel prefix over the state of a scanner.

A splittable ``text`` scan (``lineSep=","``) cuts a document at its commas, so one array of any size is read by many
tasks and no task holds a file.  Whether a comma separates two items depends on all that precedes it, but only through
a small state: inside a string or not, and how deep.  So

1. a task sums up each (file, split) for both possible starts, outside and inside a string (``_sum_kernel``);
2. running sums over the splits of a file, one narrow row a split, give each split the state in which it starts, and
   the items and lines begun before it; each file is an array, one object, or lines (``split_states``);
3. with its state known, a task cuts its text into items (``_cut_kernel``); items that lie within a split leave whole,
   the others are put together by (file, item) from their ends, a few a split.

A file that is a single split needs neither sums nor states: its task has all of it (``_whole_kernel``).

An item that is no JSON value is a bad record of its own; a comma that ends the file is not read.  What is neither one whole array nor one whole object is
read as JSON lines, a single scalar as ``{"_data": x}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.plans.runtime import ensure_package

SEP = ","
BATCH_CHARS = 8 << 20       # characters of records sent on at a time
CHUNK = 2 << 20             # characters looked at together
MAX_SPLITS = 5_000_000      # splits of several-split files whose states (about 100 bytes each) are broadcast
NONE = 1 << 40              # no depth: nothing was closed
BLANKS = " \t\n\r\x0b\x0c"

SPLIT_SCHEMA = ("file_path string, block long, flips int, n_lines long, head_text boolean, tail_text boolean, inner_lines long, "
                "first_char int, last_char int, "
                + ", ".join(f"delta{s} long, low{s} long, text_after{s} boolean, commas{s} map<long,long>" for s in (0, 1)))
RECORD_SCHEMA = "file_path string, ordinal long, line long, value string"
ITEM_SCHEMA = "file_path string, block long, item long, line long, ordinal long, value string, partial boolean"


# -- one piece of text ----------------------------------------------------------------------------------------
def marks(data):
    """``(quotes before each byte, quotes, depth steps, newlines, text)`` of UTF-8 bytes; an escaped quote is none."""
    import numpy as np
    quote = data == 34
    slash = np.flatnonzero(data == 92)
    if len(slash):
        starts = np.concatenate([[True], np.diff(slash) != 1])
        offset = np.arange(len(slash)) - np.maximum.accumulate(np.where(starts, np.arange(len(slash)), 0))
        behind = slash[offset % 2 == 0] + 1
        quote[behind[behind < len(data)]] = False
    before = np.cumsum(quote, dtype=np.int32) - quote
    step = ((data == 91) | (data == 123)).astype(np.int8) - ((data == 93) | (data == 125))
    alone = data == 13  # a line end by itself, unless a newline follows
    alone[:-1] &= data[1:] != 10
    newline = (data == 10) | alone
    text = ~((data == 32) | ((data >= 9) & (data <= 13)))
    return before, int(np.count_nonzero(quote)), step, newline, text


def chunks(text: str):
    """The text in pieces of about ``CHUNK`` characters, each but the first with a comma in front."""
    at = 0
    while at < len(text):
        end = text.find(SEP, at + CHUNK)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


class Summary:
    """What a run of pieces does, for a start outside (0) and inside (1) a string; pieces are added in order."""

    def __init__(self, starts=(0, 1)):
        self.starts = starts
        self.quotes = self.n_lines = self.inner_lines = 0
        self.head_text = self.tail_text = False
        self.first_char = self.last_char = None
        self.delta, self.low, self.after = [0, 0], [NONE, NONE], [False, False]
        self.commas: list[dict[int, int]] = [{}, {}]

    def add(self, data) -> None:
        import numpy as np
        if not len(data):
            return
        before, quotes, step, newline, text = marks(data)
        at = np.flatnonzero(text)
        if len(at):
            self.first_char = int(data[at[0]]) if self.first_char is None else self.first_char
            self.last_char = int(data[at[-1]])
        self._lines(newline, text)
        outside = (before + self.quotes) % 2
        for s in self.starts:
            live = outside == s  # the characters outside strings under this start
            depth = self.delta[s] + np.cumsum(np.where(live, step, 0), dtype=np.int64)
            closed = np.flatnonzero(live & (step < 0))
            self.after[s] |= self.low[s] < NONE and len(at) > 0
            if len(closed):
                least = int(depth[closed].min())
                if least < self.low[s]:
                    place = closed[np.argmax(depth[closed] == least)]
                    self.low[s], self.after[s] = least, bool(len(at) and at[-1] > place)
            d, n = np.unique(depth[live & (data == 44)], return_counts=True)
            for k, c in zip(d.tolist(), n.tolist()):
                self.commas[s][k] = self.commas[s].get(k, 0) + c
            self.delta[s] = int(depth[-1])
        self.quotes += quotes

    def _lines(self, newline, text) -> None:
        """Lines with text: the one going on at the start (head), the one left open (tail), those in between."""
        import numpy as np
        ends = np.flatnonzero(newline)
        per_line = np.add.reduceat(np.concatenate([text, [False]]).astype(np.int64), np.concatenate([[0], ends + 1])) > 0
        if not len(ends):
            held = bool(per_line[0])
            if self.n_lines == 0:
                self.head_text |= held
            self.tail_text |= held
            return
        if self.n_lines == 0:
            self.head_text |= bool(per_line[0])
        else:
            self.inner_lines += bool(per_line[0]) or self.tail_text
        self.inner_lines += int(per_line[1:-1].sum())
        self.tail_text = bool(per_line[-1])
        self.n_lines += len(ends)

    def row(self) -> tuple:
        out = [self.quotes % 2, self.n_lines, self.head_text, self.tail_text, self.inner_lines, self.first_char, self.last_char]
        for s in (0, 1):
            out += [self.delta[s], self.low[s], self.after[s], list(self.commas[s].items())]
        return tuple(out)


def _runs(batch):
    """``(path, block, [pieces])`` of the consecutive rows of a batch that stem from one split."""
    import numpy as np
    block = batch.column(1).to_numpy(zero_copy_only=False)
    path = batch.column(0).dictionary_encode()
    code = path.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(code) != 0)) + 1
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if z > a:
            yield path.dictionary[int(code[a])].as_py(), int(block[a]), batch.column(2).slice(a, z - a).to_pylist()


def _joined(pieces, first: bool) -> str:
    """The text of a run: every piece but the file's first has its comma before it."""
    return ("" if first else SEP) + SEP.join(p or "" for p in pieces)


def _arrow(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows, schema):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _sum_kernel(schema):
    def run(batches):
        import numpy as np
        at, held, done = None, None, []
        for b in batches:
            for path, block, pieces in _runs(b):
                fresh = (path, block) != at
                if fresh:
                    if held is not None:
                        done.append((*at, *held.row()))
                    at, held = (path, block), Summary()
                held.add(np.frombuffer(_joined(pieces, fresh and block == 0).encode("utf-8"), dtype=np.uint8))
            if len(done) > 1000:
                yield _batch(done, schema)
                done = []
        if held is not None:
            yield _batch([*done, (*at, *held.row())], schema)
    return run


# -- states of the splits ----------------------------------------------------------------------------------------
def split_states(splits: DataFrame) -> DataFrame:
    """Per split ``(file_path, block, kind, inside, depth, item0, line0, ordinal0, seen, last, n_items, n_records)``.

    ``kind``: ``array``, ``value`` (one object) or ``lines``; ``inside``/``depth``: the scanner's state at the start;
    ``item0``/``line0``/``ordinal0``: array separators, line ends and lines with text begun before; ``seen``: the line
    going on at the start has had text; ``last``: the file's last split.
    """
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("file_path").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    every = Window.partitionBy("file_path")
    zero = F.lit(0).cast("long")
    s = splits.withColumn("inside", F.coalesce(F.sum("flips").over(before), zero) % 2 == 1)
    pick = lambda c: F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    s = s.withColumns({c: pick(c) for c in ("delta", "low", "text_after", "commas")}) \
        .withColumn("depth", F.coalesce(F.sum("delta").over(before), zero))
    has_text = F.col("first_char").isNotNull()
    known = F.when(F.col("n_lines") > 0, F.col("tail_text")).when(F.col("head_text"), F.lit(True))
    s = s.withColumns({
        "item0": F.coalesce(F.try_element_at("commas", 1 - F.col("depth")), zero),
        "seen": F.coalesce(F.last(known, ignorenulls=True).over(before), F.lit(False)),
        "least": F.when(F.col("low") < NONE, F.col("depth") + F.col("low")),
        "text_later": F.coalesce(F.max(has_text).over(rest), F.lit(False)),
        "root": F.first(F.when(has_text, F.col("first_char")), ignorenulls=True).over(Window.partitionBy("file_path").orderBy("block").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)),
        "end": F.last("last_char", ignorenulls=True).over(Window.partitionBy("file_path").orderBy("block").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)),
        "last": F.col("block") == F.max("block").over(every)})
    # lines with text that begin here: the open one if it had none so far, those in between, the one left open
    begun = (F.col("head_text") & ~F.col("seen")).cast("long") + F.col("inner_lines") \
        + (F.col("tail_text") & (F.col("n_lines") > 0)).cast("long")
    early = F.max(F.coalesce((F.col("least") < 0) | ((F.col("least") == 0) & (F.col("text_after") | F.col("text_later"))), F.lit(False))).over(every)
    whole = (F.sum("flips").over(every) % 2 == 0) & (F.sum("delta").over(every) == 0) & ~early
    kind = F.when(whole & (F.col("root") == 91) & (F.col("end") == 93), F.lit("array")) \
        .when(whole & (F.col("root") == 123) & (F.col("end") == 125), F.lit("value")).otherwise(F.lit("lines"))
    return s.withColumns({"kind": kind, "n_items": F.sum("item0").over(every) + 1, "n_records": F.sum(begun).over(every),
                          "item_base": F.coalesce(F.sum("item0").over(before), zero),
                          "line0": F.coalesce(F.sum("n_lines").over(before), zero),
                          "ordinal0": F.coalesce(F.sum(begun).over(before), zero)}) \
        .select("file_path", "block", "kind", "inside", "depth", F.col("item_base").alias("item0"), "line0", "ordinal0", "seen", "last",
                "n_items", "n_records")


# -- cutting ---------------------------------------------------------------------------------------------------------
class Cutter:
    """Cuts the pieces of one split, given in order, into items; ``emit`` gets (item, line, ordinal, text, partial)."""

    def __init__(self, state: dict, block: int):
        self.s, self.block = state, block
        self.item = state["item0"] if state["kind"] == "array" else state["line0"] if state["kind"] == "lines" else 0
        self.quotes, self.depth, self.ordinal = int(state["inside"]), state["depth"], state["ordinal0"]
        self.seen = state["seen"]  # the open line has had text before this split
        self.open = [] if block == 0 else None  # parts of the item that began here; None: it began in an earlier split
        self.head = []  # parts of the item that began earlier

    def add(self, text: str):
        """Yield the items that end in this text."""
        import numpy as np
        raw = text.encode("utf-8")
        data = np.frombuffer(raw, dtype=np.uint8)
        if not len(data):
            return
        before, quotes, step, newline, _ = marks(data)
        kind = self.s["kind"]
        if kind == "array":
            live = (before + self.quotes) % 2 == 0
            depth = self.depth + np.cumsum(np.where(live, step, 0), dtype=np.int64)
            cuts = np.flatnonzero(live & (data == 44) & (depth == 1))
            self.depth = int(depth[-1])
            self.quotes += quotes
        else:
            cuts = np.flatnonzero(newline) if kind == "lines" else ()
        at = 0
        for c in cuts:
            yield from self._close(raw[at:c].decode("utf-8"))
            at = int(c) + 1
        self._hold(raw[at:].decode("utf-8"))

    def _hold(self, part: str) -> None:
        (self.head if self.open is None else self.open).append(part)

    def _close(self, part: str):
        self._hold(part)
        yield from self._leave(partial=self.open is None)
        self.item += 1
        self.open, self.head, self.seen = [], [], False

    def _leave(self, partial: bool):
        text = "".join(self.head if self.open is None else self.open)
        if self.s["kind"] == "lines":
            ordinal = None
            if text.strip() and not self.seen:
                ordinal = self.ordinal
                self.ordinal += 1
            if partial or ordinal is not None:
                yield self.item, self.item + 1, ordinal, text, partial
        else:
            yield self.item, None, self.item, text, partial

    def end(self):
        """Yield what is left open when the split ends: whole if the file ends here and the item began here."""
        yield from self._leave(partial=self.open is None or not self.s["last"])


def finish(kind: str, item: int, text: str, n_items: int, n_records: int) -> str | None:
    """The record of an item's whole text; None where there is none (an empty array)."""
    text = text.strip(BLANKS)
    if kind == "array":
        if item == 0:
            text = text[1:].lstrip(BLANKS)
        if item == n_items - 1:
            text = text[:-1].rstrip(BLANKS)
        return text if text or n_items > 1 else None
    if kind == "lines":
        text = text.strip()
        if n_records == 1 and text and text[0] not in "[{" and _is_json(text):
            return f'{{"_data":{text}}}'
    return text


def _is_json(text: str) -> bool:
    import json
    try:
        json.loads(text)
        return True
    except (ValueError, RecursionError):
        return False


# columns of ``split_states`` that the cutter needs
STATE = ("kind", "inside", "depth", "item0", "line0", "ordinal0", "seen", "last", "n_items", "n_records")


def _cut_kernel(ends: bool, schema):
    """Whole items of the splits (``ends=False``), or only the parts of items that lie in several (``ends=True``)."""
    def run(batches):
        at = cutter = None
        held, size = [], 0

        def take(rows):
            nonlocal size
            for item, line, ordinal, text, partial in rows:
                if partial != ends:
                    continue
                if not partial:
                    text = finish(cutter.s["kind"], item, text, cutter.s["n_items"], cutter.s["n_records"])
                    if text is None:
                        continue
                    if cutter.s["n_records"] == 1:
                        line = None if cutter.s["kind"] == "lines" else line
                held.append((*at, item, line, ordinal, text, partial))
                size += len(text)

        for b in batches:
            done = 0
            for path, block, pieces in _runs(b):
                fresh = (path, block) != at
                if fresh:
                    if cutter is not None:
                        take(cutter.end())
                    at = (path, block)
                    cutter = Cutter({c: b.column(3 + i)[done].as_py() for i, c in enumerate(STATE)}, block)
                done += len(pieces)
                take(cutter.add(_joined(pieces, fresh and block == 0)))
                if size > BATCH_CHARS:
                    yield _batch(held, schema)
                    held, size = [], 0
        if cutter is not None:
            take(cutter.end())
        if held:
            yield _batch(held, schema)
    return run


def _whole_kernel(schema):
    """Records of the files that are a single split each."""
    def files(batches):
        at, pieces = None, []
        for b in batches:
            for path, _, more in _runs(b):
                if path != at:
                    if at is not None:
                        yield at, _joined(pieces, True)
                    at, pieces = path, []
                pieces += more
        if at is not None:
            yield at, _joined(pieces, True)

    def run(batches):
        held, size = [], 0
        for path, text in files(batches):
            for record in text_records(text):
                held.append((path, *record))
                size += len(record[2])
                if size > BATCH_CHARS:
                    yield _batch(held, schema)
                    held, size = [], 0
        if held:
            yield _batch(held, schema)
    return run


def document_items(pieces: DataFrame) -> DataFrame:
    """``(file_path, ordinal, line, value)`` of documents cut at commas: ``(file_path, block, single, value)`` in file order.

    ``single``: the file is one split.
    """
    from chatloom.session import checkpoint_dir
    spark = pieces.sparkSession
    ensure_package(spark)
    checkpoint_dir(spark)
    pieces = pieces.select("file_path", F.col("block").cast("long").alias("block"), "value", "single")
    whole = pieces.where("single").select("file_path", "block", "value") \
        .mapInArrow(_whole_kernel(_arrow(RECORD_SCHEMA)), RECORD_SCHEMA)
    split = pieces.where("not single").select("file_path", "block", "value")
    # one narrow row a split; frozen, so that both uses below see the same rows
    states = split_states(split.mapInArrow(_sum_kernel(_arrow(SPLIT_SCHEMA)), SPLIT_SCHEMA)).checkpoint(eager=True)
    n = states.count()
    if not n:
        return whole
    if n > MAX_SPLITS:
        raise ValueError(f"{n} splits of JSON documents: raise spark.sql.files.maxPartitionBytes")
    side = F.broadcast(states.withColumnsRenamed({"file_path": "_path", "block": "_block"}))  # keeps the pieces in order
    known = split.join(side, (F.col("file_path") == F.col("_path")) & (F.col("block") == F.col("_block")), "left") \
        .withColumn("kind", F.coalesce("kind", F.raise_error(F.lit("the splits of a file changed between two scans")))) \
        .select("file_path", "block", "value", *STATE)
    inner = known.mapInArrow(_cut_kernel(False, _arrow(ITEM_SCHEMA)), ITEM_SCHEMA).select("file_path", "ordinal", "line", "value")
    parts = known.mapInArrow(_cut_kernel(True, _arrow(ITEM_SCHEMA)), ITEM_SCHEMA)
    info = states.groupBy("file_path").agg(*[F.first(c).alias(c) for c in ("kind", "n_items", "n_records")])
    glue = F.udf(finish, "string", useArrow=False)  # a few items a split
    joined = parts.groupBy("file_path", "item").agg(
        F.min("line").alias("line"), F.min("ordinal").alias("ordinal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda x: x["value"]), "").alias("value")) \
        .where("ordinal is not null").join(info, "file_path")
    joined = joined.withColumn("line", F.when((F.col("n_records") == 1) & (F.col("kind") == "lines"), F.lit(None)).otherwise(F.col("line"))) \
        .select("file_path", "ordinal", "line", glue("kind", "item", "value", "n_items", "n_records").alias("value")).where("value is not null")
    return whole.unionByName(inner).unionByName(joined)


def scan_pieces(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(file_path, block, single, value)``: documents cut at commas, a split by one task and in order."""
    reader = spark.read
    if glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    of = lambda c: F.col(f"_metadata.{c}")
    return reader.text([paths] if isinstance(paths, str) else paths, lineSep=SEP).select(
        of("file_path").alias("file_path"), of("file_block_start").alias("block"),
        ((of("file_block_start") == 0) & (of("file_block_length") == of("file_size"))).alias("single"), "value")


def text_records(text: str):
    """Yield ``(ordinal, line, value)`` of one document held in memory, by the same rules."""
    import numpy as np
    text = text.removesuffix(SEP)  # a separator that ends a file is not handed out by the text source
    total = Summary(starts=(0,))
    for part in chunks(text):
        total.add(np.frombuffer(part.encode("utf-8"), dtype=np.uint8))
    whole = total.quotes % 2 == 0 and total.delta[0] == 0 and not (total.low[0] < 0 or total.low[0] == 0 and total.after[0])
    kind = "array" if whole and (total.first_char, total.last_char) == (91, 93) else \
        "value" if whole and (total.first_char, total.last_char) == (123, 125) else "lines"
    records = int(total.head_text) + total.inner_lines + int(total.tail_text and total.n_lines > 0)
    state = dict(kind=kind, inside=False, depth=0, item0=0, line0=0, ordinal0=0, seen=False, last=True,
                 n_items=total.commas[0].get(1, 0) + 1, n_records=records)
    cutter = Cutter(state, 0)

    def items():
        for part in chunks(text):
            yield from cutter.add(part)
        yield from cutter.end()

    for item, line, ordinal, value, _ in items():
        value = finish(kind, item, value, state["n_items"], records)
        if value is not None and ordinal is not None:
            yield ordinal, None if kind != "lines" or records == 1 else line, value
