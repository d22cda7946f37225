"""Token counts: map-side two-tier look-up of pre-token lengths.

First tier: a broadcast table of frequent pre-tokens and their numbers of tokens.  Second tier: each
worker encodes what the table lacks, a batch's distinct misses at a time, and keeps the lengths in a
bounded cache.  No pre-token of the corpus is shuffled; texts never leave their task.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import prepare

# fixed values: how byte-level BPE of this kind cuts texts into pre-tokens
_CUT = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{W}{L}{N}]+|[{W}]+(?![^{W}])|[{W}]+"
ANY = {"L": r"\p{L}", "N": r"\p{N}", "W": r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"}
LATIN = {"L": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": r"0-9\xb2\xb3\xb9\xbc-\xbe", "W": r"\t-\r\x20\x85\xa0"}
CACHE = 500_000  # pre-tokens of each of a worker's two cache generations
LONG = 1 << 20   # characters of a text whose pre-tokens are listed at once
PIECE = 64       # a pre-token beyond this many characters isn't remembered


# fixed values: the settings of a tokenizer file under which texts are cut as above and pieces add up
PLAIN_CUT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None}


def cuts_like_this(path: str) -> bool:
    """Whether the file is a byte-level BPE whose pre-tokens are those of ``_CUT`` and whose added tokens stand alone."""
    import json
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    cut, model = made.get("pre_tokenizer") or {}, made.get("model") or {}
    same = all(cut.get(k, True if k == "use_regex" else None) == v for k, v in PLAIN_CUT.items()) \
        and all(model.get(k, "BPE" if k == "type" else None) == v for k, v in PLAIN_MODEL.items())
    added = made.get("added_tokens") or []
    return same and made.get("normalizer") is None and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))


class Counts:
    """Token counts of texts under one tokenizer file; lives once in each Python worker.

    A file of another kind (``cuts_like_this``) is given whole texts.

    Texts of Latin-1 characters are cut as bytes (the same classes, written out), others with Unicode classes;
    pre-tokens are therefore ``bytes`` or ``str``.
    """

    def __init__(self, path: str, frequent: dict[str, int]):
        import re

        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.whole_texts = not cuts_like_this(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        self.any = regex.compile(_CUT.format(**ANY))
        self.latin = re.compile(_CUT.format(**LATIN).encode("latin-1"))
        self.frequent = frequent | {p.encode("latin-1"): n for p, n in frequent.items() if not p or max(p) < "\u0100"}
        self.new, self.old = {}, {}

    def cutter(self, text: str):
        """(compiled pattern, the text in the pattern's type)."""
        try:
            return self.latin, text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any, text

    def lengths(self, pieces) -> list[int]:
        """Tokens of single pre-tokens, as the library encodes them."""
        if not pieces:
            return []
        texts = [p.decode("latin-1") if isinstance(p, bytes) else p for p in pieces]
        return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _missed(self, pieces) -> int:
        """Second tier: tokens of pre-tokens that the broadcast table lacks."""
        new, old = self.new, self.old
        own = {p for p in set(pieces) if p not in new}
        known = {p: old[p] for p in own if p in old}
        unknown = [p for p in own if p not in known]
        known.update(zip(unknown, self.lengths(unknown)))
        total = sum(new[p] if p in new else known[p] for p in pieces)
        if len(new) + len(known) > CACHE:
            self.old, self.new = new, {}
        self.new.update((p, n) for p, n in known.items() if len(p) <= PIECE)
        return total

    def _total(self, pieces) -> int:
        got = list(map(self.frequent.get, pieces))
        if None not in got:
            return sum(got)
        return sum(n for n in got if n is not None) + self._missed([p for p, n in zip(pieces, got) if n is None])

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.whole_texts:
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        total, parts = 0, [text]
        if any(a in text for a in self.added):
            total = sum(1 for _ in self.special.finditer(text))
            parts = self.special.split(text)
        for part in parts:
            pattern, data = self.cutter(part)
            if len(data) <= LONG:
                total += self._total(pattern.findall(data))
                continue
            held: list = []
            for m in pattern.finditer(data):  # a very long text: a bounded list at a time
                held.append(m.group())
                if len(held) >= LONG >> 2:
                    total += self._total(held)
                    held = []
            total += self._total(held)
        return total


_COUNTS: dict[str, Counts] = {}


def _worker(path: str, shared) -> Counts:
    if path not in _COUNTS:
        _COUNTS[path] = Counts(path, shared.value if shared is not None else {})
    return _COUNTS[path]


def _kernel(path: str, shared, n_keep: int):
    def run(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        counts = _worker(path, shared)
        for b in batches:
            texts = b.column(n_keep)
            n = [counts.count(t.as_py()) for t in texts]
            size = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keep], size, pa.array(n, pa.int64())],
                                             names=[*b.schema.names[:n_keep], "n_bytes", "n_tokens"])
    return run


def _pieces_kernel(path: str):
    def run(batches):
        import pyarrow as pa
        counts, seen = Counts(path, {}), Counter()
        for b in batches:
            for t in b.column(0):
                pattern, data = counts.cutter(t.as_py() or "")
                seen.update(p for p in pattern.findall(data) if len(p) <= PIECE)
        if seen:
            names = [p.decode("latin-1") if isinstance(p, bytes) else p for p in seen]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             names=["piece", "n"])
    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", sample_rows: int = 2000,
                     table_size: int = 50_000) -> dict[str, int]:
    """Token counts of the ``table_size`` most frequent pre-tokens in about ``sample_rows`` documents.

    Only speed depends on this bounded sample: what the table lacks is encoded by the workers.
    """
    prepare(docs.sparkSession)
    if not cuts_like_this(path):
        return {}
    total = docs.count()
    rate = min(1.0, sample_rows / max(1, total))
    draw = F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 20)) < F.lit(int(rate * (1 << 20)))
    rows = docs.select(F.col(text_col).alias("text")).where(draw) \
        .mapInArrow(_pieces_kernel(path), "piece string, n long") \
        .groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(table_size).collect()
    pieces = [r["piece"] for r in rows]
    return dict(zip(pieces, Counts(path, {}).lengths(pieces)))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024,
                 sample_rows: int = 2000, table_size: int = 50_000) -> DataFrame:
    """One row per input row: ``(doc_id, n_bytes, n_tokens, over_limit)``.

    ``n_tokens`` is what the library gives for the whole text with the file at ``path`` (on every worker; a byte-level
    BPE file takes the two tiers, another kind whole texts), without begin, end or added special tokens; the strings of the file's own added tokens inside a text
    are one token each, the library's default.  ``n_bytes``: UTF-8.  Null and empty texts count 0 and 0.  Repeated
    rows each get a row; extra columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col, sample_rows, table_size))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_kernel(path, shared, 1), f"doc_id {kind}, n_bytes long, n_tokens long") \
        .select("*", (F.col("n_tokens") > limit).alias("over_limit"))
