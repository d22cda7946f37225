"""Substring dedup: sliding sentence spans, joined globally; non-first repeats leave the texts.

A span is the shortest run of at least ``span`` consecutive sentences with at least ``min_words`` words, from each
sentence on.  Sentences of more than ``long_sentence`` words are divided where their own words say so, so that a
passage pasted in mid-sentence is divided alike in every document that has it.  Repeats inside a document are seen
where it is read; across documents only ``(span hash, doc_id)`` is shuffled, reduced to the smallest id.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import prepare
from chatloom.session import work_dir

WS = r"\x20\x09-\x0D"
# fixed values: characters of scripts written without blanks are words of their own; full stops of several scripts
ALONE = ("\u0E00-\u0EFF", "\u1000-\u109F", "\u1780-\u17FF", "\u3040-\u30FF", "\u3400-\u4DBF", "\u4E00-\u9FFF", "\uF900-\uFAFF",
         "\U00020000-\U0003FFFF")
STOPS = (".", "!", "?", "。", "！", "？", "।")
_ALONE = re.compile(f"[{''.join(ALONE)}]")
_WORDS = re.compile(f"(?:[{''.join(ALONE)}]|[^{WS}{''.join(ALONE)}]+)[{WS}]*")
_LEAD = re.compile(f"[{WS}]*")
_STOPS = tuple(s.encode("utf-8") for s in STOPS)
LAST = (1 << 63) - 1  # where rows without an id stand
CODES = 1 << 18  # words whose codes a worker remembers
_codes: dict[bytes, int] = {}


def word_codes(words: list[bytes]):
    """The first 32 bits of each word's md5, remembered for frequent words."""
    import numpy as np
    got = list(map(_codes.get, words))
    if None in got:
        if len(_codes) + len(words) > CODES:
            _codes.clear()
        for i, (w, c) in enumerate(zip(words, got)):
            if c is None:
                got[i] = _codes[w] = int.from_bytes(hashlib.md5(w).digest()[:4], "big")
    return np.array(got, dtype=np.int64)


def text_words(text: bytes):
    """``(words, starts, stops)``: lower-cased (A-Z) words, the byte where each starts, whether a sentence ends behind it."""
    import numpy as np
    decoded = text.decode("utf-8")
    if _ALONE.search(decoded):
        pieces = [p.encode("utf-8") for p in _WORDS.findall(decoded)]
        lead = len(_LEAD.match(decoded).group())  # ASCII: one byte each
        starts = lead + np.cumsum([0] + [len(p) for p in pieces])[:-1]
        words = [p.rstrip(b" \t\n\x0b\x0c\r").lower() for p in pieces]
        return words, starts, np.array([b"\n" in p or w.endswith(_STOPS) for p, w in zip(pieces, words)], dtype=bool)
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return words, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    data = np.frombuffer(text, dtype=np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    behind = starts + np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    last = data[behind - 1]
    stops = (last == 46) | (last == 33) | (last == 63)
    if any(s in text for s in _STOPS[3:]):  # those beyond ASCII
        stops |= np.array([w.endswith(_STOPS) for w in words], dtype=bool)
    lines = np.flatnonzero(data == 10)
    if len(lines):
        stops |= np.searchsorted(lines, np.append(starts[1:], len(data))) > np.searchsorted(lines, behind)
    return words, starts, stops


def sentence_starts(words: list[bytes], stops, long_sentence: int, reach: int):
    """Numbers of the words at which a sentence, or a part of a long one, starts.

    A sentence ends behind a word that ends in a full stop, and where the line ends.  One of more than
    ``long_sentence`` words is divided behind each word whose md5 is below that of the ``reach`` words before it and
    not above that of the ``reach`` words behind it, all within the sentence, and after every ``long_sentence`` words
    without such a place.
    """
    import numpy as np
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    first = np.concatenate([[True], stops[:-1]])
    no = np.cumsum(first) - 1
    size = np.bincount(no)
    inside = np.flatnonzero((size > long_sentence)[no])
    start = first.copy()
    if len(inside):
        top = np.int64(1) << 32
        at = inside + reach * (no[inside] + 1)  # sentences stand ``reach`` places apart
        code = np.full(n + reach * (no[-1] + 2), top)
        code[at] = word_codes([words[i] for i in inside.tolist()] if len(inside) < n else words)
        here = code[at]
        low = np.ones(len(at), dtype=bool)
        for k in range(1, reach + 1):
            low &= (here < code[at - k]) & (here <= code[at + k])
        behind = inside[low] + 1
        start[behind[behind < n]] = True
        part = np.maximum.accumulate(np.where(start, np.arange(n), 0))
        start[inside[(inside - part[inside]) % long_sentence == 0]] = True
    return np.flatnonzero(start)


def sentence_spans(text: bytes, span: int, min_words: int, long_sentence: int, reach: int):
    """``(bounds, spans)``: the byte where each sentence starts, and the text's end; ``(hash, first, last)`` of each span.

    Hashes read the words lower-cased (A-Z), joined by single blanks.
    """
    import numpy as np
    import xxhash
    words, starts, stops = text_words(text)
    at = sentence_starts(words, stops, long_sentence, reach)
    ends = np.append(at[1:], len(words))[:len(at)]
    last = np.maximum(np.arange(len(at)) + span - 1, np.searchsorted(ends, at + min_words))
    first = np.flatnonzero(last < len(at))
    last = last[first]
    plain = b" ".join(words)
    place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)])
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(plain[a:z], 3) for a, z in zip(place[at[first]].tolist(), (place[ends[last]] - 1).tolist())], dtype=np.uint64)
    return np.append(starts[at], len(text)), list(zip(hashes.view(np.int64).tolist(), first.tolist(), last.tolist()))


def _span_kernel(*rule):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids, lists = [], []
            for i, t in enumerate(b.column(1)):
                hashes = {s[0] for s in sentence_spans(t.as_buffer().to_pybytes() if t.is_valid else b"", *rule)[1]}
                if hashes:
                    ids.append(i)
                    lists.append(sorted(hashes))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int32())), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["doc", "spans"])
    return run


def clean_text(text: bytes, repeats, *rule):
    """``(text without the sentences of repeated spans, or None if all stay, sentences, sentences removed)``.

    ``repeats``: hashes of spans that an earlier document has.  A span that this text has already had is a repeat, too.
    """
    repeats = set(repeats or ())
    bounds, spans = sentence_spans(text, *rule)
    seen, lost = set(), set()
    for h, i, k in spans:
        if h in repeats or h in seen:
            lost.update(range(i, k + 1))
        seen.add(h)
    n = len(bounds) - 1
    if not lost:
        return None, n, 0
    return text[:bounds[0]] + b"".join(text[bounds[i]:bounds[i + 1]] for i in range(n) if i not in lost), n, len(lost)


def _clean_kernel(n_keep: int, *rule):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts, sizes, gone = [], [], []
            for t, r in zip(b.column(n_keep), b.column(n_keep + 1)):
                text, n, lost = clean_text(t.as_buffer().to_pybytes(), r.as_py(), *rule) if t.is_valid else (None, 0, 0)
                texts.append(t.as_py() if text is None else text.decode("utf-8"))
                sizes.append(n)
                gone.append(lost)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())],
                names=[*b.schema.names[:n_keep], "_clean", "_sentences", "_removed"])
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 3, min_words: int = 30,
                   long_sentence: int = 12, reach: int = 3) -> DataFrame:
    """``(doc, repeats)``: for each id the hashes of its spans that a smaller id has as well."""
    spark = docs.sparkSession
    prepare(spark)
    folder = work_dir(spark, "spans")
    # read twice below: written once, with the ids run-length coded
    docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).alias("text")) \
        .mapInArrow(_span_kernel(span, min_words, long_sentence, reach), "doc long, spans array<long>") \
        .write.mode("overwrite").parquet(folder)
    spans = spark.read.schema("doc long, spans array<long>").parquet(folder).select("doc", F.explode("spans").alias("span"))
    firsts = spans.groupBy("span").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .where("first < last").select("span", "first")
    return spans.join(firsts, "span").where("doc > first") \
        .groupBy("doc").agg(F.collect_set("span").alias("repeats"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 3, min_words: int = 30,
                   long_sentence: int = 12, reach: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The input rows with cleaned texts, and ``n_sentences`` and ``n_removed`` (parts of divided sentences count).

    Of a span that repeats, the sentences stay in the document with the smallest id, at their first place in it.
    Words are runs of characters other than ASCII white space, A-Z read as a-z; in scripts written without blanks each
    character is one.  White space goes with the word before it.  ``sentence_starts`` has the rule of sentences.
    ``keep``: the input columns to return besides the text (all by default); same-named ones give way to the counts.
    Null and empty texts stay as they are with counts 0.  Rows that repeat an id count as one document and are
    cleaned alike; rows without an id stand together after all others.  Ties need no rule, as ids and places differ.
    An empty table gives no rows.
    """
    counts = ("n_sentences", "n_removed")
    cols = [c for c in (docs.columns if keep is None else keep) if c not in counts]
    found = repeated_spans(docs, id_col, text_col, span, min_words, long_sentence, reach)
    key = F.coalesce(docs[id_col].cast("long"), F.lit(LAST))
    rest = [c for c in cols if c != text_col]
    # the narrow side is hashed, so the texts are shuffled once and not sorted
    joined = docs.join(found.hint("shuffle_hash"), key == found["doc"], "left").select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(rest)], docs[text_col].alias("text"), found["repeats"].alias("repeats"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in joined.schema.fields[:-2])
    made = joined.mapInArrow(_clean_kernel(len(rest), span, min_words, long_sentence, reach), kept + "_clean string, _sentences long, _removed long")
    named = {text_col: F.col("_clean").alias(text_col)} | {c: F.col(f"c{i}").alias(c) for i, c in enumerate(rest)}
    return made.select(*[named[c] for c in cols], *([] if text_col in cols else [named[text_col]]),
                       F.col("_sentences").alias("n_sentences"), F.col("_removed").alias("n_removed"))


def clean_corpus(docs: DataFrame, **options) -> DataFrame:
    """The input's columns with cleaned texts; ``n_chars`` follows, and documents of which nothing is left go."""
    text_col = options.get("text_col", "text")
    out = remove_repeats(docs.withColumnsRenamed({c: f"_in_{c}" for c in ("n_sentences", "n_removed") if c in docs.columns}), **options)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_sentences")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length(text_col).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    out = out.drop("n_sentences", "n_removed")
    return out.withColumnsRenamed({f"_in_{c}": c for c in ("n_sentences", "n_removed") if c in docs.columns}).select(*docs.columns)
