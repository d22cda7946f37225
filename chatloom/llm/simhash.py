"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by the pigeonring principle.

A fingerprint pair within ``max_bits`` differing bits, cut into a ring of ``segments`` parts, has a
start segment from which *every* chain of l consecutive segments differs in at most
``l * max_bits / segments`` bits.  The leading segments whose budget is below one bit must be equal,
which gives the join key; the longer chains prune the candidates before the full Hamming check.
With 5 segments and 2 bits the key has 25-26 bits and each distinct fingerprint is sent 5 times.
A key that very many fingerprints share is split by its other segments: there are more of those than
differing bits, so one of them is equal as well, and no pair is lost.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import connected_components, cut, prepare

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
CHUNK = 1 << 20  # bytes of a long text that are split into words at a time


def shingle_hashes(text: str, words: int, seed: int):
    """Yield arrays of the XXH64 of each shingle of the lower-cased text, one array per slice of the text."""
    import numpy as np
    import xxhash
    h64 = xxhash.xxh64_intdigest
    data = text.encode("utf-8").lower()  # bytes.lower() touches A-Z only
    pos, size, carry, made = 0, len(data), [], False
    while pos < size:
        end = size
        if size - pos > CHUNK:
            m = _SPACE.search(data, pos + CHUNK)
            end = m.start() if m else size
        toks = carry + data[pos:end].split()  # ASCII white space: 20, 09-0D
        pos = end
        if len(toks) >= words:
            joined = b" ".join(toks)
            ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            made = True
            yield np.array([h64(joined[s:e], seed) for s, e in
                            zip(starts[:len(toks) - words + 1].tolist(), ends[words - 1:].tolist())], dtype=np.uint64)
            carry = toks[-(words - 1):] if words > 1 else []
        else:
            carry = toks
    if not made and carry:
        yield np.array([h64(b" ".join(carry), seed)], dtype=np.uint64)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash: a bit is 1 if it is set in over half of the shingle hashes; no word gives 0."""
    import numpy as np
    n, ones = 0, np.zeros(64, dtype=np.int64)
    for h in shingle_hashes(text or "", words, seed):
        for k in range(0, len(h), 1 << 15):
            part = h[k:k + (1 << 15)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def _kernel(words: int, seed: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            fps = [fingerprint(t.as_py(), words, seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                 seed: int = 42) -> DataFrame:
    """``(doc_id, fp)`` for every row; null and word-less texts get 0."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_kernel(words, seed), "doc_id long, fp long")


def ring_plan(segments: int, max_bits: int) -> tuple[list[int], int]:
    """Bit masks of the segments and the number of leading segments that must be equal."""
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(segments)]
    run = 0
    while run < segments and (run + 1) * max_bits // segments == 0:
        run += 1
    return masks, run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def ring_links(classes: DataFrame, max_bits: int = 2, segments: int = 5, split_over: int = 4096) -> DataFrame:
    """``(a, b)`` class pairs whose fingerprints differ in at most ``max_bits`` bits.

    ``classes``: ``(rep, fp)``, one row per distinct fingerprint.  Needs ``segments > max_bits``.  Keys of more than
    ``split_over`` fingerprints are split; every size gives the same pairs.
    """
    masks, run = ring_plan(segments, max_bits)
    if not run:
        raise ValueError("segments must exceed max_bits")

    def chain(start: int, length: int) -> int:
        m = 0
        for j in range(length):
            m |= masks[(start + j) % segments]
        return _signed(m)

    def parts(start: int):
        return F.array(*[F.struct(F.lit(j).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(masks[(start + j) % segments])))
                                  .alias("value")) for j in range(run, segments)])

    keys = F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(chain(i, run))).alias("key"),
                              parts(i).alias("parts")) for i in range(segments)])
    sent = classes.select("rep", "fp", F.inline(keys))
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("value")))
    if segments - run > max_bits:
        hot = sent.groupBy(F.col("start").alias("hs"), F.col("key").alias("hk")).count().where(F.col("count") > split_over) \
            .select("hs", "hk", F.lit(True).alias("hot"))
        sent = sent.join(hot, (F.col("start") == F.col("hs")) & (F.col("key") == F.col("hk")), "left") \
            .select("rep", "fp", "start", "key", F.inline(F.when(F.col("hot"), F.col("parts")).otherwise(whole)))
    else:
        sent = sent.select("rep", "fp", "start", "key", F.inline(whole))
    x, y = sent.alias("x"), sent.alias("y")
    diff = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    passes = F.bit_count(diff) <= max_bits
    for length in range(segments - 1, run, -1):  # shorter chains are tested first
        mask = F.lit(chain(0, length))
        for i in range(1, segments):
            mask = F.when(F.col("x.start") == i, F.lit(chain(i, length))).otherwise(mask)
        passes = (F.bit_count(diff.bitwiseAND(mask)) <= length * max_bits // segments) & passes
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("start", "key", "part", "value")]
    on = same[0] & same[1] & same[2] & same[3] & (F.col("x.rep") < F.col("y.rep")) & passes
    return x.join(y, on).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2, segments: int = 5, seed: int = 42) -> DataFrame:
    """One row per input row: ``(doc_id, fingerprint, component_id)``.

    Texts are lower-cased (A-Z), cut at ASCII white space and read whole in ``words``-word shingles
    (fewer words: one shingle of all).  Rows with equal fingerprints form a class first, so copies
    never become pairs; links run between classes, and ``component_id`` is the smallest ``doc_id``
    reachable.  Null and empty texts have fingerprint zero and link like any other.  A null
    ``doc_id`` gets a row and can't name a component (null when nobody else in it can).  Repeated
    rows each get a row.  Extra columns are not read; an empty table gives no rows.
    """
    marked = cut(fingerprints(docs, id_col, text_col, words, seed))
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    comps = connected_components(ring_links(classes, max_bits, segments))
    named = classes.join(comps, F.col("rep") == F.col("node"), "left") \
        .select(F.col("fp").alias("cfp"), F.coalesce("component", "rep").alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("cfp"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _row_kernel(words: int, seed: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            fps = [fingerprint(t.as_py(), words, seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps, pa.int64())], names=["row", "id", "fp"])
    return run


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The input rows that stay: the smallest ``doc_id`` of each component, all columns unchanged.

    Where rows repeat an id, a row stays by its own text: the one in whose component the id is the smallest.  Of such
    rows with one fingerprint the one with the least digest of its text, then of its columns, stays.  Rows with a null
    ``doc_id`` can't be told apart and always stay.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = cut(near_duplicates(docs, **options))
    kept = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_kept_id"), F.col("fingerprint").alias("_print")).count()
    rows = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).count()
    once = kept.join(rows.where("count = 1"), F.col("_kept_id") == F.col("_id"), "left_semi").select("_kept_id")
    more = rows.where("count > 1").select("_id")
    key = docs[id_col].cast("long")
    out = docs.join(once, key == once["_kept_id"], "left_semi")
    if not more.isEmpty():
        held = docs.join(more, key == more["_id"], "left_semi")
        held = held.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"),
                           F.col(id_col).cast("long").alias("id"))
        kind = held.schema["row"].dataType.simpleString()
        held = held.mapInArrow(_row_kernel(options.get("words", 3), options.get("seed", 42)), f"row {kind}, id long, fp long")
        order = F.concat_ws(":", F.sha2(F.coalesce(F.col("row")[text_col], F.lit("")), 256), F.to_json("row"))
        one = held.groupBy("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("print")).agg(F.min_by("row", order).alias("row"))
        stay = one.join(kept, (F.col("id") == F.col("_kept_id")) & (F.col("print") == F.col("_print")), "left_semi")
        out = out.unionByName(stay.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
    return out.unionByName(docs.where(docs[id_col].isNull()))
