"""Language ID: interpolated Kneser-Ney character models, least length-normalised cross-entropy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.charlm import CharModel, count_ngrams, letter_symbols
from chatloom.llm.common import cut, prepare

PART = 1 << 21  # symbols that are held at a time
FOLDS = 5  # one fold of ids is never learnt from


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


class LanguageModels:
    """Models of all languages, the posterior's sharpness and the rejection bound."""

    def __init__(self, model: CharModel | None):
        self.model, self.sharpness, self.mean, self.spread, self.noise, self.z = model, 1.0, 0.0, 0.0, 0.0, 8.0

    def entropies(self, texts):
        """(cross-entropies in nats a symbol, documents x languages; symbols)."""
        import numpy as np
        out, held, size = [], [], 0
        for i, t in enumerate(texts):  # a bounded part of a batch is spelt out at a time
            held.append(letter_symbols(t))
            size += len(held[-1])
            if size >= PART or i == len(texts) - 1:
                out.append(self.model.score(held))
                held, size = [], 0
        if not out:
            return np.zeros((0, len(self.model.labels))), np.zeros(0, dtype=np.int64)
        sums, sizes = (np.concatenate(x) for x in zip(*out))
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def calibrate(self, rows) -> None:
        """``rows``: (language, symbols, cross-entropies) of learnable texts that no model has counted.

        Sharpness: the power of the likelihood a symbol, times the square root of the length, that fits the labels best.
        Rejection: beyond twice the mean cross-entropy of a text in its own language, and ``z`` deviations from
        that mean; the spread of long texts and the noise of short ones (falling with the square root of the
        length) are fitted apart.
        """
        import numpy as np
        labels = self.model.labels
        rows = [r for r in rows if r["lang"] in labels and r["symbols"]]
        if not rows:
            return
        own = np.array([labels.index(r["lang"]) for r in rows])
        n = np.array([r["symbols"] for r in rows], dtype=float)
        ce = np.array([r["entropies"] for r in rows])
        self.sharpness = float(min(2.0 ** np.arange(-2, 7), key=lambda b: _log_loss(ce, n, own, b)))
        mine = ce[np.arange(len(own)), own]
        self.mean = float(np.average(mine, weights=n))
        off = (mine - self.mean) ** 2
        long = n >= np.median(n)
        self.spread = float(np.sqrt(off[long].mean()))
        self.noise = float(np.sqrt(np.maximum(off[~long] - self.spread ** 2, 0).dot(n[~long]) / max(1, (~long).sum())))

    def predict(self, texts):
        """Lists (language, score, cross-entropy, rejected); no letter: ``und``, 0, null, rejected."""
        import numpy as np
        if self.model is None:
            return [("und", 0.0, None, True)] * len(texts)
        ce, n = self.entropies(texts)
        post = _posterior(ce, n, self.sharpness)
        best = ce.argmin(axis=1)
        at = np.arange(len(best))
        limit = self.mean + np.maximum(self.z * np.sqrt(self.spread ** 2 + self.noise ** 2 / np.maximum(n, 1)), self.mean)
        low, p = ce[at, best], post[at, best]
        return [(self.model.labels[k], float(p[i]), float(low[i]), bool(low[i] > limit[i])) if n[i]
                else ("und", 0.0, None, True) for i, k in enumerate(best)]


def _posterior(ce, n, sharpness):
    import numpy as np
    x = -ce * (sharpness * np.sqrt(n))[:, None]
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _log_loss(ce, n, own, sharpness):
    import numpy as np
    p = _posterior(ce, n, sharpness)[np.arange(len(own)), own]
    return -np.log(np.maximum(p, 1e-12)).mean()


def _entropy_kernel(models):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            ce, n = models.value.entropies(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ce.tolist(), pa.list_(pa.float64()))],
                                             names=["lang", "symbols", "entropies"])
    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 4,
        docs_per_lang: int = 1000, max_langs: int = 2000, seed: int = 7) -> LanguageModels:
    """Models of all languages, from about ``docs_per_lang`` whole documents of each.

    More than ``max_langs`` labels are an error: the models are broadcast, and grow with the number of labels.
    The sample is the bounded one that a classifier may be fitted on: documents outside the held-out fold with a
    known language, drawn by a hash of the id.  One in five of them calibrates and is not counted.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text")).where("lang is not null and doc_id is not null")
    rows = rows.where(~held_out())
    sizes = rows.groupBy("lang").count().limit(max_langs + 1).collect()
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} language labels")
    if not sizes:
        return LanguageModels(None)
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rate = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, docs_per_lang / r["count"])))])
    sample = cut(rows.where(draw < F.element_at(rate, F.col("lang")))
                 .withColumn("judge", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(5)) == 0))
    counts = count_ngrams(sample.where("not judge").select(F.col("lang").alias("label"), "text"), order, letters=True)
    models = LanguageModels(CharModel.build(counts, order, "kn") if counts else None)
    if models.model is not None:
        got = sample.where("judge").select("lang", "text").mapInArrow(
            _entropy_kernel(spark.sparkContext.broadcast(models)), "lang string, symbols long, entropies array<double>")
        models.calibrate(got.collect())
    return models


def _kernel(models, n_keep: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            got = models.value.predict(b.column(n_keep).to_pylist()) if b.num_rows else []
            cols = list(zip(*got)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keep], *[pa.array(c, t) for c, t in
                                        zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))]],
                names=[*b.schema.names[:n_keep], "lang_pred", "score", "cross_entropy", "rejected"])
    return run


def identify(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(doc_id, held_out, lang_pred, score, cross_entropy, rejected)``.

    ``lang_pred`` is the learnt language of least cross-entropy a symbol over the whole text, ``score`` its
    calibrated posterior (0 to 1; ties go to the first language by code point).  A text is rejected if even
    that cross-entropy is far beyond what the language's own texts have, or if it is null, empty or without a
    letter (``und``, score 0, cross-entropy null).  Only the text decides.  A null ``doc_id`` isn't held out;
    repeated rows are judged alike; with nothing to learn from every text is ``und``; extra columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_kernel(spark.sparkContext.broadcast(models), 2),
                          f"doc_id {kind}, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean")


def keep_identified(docs: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """The input rows whose language is recognised, all columns unchanged."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array([not r[3] for r in shared.value.predict(b.column(at).to_pylist())], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
