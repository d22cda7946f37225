"""Anchor counts of the full chain at two scale factors."""

import pytest
from pyspark.sql import functions as F

from chatloom.plans.catalog import doc_samples, flagship
from chatloom.operators.vocab import vocab_from_samples
from chatloom.operators.windows import build_windows
from chatloom.operators.tokenize import encode_samples

from conftest import SF001, SF01

ANCHORS = {
    SF001: dict(n_dialogs=16, vocab_size=68, n_tokens=37653, n_windows=270, mask_sum=8498, ids_sum=2591705),
    SF01: dict(n_dialogs=98, vocab_size=85, n_tokens=283362, n_windows=2067, mask_sum=57223, ids_sum=21747061),
}


@pytest.mark.parametrize("d", [SF001, SF01])
def test_dialog_anchor(spark, d):
    assert flagship(spark, d).first().asDict() == ANCHORS[d]


def test_text_path_anchor(spark):
    s = doc_samples(spark, SF001).cache()
    v = vocab_from_samples(s)
    t = encode_samples(s, v).agg(F.sum(F.size("token_ids")).alias("n")).first().n
    w = build_windows(s, v)
    n_w = w.count()
    assert (t, n_w) == (485288, 3510)
    # tail tokens dropped: tokens past the last full window of long samples
    L = encode_samples(s, v).select(F.size("token_ids").alias("L"))
    dropped = L.where("L > 257").select(
        (F.col("L") - ((F.ceil((F.col("L") - 256) / 128) - 1) * 128 + 257)).alias("d")).agg(F.sum("d")).first()[0]
    assert dropped == 12134
