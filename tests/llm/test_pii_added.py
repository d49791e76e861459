"""Added spans of personal data reach every document."""

import re

import numpy as np
from pyspark.sql import functions as F

from daygrid.llm import pii


def test_pii_phone_with_two_zeros_alone(session):
    docs = session.createDataFrame([(1, "call 0049 30 1234567 today")], "doc_id long, text string")
    assert [r.spans for r in pii.report(docs).collect()] == ["phone:5:20"]
    assert [r.text for r in pii.redact(docs).collect()] == ["call [PHONE] today"]


def test_pii_hints_keep_every_wide_match():
    texts = {
        "email": ["a@b.org"], "ip": ["1.2.3.4"], "card": ["4111111111111111", "4111.1111.1111.1111", "4111 1111 1111 1"],
        "phone": ["0049 30 1234567", "+49 30 1234567", "001(555)1234567"],
    }
    for kind, some in texts.items():
        for text in some:
            assert re.search(pii.WIDE[kind], text) and re.search(pii.WIDE_HINT[kind], text)


def test_pii_one_document_of_many_has_a_kind(session):
    docs = session.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") == 4567, "card 4111.1111.1111.1111 of").otherwise("plain").alias("text")
    )
    for rare in range(4567, 4571):
        rows = docs.withColumn("doc_id", F.col("doc_id") + (rare - 4567) * 100_000)
        assert [r.spans for r in pii.report(rows).where("spans <> ''").collect()] == ["card:5:24"]
    without_id = docs.where("doc_id = 4567").withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.spans for r in pii.report(without_id).collect()] == ["card:5:24"]


def test_pii_threshold_of_all_bars():
    def plain(score, right, total):
        found = float("inf")
        for bar in sorted(set(score.tolist()), reverse=True):
            if right[score >= bar].sum() < pii.PRECISION * total[score >= bar].sum():
                break
            found = bar
        return found

    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 40, 40, 40):
        score, total = rng.integers(0, 12, n) / 4, rng.integers(1, 90, n).astype(float)
        right = np.where(score > rng.integers(0, 4), total, 0)
        assert pii.threshold_of(score, right, total) == plain(score, right, total)
