import hashlib

import pytest
from pyspark.sql import functions as F

from tidewire.llm.block_dedup import drop_exact_copies, exact_groups


def expected(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(text or "", []).append((doc_id is not None, doc_id or 0, i))
    out = []
    for doc_id, text in rows:
        best = max(groups[text or ""])
        out.append((doc_id, rows[best[2]][0], len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"block_chars": 4}, {"block_chars": 3, "key": "pmod(xxhash64(content), 3)"}])
def test_equals_plain_grouping(spark, prose, options):
    texts = [None, "", "a", "ab", "abcd", "abcde", "abcdabcd", "abcdabcdx", "é" * 9, "🙂" * 7, prose(200)]
    rows = [(i, texts[i * 7 % len(texts)]) for i in range(40)] + [(None, "ab"), (3, "abcd"), (3, "abcd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    options = {k: F.expr(v) if k == "key" else v for k, v in options.items()}  # a weak key makes keys collide
    got = exact_groups(df, **options).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(
        (d or -1, k, n, s) for d, k, n, s in expected(rows)
    )
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(k) == 1 for k in by_text.values())


def test_odd_rows_and_columns(odd_documents, no_documents):
    kept = drop_exact_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7]
    assert exact_groups(no_documents).count() == 0 and drop_exact_copies(no_documents).count() == 0
