import re
from collections import Counter

import numpy as np
import pytest

from tidewire.llm import line_dedup
from tidewire.llm.line_dedup import Filters, drop_repeated_lines, has


def key(line):
    k = re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)
    return "".join(c.lower() if c.isascii() else c for c in k)


def brute(rows, min_docs, keep="none", min_chars=1):
    """(id, kept text, lines, dropped lines) of (id, text)."""
    lines = [(i, (t or "").split("\n")) for i, t in rows]
    times = Counter(k for _, ls in lines for k in {key(x) for x in ls} if len(k) >= max(min_chars, 1))
    first = {}
    for i, ls in sorted(lines, key=lambda x: (x[0] is not None, x[0])):
        for at, x in enumerate(ls):
            first.setdefault(key(x), (i, at))
    out = []
    for i, ls in lines:
        kept = [x for at, x in enumerate(ls) if times[key(x)] < min_docs or (keep == "first" and first[key(x)] == (i, at))]
        out.append((i, "\n".join(kept), len(ls), len(ls) - len(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


@pytest.fixture
def lined(prose):
    r = prose.random
    common = [prose(4) for _ in range(8)] + ["", "  ", "Ä b", "ä b", "X\x0by", "\x85odd\x85"]
    rows = []
    for i in range(150):
        own = [prose(3) for _ in range(r.randrange(4))] + [r.choice(["", " \t", "\r"]) + r.choice([str.upper, str])(r.choice(common)) + r.choice(["", "\f"]) for _ in range(r.randrange(7))]
        r.shuffle(own)
        rows.append((i, "\n".join(own)))
    return rows + [(3, rows[3][1]), (7, rows[7][1]), (None, rows[9][1]), (900, None), (901, ""), (902, "\n\n"), (903, "one line " * 30_000)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("held", [line_dedup.HELD, 0])
def test_equals_brute_force(spark, lined, keep, held):
    df = spark.createDataFrame(lined, "doc_id bigint, text string").repartition(5)
    assert rows_of(drop_repeated_lines(df, 10, keep, held=held)) == brute(lined, 10, keep)


def test_full_filters_lose_nothing(spark, lined):
    df = spark.createDataFrame(lined, "doc_id bigint, text string").repartition(7)
    for min_docs, min_chars in ((2, 1), (3, 12)):
        assert rows_of(drop_repeated_lines(df, min_docs, "none", min_chars, bits=64)) == brute(lined, min_docs, "none", min_chars)


def test_filters_never_miss_a_repeat():
    r = np.random.default_rng(3)
    keys = [r.bytes(16) for _ in range(5000)]
    parts = [Filters(1 << 15) for _ in range(3)]
    for i in range(0, 5000, 500):
        parts[i // 500 % 3].add(keys[i : i + 500])
    parts[1].add(keys[:700])
    parts[0].add(keys[4000:4300] * 2)
    pieces = [(0, *x) for p in parts for _, *x in p.pieces()]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pieces, strict=True)], ["piece", "once", "twice"])
    (merged,) = line_dedup._merge(1 << 15)([batch])
    twice = line_dedup._unpacked(merged.column(1)[0].as_py(), 1 << 15)
    assert has(twice, line_dedup._numbers(keys[:700])).all() and has(twice, line_dedup._numbers(keys[4000:4300])).all()


def test_sparse_filters_suspect_few():
    r = np.random.default_rng(4)
    filters, keys = Filters(1 << 20), [r.bytes(16) for _ in range(60_000)]
    for i in range(0, 60_000, 3000):
        filters.add(keys[i : i + 3000])
    assert has(filters.twice, line_dedup._numbers(keys)).mean() < 0.02


def test_odd_rows(odd_documents, no_documents):
    got = rows_of(drop_repeated_lines(odd_documents, 2))
    assert [x[1] for x in got if x[0] in (None, 3, 6, 7)] == [""] * 5 and [x[2:] for x in got if x[0] in (1, 2)] == [(1, 0)] * 2
    assert rows_of(drop_repeated_lines(no_documents)) == []
    with pytest.raises(ValueError, match="keep"):
        drop_repeated_lines(odd_documents, keep="last")
