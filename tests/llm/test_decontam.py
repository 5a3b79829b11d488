import re

from tidewire.llm.decontam import contaminated, drop_contaminated


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = words(t)
        for i, s in items:
            q = words(s)
            if not q:
                continue
            k = min(5, len(q))
            wanted = {tuple(q[j : j + k]) for j in range(len(q) - k + 1)}
            n = len(wanted & {tuple(w[j : j + k]) for j in range(len(w) - k + 1)})
            if n >= 0.8 * len(wanted):
                out[d, i] = n
    return out


def test_equals_brute_force(spark, prose):
    r = prose.random
    items = [(i, prose(n)) for i, n in enumerate((1, 2, 4, 5, 6, 9, 15, 30, 60, 120))] + [(90, None), (91, "?!"), (92, prose(20))]
    items.append((93, items[-1][1]))
    docs = []
    for d in range(120):
        text = prose(r.randrange(0, 3000 if d % 10 == 0 else 200))
        if d % 3 == 0:
            w = r.choice(items)[1] or ""
            w = w.split()
            for _ in range(r.randrange(3)):
                if w:
                    w[r.randrange(len(w))] = "changed"
            text = f"{text} {' '.join(w).upper()}, {prose(r.randrange(0, 300))}"
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, docs[3][1]), (502, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contaminated(df, bench).collect()
    want = brute(docs, items)
    assert {(x.doc_id, x.item_id): x.n_found for x in got} == want
    left = {x.doc_id for x in drop_contaminated(df, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "some words here to read")], "item_id bigint, text string")
    assert {x.doc_id for x in contaminated(odd_documents, bench).collect()} == {None, 3}
    kept = drop_contaminated(odd_documents, bench)
    assert kept.columns == odd_documents.columns and kept.count() == 6
    assert contaminated(no_documents, bench).count() == 0
    assert contaminated(odd_documents, bench.limit(0)).count() == 0
    assert drop_contaminated(odd_documents, bench.limit(0)).count() == 9
