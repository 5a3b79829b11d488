from tidewire.llm.chat_collapse import render_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role, text))
    lists = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    kept = {}
    for c, turns in lists.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in lists.values())
        if not longer and c == max(d for d, o in lists.items() if o == turns):
            kept[c] = "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)
    return kept


def test_keeps_maximal_conversations(spark):
    base = [("user", "hello"), ("assistant", "hi"), ("user", None), ("assistant", "")]
    rows = [(c, i, *base[i]) for c, n in ((1, 1), (2, 3), (3, 4), (4, 4)) for i in range(n)]
    rows += [(5, 0, "user", "hello"), (5, 1, "assistant", "other"), (6, 0, "user", None), (7, 0, "user", ""), (8, 0, None, "hello"), (None, 0, "user", "lost")]
    got = render_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id: r.text for r in got} == plain(rows)
    assert {r.conv_id: r.n_copies for r in got}[4] == 2


def test_hash_does_not_mix_up_order_or_bounds(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (2, 2, "user", "c"), (3, 0, "usera", ""), (4, 0, "user", "ab")]
    got = render_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id for r in got} == {1, 2, 3, 4}


def test_repeated_rows_ties_and_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    got = render_conversations(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", k int, sha string")).collect()
    assert {(r.conv_id, r.n_turns) for r in got} == {(1, 2)}
    assert render_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_turns_and_long_conversations(spark):
    long = [(2, i, "user", f"say {i}") for i in range(3000)]
    rows = [(1, None, "user", "first"), (1, 0, "user", "then"), (3, None, "user", "first"), *long, *((4, *r[1:]) for r in long[:2999])]
    got = {r.conv_id: (r.n_turns, r.text) for r in render_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {1, 2} and got[1][1].index("first") < got[1][1].index("then")
    assert got[2] == (3000, "".join(f"<|im_start|>user\nsay {i}<|im_end|>\n" for i in range(3000)))
