from corpusloom.llm import chat


def brute(rows):
    """Maximal conversations, rendered whole: {conv_id: text}."""
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn if turn is not None else -(10**18), role or "", text or ""))
    lists = {c: tuple((r, t) for _, r, t in sorted(ts)) for c, ts in turns.items()}
    kept = {}
    for conv, own in sorted(lists.items(), key=lambda x: (x[0] is None, x[0] or 0)):
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in lists.values())
        if not longer and own not in kept.values():
            kept[conv] = own
    return {c: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in own) for c, own in kept.items()}


def rendered(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: r.part):
        out[row.conv_id] = out.get(row.conv_id, "") + row.text
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_snapshots_collapse(spark):
    rows = []
    for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1)):
        rows += [(conv, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(n)]
    rows += [(5, 0, "user", "turn 0"), (5, 1, "assistant", "another"), (6, 0, "system", "turn 0")]
    rows += [(7, i, "user", f"long {i}") for i in range(300)] + [(8, i, "user", f"long {i}") for i in range(299)]
    rows += [(None, 0, None, None), (9, None, "user", "x"), (9, None, "user", "x")]
    got = rendered(chat.format_chats(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "2 AS n")))
    assert got == brute(rows)
    assert set(got) == {2, 5, 6, 7, None, 9}


def test_parts_are_bounded(spark):
    rows = [(1, i, "user", str(i)) for i in range(10)]
    parts = chat.format_chats(spark.createDataFrame(rows, SCHEMA), part_turns=4).orderBy("part").collect()
    assert [p.n_turns for p in parts] == [4, 4, 2]


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
