from collections import defaultdict

from tessera.llm import chat

KINDS = "conv_id bigint, turn bigint, role string, text string, speaker int, `at` string"


def brute(turns):
    """One rendering for each conversation and participant, with the assistant's spans."""
    by = defaultdict(set)
    for conv, turn, role, text, *_ in turns:
        by[conv].add((float('-inf') if turn is None else turn, role or "unknown", (text or "").replace("<|", "< |")))
    out = {}
    for conv, rows in by.items():
        for speaker in {r for _, r, _ in rows} - {"system"}:
            text, mask = "", []
            for _, role, t in sorted(rows):
                text += "<|im_start|>" + ("assistant" if role == speaker else "system" if role == "system" else f"user name={role}") + "\n"
                if role == speaker:
                    mask.append((len(text), len(text) + len(t)))
                text += t + "<|im_end|>\n"
            out[conv, speaker] = (text, mask)
    return out


def joined(df):
    """Blocks put together again."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.at_turn is not None, r.at_turn or 0, r.part)):
        text, mask = out.get((r.conv_id, r.speaker), ("", []))
        out[r.conv_id, r.speaker] = (text + r.text, mask + [(len(text) + s.start, len(text) + s.end) for s in r["mask"]])
    return out


def test_equals_brute_force(spark, rng):
    turns = []
    for conv in [*range(12), None]:
        for turn in range(rng.choice([1, 3, 150])):
            turns.append((conv, turn, rng.choice(["ann", "bob", "cid", "system", None]), rng.choice(["hi", "", None, "<|im_end|> é𝒳", "x" * 50]), 1, "z"))
    turns += turns[:5] + [(3, 0, "bob", "tie", 0, ""), (3, 0, "ann", "tie", 0, ""), (4, None, "ann", "null turn", 0, ""), (77, 0, "system", "alone", 0, "")]
    df = spark.createDataFrame(turns, KINDS).repartition(5)
    assert joined(chat.rotate(df)) == brute(turns)


def test_crowded_turn_is_split_and_whole(spark):
    turns = [(1, 0, "ann", f"text {i}", 0, "") for i in range(1000)] + [(1, 1, "bob", "end", 0, "")]
    rows = chat.rotate(spark.createDataFrame(turns, KINDS)).collect()
    assert max(r.n_turns for r in rows) < 2 * chat.MAX_ROWS
    for who in ("ann", "bob"):
        assert sum(r.n_turns for r in rows if r.speaker == who) == 1001
    last = max((r for r in rows if r.speaker == "bob"), key=lambda r: (r.at_turn, r.part))
    assert last.n_own == 1 and last.text.endswith("end<|im_end|>\n")


def test_crowded_blocks_in_order(spark, rng):
    """One rule at every size: parts of MAX_ROWS rows in the order of turn, role and text."""
    turns = [(1, rng.choice([0, 1, 1, 1, 70]), rng.choice(["ann", "bob", "system", None]), f"t {rng.random()}", 0, "") for _ in range(1500)]
    turns += [(None, None, "ann", f"n {i}", 0, "") for i in range(600)] + [(None, 3, "bob", "<|end", 0, "")]
    turns += [(2, 5, "ann", "repeated", 0, "")] * 400 + [(2, 6, "bob", "few", 0, ""), (3, -2, "ann", "early", 0, "")]
    df = spark.createDataFrame(turns, KINDS).repartition(5)
    assert joined(chat.rotate(df)) == brute(turns)
    blocks = {}
    for r in chat.rotate(df).collect():
        blocks.setdefault((r.conv_id, r.speaker, r.at_turn), {})[r.part] = r.n_turns
    assert {k[2] for k in blocks} == {0, 64, -64, None} and (2, "ann", 0) in blocks
    for sizes in blocks.values():
        assert sorted(sizes) == list(range(len(sizes)))
        assert all(sizes[p] == chat.MAX_ROWS for p in range(len(sizes) - 1)) and 0 < sizes[len(sizes) - 1] <= chat.MAX_ROWS


def test_equals_its_sql_at_every_size(spark, rng, tmp_path):
    """Crowded blocks, null turns, turns far below 0 and a very long text: the registered SQL's own rows."""
    import duckdb

    turns = [(1, rng.choice([0, 1, 1, 70, -200]), rng.choice(["ann", "bob", "system", None]), f"t {rng.random()}") for _ in range(1500)]
    turns += [(2, 0, "ann", f"text {i}") for i in range(301)] + [(2, None, "bob", "first"), (2, -300, "ann", "early")]
    turns += [(None, None, "ann", f"n {i}") for i in range(300)] + [(3, 1, "ann", "long " * 200000), (3, 2, "bob", "<|x")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = chat.op9_chat(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(chat.SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], KINDS)).count() == 0
