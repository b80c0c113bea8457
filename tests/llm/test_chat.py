from __future__ import annotations

import random

from pyspark.sql import functions as F

from cartlens.llm import chat
from cartlens.llm.queries import QUERIES
from tests.llm import brute

MESSAGES = "tree long, message long, parent long, role string, text string, score double, path string"


def plain(turns):
    whole = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    masked = "".join(text or "" for role, text in turns if role == "assistant")
    return len(turns), brute.sha(whole), len(masked), brute.sha(masked)


def digested(df):
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    return {r["conv_id"]: tuple(r[x] for x in names) for r in df.collect()}


def test_given_conversations(spark):
    rows = spark.read.parquet(f"{brute.FOLDER}/conversations.parquet").collect()
    turns = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    own = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", own), ("assistant", own)]
    assert digested(QUERIES["op9_chat_format"](spark, brute.FOLDER)) == {k: plain(v) for k, v in turns.items()}


def test_hostile_texts_are_read_back(spark):
    chance = random.Random(13)
    parts = ["</s>", "[INST] ", "[TEXT] ", "<<SYS>> ", "\\", "\\s", "\\b", "[ROLE] ", "a", "\n", "é", " ", "", "[REPLY] "]
    rows, turns = [], {}
    for conv in range(60):
        for turn in range(chance.randrange(1, 6)):
            role = chance.choice(["user", "assistant", "system", "tool", "[x] </s>", "", None])
            text = chance.choice([None, "".join(chance.choice(parts) for _ in range(8))])
            rows.append((conv, turn, role, text, "x"))
            turns.setdefault(conv, []).append((role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    formatted = chat.conversations_of(chat.turns_as_messages(df))
    assert digested(chat.digests(formatted)) == {k: plain(v) for k, v in turns.items()}


def plain_paths(rows):
    """tree -> paths from roots to leaves."""
    out = {}
    for tree in {r[0] for r in rows}:
        parent = {r[1]: r[2] for r in rows if r[0] == tree}
        for leaf in set(parent) - set(parent.values()):
            path, at = [], leaf
            while at in parent and at not in path:
                path.append(at)
                at = parent[at]
            out.setdefault(tree, []).append(tuple(path[::-1]))
    return out


def random_trees():
    chance = random.Random(14)
    rows = []
    for tree in range(20):
        n = chance.randrange(1, 40)
        for message in range(n):
            parent = None if not message else chance.choice([message - 1, chance.randrange(message)])
            rows.append((tree, message, parent, "user", f"m{message}", float(chance.randrange(4)), "x"))
    rows.append((50, 1, 77, "user", "its parent is missing", None, "x"))
    rows += [(51, 1, 2, "user", "cycle", 1.0, "x"), (51, 2, 1, "user", "cycle", 1.0, "x"), (51, 3, 2, "user", "tail", 1.0, "x")]
    rows += [(52, i, i - 1 if i else None, "user", str(i), 0.0, "x") for i in range(300)]
    return rows


def test_paths_and_ranks(spark):
    rows = random_trees()
    expected = plain_paths([r for r in rows if r[0] != 51])
    score = {(r[0], r[1]): r[5] or 0.0 for r in rows}
    df = spark.createDataFrame(rows, MESSAGES).repartition(5)
    found = {}
    for r in chat.paths(df).collect():
        found.setdefault(r["tree"], []).append(tuple(r["path"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    best = {}
    for tree, all_paths in expected.items():
        means = sorted((-sum(score[tree, m] for m in p) / len(p), p[-1]) for p in all_paths)
        best[tree] = [leaf for _, leaf in means[:2]]
    chosen = {}
    for r in sorted(chat.conversations_of(df, 2).collect(), key=lambda r: r["rank"]):
        chosen.setdefault(r["tree"], []).append(r["leaf"])
    assert chosen == best


def test_repeated_turns_and_empty_table(spark):
    rows = [(1, 0, "user", "b", "x"), (1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (None, 0, "user", "z", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string")
    got = digested(chat.digests(chat.conversations_of(chat.turns_as_messages(df))))
    assert got == {1: plain([("user", "a"), ("user", "a"), ("user", "b")]), None: plain([("user", "z")])}
    assert chat.digests(chat.conversations_of(chat.turns_as_messages(df.limit(0)))).collect() == []


def test_repeated_message_numbers_and_missing_keys(spark):
    rows = [(1, 1, None, "user", "root", 1.0, "x")] * 3
    rows += [(1, 2, 1, "assistant", "b", 1.0, "x"), (1, 2, 1, "assistant", "a", 1.0, "x"), (1, 3, 2, "user", "end", None, "x")]
    rows += [(None, 1, None, "user", "no tree", 1.0, "x"), (2, None, None, "user", "no number", 1.0, "x")]
    df = spark.createDataFrame(rows, MESSAGES)
    assert [(r["tree"], r["leaf"], r["path"]) for r in chat.paths(df).collect()] == [(1, 3, [1, 2, 3])]
    found = chat.conversations_of(df, 5).collect()
    assert [(r["tree"], r["rank"], r["leaf"]) for r in found] == [(1, 1, 3)]
    assert found[0]["formatted"] == "[INST] root</s>[REPLY] a</s>[INST] end</s>"
    assert [tuple(x) for x in found[0]["mask"]] == [(23, 24)]


def test_mask_of_branching_trees(spark):
    """Each chosen branch of random trees: what the spans cut out are its assistant texts."""
    chance = random.Random(15)
    parts = ["</s>", "[REPLY] ", "\\", "a", "é", "𝄞", "\n", ""]
    rows, by_number = [], {}
    for tree in range(12):
        for message in range(chance.randrange(1, 25)):
            parent = chance.randrange(message) if message else None
            role = chance.choice(["user", "assistant", "assistant", "tool", None])
            text = chance.choice([None, "".join(chance.choice(parts) for _ in range(6))])
            rows.append((tree, message, parent, role, text, float(chance.randrange(5)), "x"))
            by_number[tree, message] = (role or "", text or "")
    df = spark.createDataFrame(rows, MESSAGES).repartition(4)
    paths = {(r["tree"], r["leaf"]): r["path"] for r in chat.paths(df).collect()}
    found = chat.conversations_of(df, 100).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert {(r["tree"], r["leaf"]) for r in found} == set(paths)
    for r in found:
        turns = [by_number[r["tree"], m] for m in paths[r["tree"], r["leaf"]]]
        assert [tuple(x) for x in r["turns"]] == turns
        cut = [r["formatted"][x["start"] : x["end"]] for x in r["mask"]]
        for plain, written in chat.ESCAPES[::-1]:
            cut = [x.replace(written, plain) for x in cut]
        assert cut == [text for role, text in turns if role == "assistant"]


def test_a_long_thread_takes_few_rows(spark):
    """A row per message and round, however long the thread is."""
    df = spark.range(3000).selectExpr("1L tree", "id message", "if(id = 0, null, id - 1) parent", "1.0D score")
    ends, jumps = chat.climbed(df)
    assert len(jumps) == 12
    assert (ends.count(), ends.where("leaf").count()) == (3000, 1)
    steps = chat.walked(chat.branches_of(ends), jumps)
    assert steps.where("message + height <> 2999").count() == 0
    assert steps.count() == 3000
