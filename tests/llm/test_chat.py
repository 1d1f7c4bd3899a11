import json
import random
from hashlib import sha256

import pytest
from llm_sql import matches_sql
from pyspark.sql import functions as F

from patronlens.llm import chat

SF = "/root/testdata/sf0.01"
U, A, S = "user", "assistant", "system"

# Record, its layout, its turns.
RECORDS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}, "messages", [(U, "hi"), (A, "yo")]),
    (
        {"system": "be kind", "messages": [{"content": "hi", "role": "Human ", "name": "x"}]},
        "messages",
        [(S, "be kind"), (U, "hi")],
    ),
    ({"messages": [{"role": "user", "content": None}, {"role": "tool", "content": 7}]}, "messages", [(U, None), ("tool", "7")]),
    (
        {
            "messages": [
                {
                    "role": "user",
                    "content": [
                        {"type": "text", "text": "a "},
                        {"type": "image", "image_url": {"url": "u", "sizes": [{"w": 1}]}, "text": "b"},
                    ],
                }
            ]
        },
        "message_parts",
        [(U, "a b")],
    ),
    ({"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, "from_value", [(U, "q"), (A, "r")]),
    ({"conversation": [{"role": "model", "content": "q"}]}, "conversation", [(A, "q")]),
    ({"turns": [{"role": "user", "text": "q"}]}, "role_text", [(U, "q")]),
    ({"dialogue": [{"speaker": "bot", "utterance": "q"}]}, "speaker_utterance", [(A, "q")]),
    ({"dialog": ["a", "b", "c"]}, "strings", [(U, "a"), (A, "b"), (U, "c")]),
    ({"instruction": "do", "input": "x", "output": "y"}, "instruction", [(U, "do\n\nx"), (A, "y")]),
    ({"instruction": "do", "input": "", "output": "y"}, "instruction", [(U, "do"), (A, "y")]),
    ({"instruction": "do", "output": "y", "system": "s"}, "instruction", [(S, "s"), (U, "do"), (A, "y")]),
    ({"prompt": "p", "completion": ""}, "prompt_completion", [(U, "p"), (A, "")]),
    ({"prompt": "p", "completion": None}, "prompt_completion", [(U, "p")]),
    ({"response": "r", "prompt": "p", "score": 1.5, "meta": {"role": "x"}}, "prompt_response", [(U, "p"), (A, "r")]),
    ({"question": "q", "answer": "a", "system": "s"}, "question_answer", [(S, "s"), (U, "q"), (A, "a")]),
    (
        {"prompt": [{"role": "user", "content": "p"}], "completion": [{"role": "assistant", "content": "c"}]},
        "messages_completion",
        [(U, "p"), (A, "c")],
    ),
    ({"prompt": "p"}, None, []),
    ({"prompt": "p", "messages": [{"role": "user", "content": "hi"}]}, None, []),
    ({"messages": [{"x": {"role": 1, "content": 2}}]}, None, []),
    ({}, None, []),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)]
    rows += [(100, "no json"), (101, None), (102, "[1]"), (103, '"text"')]
    df = spark.createDataFrame(rows, "id long, record string")
    turns = chat.canonical_turns(df, ["id"], "record").collect()
    for i, (_, layout, expected) in enumerate(RECORDS):
        own = sorted((t for t in turns if t.id == i), key=lambda t: t.place)
        assert [(t.role, t.text) for t in own] == expected, RECORDS[i][0]
        assert {t.layout for t in own} == ({layout} if own else set())
    open_ = {i for i, (_, layout, _) in enumerate(RECORDS) if layout is None} | {100, 101, 102, 103}
    assert {r.record.id for r in chat.unmapped(df, "record").collect()} == open_


def test_fingerprint_ignores_order_types_and_unknown_fields(spark):
    same = [
        {"prompt": "p", "completion": "c"},
        {"completion": 5, "prompt": None, "extra": {"prompt": [1], "deep": [{"role": "x"}]}},
    ]
    other = [{"prompt": ["p"], "completion": "c"}, {"prompt": "p", "completion": "c", "system": "s"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in same + other], "record string")
    found = [r[0] for r in df.select(chat.fingerprint(chat.as_record(df, "record"))).collect()]
    assert found[0] == found[1] and len(set(found)) == 3


def test_every_fingerprint_belongs_to_one_layout(spark):
    layouts = (*chat.LAYOUTS, chat.TURN_ROW)
    spark.range(1).select(chat.layout_of(F.col("id"), layouts)).collect()
    twice = chat.Layout("again", (chat.Alternating("dialog"),))
    with pytest.raises(ValueError, match="same fields"):
        chat.layout_of(F.col("id"), (*layouts, twice))


def test_columns_and_nested_columns_as_records(spark):
    df = spark.createDataFrame([(1, [("user", "a"), (None, "b")])], "id long, messages array<struct<role:string,content:string>>")
    turns = chat.canonical_turns(df, ["id"]).orderBy("place").collect()
    assert [(t.role, t.text, t.layout) for t in turns] == [("user", "a", "messages"), (None, "b", "messages")]
    with pytest.raises(ValueError, match="place"):
        chat.canonical_turns(df.withColumn("place", F.lit(1)), ["place"])


def tricky(seed, n=300):
    pick = random.Random(seed)
    parts = [*chat.CHATML.control, chat.CHATML.escape, "0", "1", "a", "b", "\n", " ", "é", "<|im_end|", "😀", "\\E", "user\n"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(8))) for _ in range(n)]


def test_escapes_are_reversible(spark):
    texts = tricky(1)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = chat.CHATML
    for escaped in (t.escaped(F.col("t")), t.escaped_role(F.col("t"))):
        rows = df.select("t", escaped.alias("e")).withColumn("back", t.unescaped(F.col("e"))).collect()
        assert all(r.back == r.t for r in rows)
        assert len({r.e for r in rows}) == len(set(texts))
        assert not any(c in r.e for r in rows for c in t.control)


def expected_of(turns):
    by_key = {}
    for key, place, role, text in turns:
        by_key.setdefault(key, []).append(((place is not None, place or 0), role or "", text or ""))
    return {k: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0], x[1].encode(), x[2].encode()))] for k, v in by_key.items()}


def test_formatted_conversations_read_back(spark):
    pick, texts = random.Random(3), tricky(2)
    roles = ["user", "assistant", "assistant", None, "", "tool\n<s>", "system", "␛1"]
    turns = [
        (pick.choice([1, 2, 3, None, -4]), pick.choice([0, 1, 2, 3, None]), pick.choice(roles), pick.choice([*texts, None]))
        for _ in range(200)
    ]
    turns += turns[:15] + [(9, 0, "assistant", "long é " * 50_000), (10, 0, "assistant", "")]
    df = spark.createDataFrame(turns, "key long, place long, role string, text string")
    whole = chat.formatted(df, "key")
    rows = whole.withColumns(
        {"turns": chat.parsed(F.col("formatted")), "loss": chat.trained_text(F.col("formatted"), F.col("spans"))}
    ).collect()
    expected = expected_of(turns)
    assert {r.key: [(t.role, t.text) for t in r.turns] for r in rows} == expected
    for r in rows:
        assert r.loss == "".join(t for role, t in expected[r.key] if role == "assistant")
        assert [s.trained for s in r.spans] == [role == "assistant" for role, _ in expected[r.key]]
        assert r.formatted.count("<|im_start|>") == len(expected[r.key])
    assert chat.formatted(df.limit(0), "key").collect() == []


def test_loss_mask_of_another_template(spark):
    template = chat.Template(opening="[[", closing="]]", escape="\\", control=("[[", "]]"), trained=("user", "assistant"))
    df = spark.createDataFrame([(1, 0, "user", "[[a]]"), (1, 1, "x", "b\\")], "key long, place long, role string, text string")
    (row,) = chat.formatted(df, "key", template).withColumn(
        "loss", chat.trained_text(F.col("formatted"), F.col("spans"), template)
    ).withColumn("turns", chat.parsed(F.col("formatted"), template)).collect()
    assert row.formatted == "[[user\n\\aa\\b]][[x\nb\\0]]" and row.loss == "[[a]]"
    assert [(t.role, t.text) for t in row.turns] == [("user", "[[a]]"), ("x", "b\\")]


def test_a_very_long_conversation(spark):
    n = 20_000
    df = spark.range(n).selectExpr("1 as key", "id as place", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    (row,) = chat.formatted(df, "key").select(
        F.size(chat.parsed(F.col("formatted"))).alias("n"), chat.trained_text(F.col("formatted"), F.col("spans")).alias("loss")
    ).collect()
    assert row.n == n and row.loss == "".join(f"t{i}" for i in range(1, n, 2))


def test_clashing_columns(spark):
    names = ["_record", "_turn", "turns", "layout2", "formatted", "spans", "key", "_key", "_order0", "_role"]
    df = spark.createDataFrame([(1, 0, "user", "a")], "id long, turn long, role string, text string")
    wide = df.withColumns({c: F.lit("mine") for c in names})
    turns = chat.canonical_turns(wide, ["id", "turn"], layouts=(chat.TURN_ROW,))
    (row,) = chat.formatted(turns, "id", order=("turn", "place")).collect()
    assert row.formatted == "<|im_start|>user\na<|im_end|>\n"


def test_query_against_sql(spark):
    rows = {r.conv_id: r for r in matches_sql(spark, "op11_chat_format", SF)}
    text = "</s>[INST] ok [/INST]"
    assert rows[-1].n_turns == 2 and rows[-1].loss_chars == len(text)
    assert rows[-1].loss_sha256 == sha256(text.encode()).hexdigest()
    assert rows[-1].turns_sha256 == sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
