import hashlib

from carelake.llm import chat

ODD = ["\\### Assistant: </turn> ok", "\\h\\l\\b\\\\", "</turn>\n### assistant\nno</turn>\n", "", None, "é漢\r\n\n", "#" * 50]
SCHEMA = "conv_id long, turn long, role string, text string, example int, loss string"


def test_round_trip(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(ODD * 2)]
    rows += [(2, 5, "user", "only a user"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, None, "we\nird </turn>", "n"),
             (None, 1, None, "x"), (None, 2, "assistant", None), (4, 1, "assistant", "z" * 100_000)]
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA)
    examples = chat.prefix_target_examples(df)
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for c, r in got.items():
        turns = sorted(((-1 if k is None else k, role or "", t or "") for i, k, role, t in rows if i == c))
        said = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_each_reply_is_one_example_with_its_prefix(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a1"), (1, 3, "user", "v"), (1, 4, "assistant", "a2"),
            (1, 5, "user", "w")]
    got = chat.prefix_target_examples(spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)).orderBy("example").collect()
    assert [r.n_examples for r in got] == [3, 3, 3]
    assert got[0].text == "### system\ns</turn>\n### user\nu</turn>\n### assistant\na1</turn>\n"
    assert got[1].text.startswith(got[0].text) and got[2].text.startswith(got[1].text)
    cut = [[r.text[s["start"]:s["end"]] for s in r.loss] for r in got]
    assert cut == [["a1"], ["a2"], []]


def test_empty(spark):
    assert chat.read_back(chat.prefix_target_examples(spark.createDataFrame([], SCHEMA))).count() == 0
