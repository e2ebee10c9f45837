from pyspark.sql import functions as F

from payscope.llm.chat import chat_format, formatted, loss_text, read_back

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "user", "again"), (1, 2, "assistant", "a&amp;<|im_sep|>\n"), (1, 3, "assistant", "&lt;|"), (1, 4, "user", None),
    (2, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nok"), (2, None, None, "first"), (2, 1, "assistant", "<|im_end|>\n<|im_start|>assistant\nok"),
    (None, 0, "", ""), (3, 0, "role\nwith <| and &", "x<"), (3, 1, "role\nwith <| and &", "|y"),
    (4, 0, "a\nb", "x"), (4, 1, "a&#10;b", "x"), (4, 2, "\n", "\n"), (4, 3, "&amp;#10;\n", None), (4, 4, "assistant\n", "not learned"),
]


def read(df):
    chats = chat_format(df).select("conv_id", formatted(F.col("segments")).alias("s"), loss_text(F.col("segments")).alias("loss"))
    return {r.conv_id: r for r in chats.select("*", read_back(F.col("s")).alias("turns")).collect()}


def test_reads_back(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    got = read(df.withColumn("segments", F.lit(1)).withColumn("turns", F.lit(2)))
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in ROWS if c == conv))
        assert [tuple(t) for t in r.turns] == [(role, text) for _, _, role, text in own]
        assert r.loss == "".join(text for _, _, role, text in own if role == "assistant")


def test_runs_share_a_header(spark):
    df = spark.createDataFrame(ROWS[:5], "conv_id long, turn long, role string, text string")
    s = read(df)[1].s
    assert s.startswith("<|im_start|>user\nhi<|im_sep|>again<|im_end|>\n<|im_start|>assistant\n")
    assert s.count("<|im_start|>") == 3 and s.endswith("<|im_start|>user\n<|im_end|>\n")


def test_empty(spark):
    assert chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
