from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_DIR
from loomframe.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, rendered int"


def test_hidden_roles_are_recovered(spark):
    talks = spark.read.parquet(SF_DIR.replace("sf0.001", "sf0.01") + "/conversations.parquet")
    hide = F.xxhash64("conv_id") % 3 == 0
    hidden = talks.withColumn("role", F.when(~hide, F.col("role")))
    got = chat.parse(hidden).where("piece = 0").select("conv_id", "turn", F.col("role").alias("found"))
    both = talks.where(hide).join(got, ["conv_id", "turn"])
    assert both.count() > 100
    assert both.where("role = found").count() >= 0.95 * both.count()


def test_given_roles_stay_and_texts_are_whole(spark):
    talks = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    got = chat.parse(talks)
    assert got.count() == talks.count() and got.where("not given").count() == 0
    assert got.join(talks, ["conv_id", "turn", "role", "text"]).count() == talks.count()


def test_markers_cut_turns(spark, monkeypatch):
    rows = [
        (1, 0, None, "User: hi\nAssistant: hello there\nsecond line.\nUser: fine?\nAssistant: good.", 0),
        (2, 0, "user", "what?", 0), (2, 1, None, None, 0), (2, 1, None, None, 0), (3, None, "odd", "", 0), (None, 0, "Human", "q", 0),
        (4, 0, "assistant", "x " * 40_000, 0),
    ]
    talks = spark.read.parquet(f"{SF_DIR}/conversations.parquet").selectExpr("conv_id + 100", "turn", "role", "text", "0")
    df = spark.createDataFrame(rows, SCHEMA)
    for chunk in (chat.CHUNK, 2):
        monkeypatch.setattr(chat, "CHUNK", chunk)
        got = chat.parse(df.union(talks)).where("conv_id < 100 or conv_id is null").orderBy("conv_id", "turn", "piece").collect()
        first = [(r.role, r.text) for r in got if r.conv_id == 1]
        assert first == [("user", "hi"), ("assistant", "hello there\nsecond line."), ("user", "fine?"), ("assistant", "good.")]
        assert [r.role for r in got if r.conv_id is None] == ["user"]
        assert len([r for r in got if r.conv_id == 2]) == 3 and len([r for r in got if r.conv_id == 3]) == 1
        assert [len(r.text) for r in got if r.conv_id == 4] == [80_000]


def test_rendering_and_empty_table(spark):
    assert chat.render("user", "\nhi  \n\n") == "<|user|>\nhi\n<|end|>\n"
    assert chat.parse(spark.createDataFrame([], SCHEMA)).count() == 0
