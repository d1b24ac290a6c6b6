"""Conversations without an id."""

import hashlib

from corpusflow.llm import queries


def test_chat_format_of_null_conversation(spark, tmp_path):
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "good day"), (4, 0, "user", "a"), (4, 1, "assistant", "bc")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in queries.op6_chat_format(spark, str(tmp_path)).collect()}
    assert set(found) == {None, 4, -1}
    for conv_id, reply in ((None, "good day"), (4, "bc")):
        assert found[conv_id].loss_chars == len(reply)
        assert found[conv_id].loss_sha256 == hashlib.sha256(reply.encode()).hexdigest()
