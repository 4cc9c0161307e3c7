"""Frames whose own columns have the names that operators add: replaced by what the operator finds, everything else kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from loamworks.llm import bpe, media

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", None, "plain words", "é 中 " * 30, "plain words"]


def test_codec_columns_of_the_same_name(spark):
    df = spark.createDataFrame([(i, t, "old", "older", "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, Decoded string, lang string")
    coded = bpe.encode(df, MULTI, public_tokenizers.PATTERN)
    back = bpe.decode(coded, MULTI)
    assert sorted(back.columns) == ["decoded", "doc_id", "ids", "lang", "text"] and dict(back.dtypes)["ids"] == "array<int>"
    for r in back.collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["text"] == TEXTS[r["doc_id"]] and r["lang"] == "kept"


def test_media_columns_of_the_same_name(spark):
    df = spark.createDataFrame([(i, t, "old", -1, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, Media string, n_bytes int, feature string")
    stored = media.store(df, "text")
    assert sorted(stored.columns) == ["doc_id", "feature", "media", "n_bytes", "text"]
    found = {r["doc_id"]: r for r in stored.select("*", F.octet_length("media").alias("size")).collect()}
    assert all(found[i]["n_bytes"] == len((t or "").encode()) and found[i]["feature"] == "kept" and found[i]["size"] > 60 for i, t in enumerate(TEXTS))
    assert bytes(found[0]["media"]) == bytes(found[1]["media"]) and bytes(found[2]["media"]) == bytes(found[4]["media"])
