"""Chat formatting against a plain Python reading, and the loss mask on the string itself."""

import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from tripgrid.llm import chat

ROWS = [
    (1, 0, "system", "Be <|im_start|> \\kind\\"),
    (1, 1, "user", "</s>[INST] a [/INST]"),
    (1, 2, "user", None),
    (1, 3, "assistant", "é🙂<"),
    (1, 4, "assistant", "|>\\|"),
    (2, 0, "assistant", ""),
    (2, 0, "assistant", ""),
    (None, 5, None, "no role"),
    (3, None, "user", "null turn"),
    (3, 0, "assis\ntant", "<<SYS>><</SYS>><s>"),
    (4, 0, "user", "x" * 200_000),
    (4, 1, "assistant", "y" * 200_000),
    # Unequal texts of one turn that their escapes would put the other way round.
    (5, 1, "assistant", "<|x"),
    (5, 1, "assistant", "<a"),
    (5, 2, "assistant", "[Z"),
    (5, 2, "assistant", "[INST]"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, mask int, turns string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


def expected(rows):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3])
    out = {}
    for conv, turns in itertools.groupby(sorted(rows, key=order), key=lambda r: r[0]):
        turns = list(turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss))
    return out


def test_digests(spark):
    out = chat.digests(chat.format_conversations(frame(spark))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in out} == expected(ROWS)


def test_mask_marks_the_texts_and_blocks_merge(spark):
    for row in chat.parse_conversations(chat.format_conversations(frame(spark))).collect():
        at, loss = 0, []
        for turn, span in zip(row.turns, row.mask, strict=True):
            at += span.gap
            piece = row.formatted[at : at + span.chars]
            assert not any(c in piece for c in chat.CONTROL_STRINGS)
            if span.loss:
                loss.append(piece)
            assert span.loss == (turn.role == "assistant")
            at += span.chars
        assert row.formatted[at:] == chat.END
        if row.conv_id == 1:
            assert row.formatted.count(chat.START) == 3 and row.formatted.count(chat.PART) == 2
            assert "".join(loss) == "é🙂<|>\\\\|"


def test_ties_are_in_text_order_and_a_wrong_mask_is_an_error(spark):
    out = chat.format_conversations(frame(spark).where("conv_id = 5"))
    turns = [t.text for t in chat.parse_conversations(out).first().turns]
    assert turns == ["<a", "<|x", "[INST]", "[Z"]
    moved = out.withColumn("mask", F.transform("mask", lambda m: m.withField("gap", m["gap"] + 1)))
    with pytest.raises(Exception, match="does not fit"):
        chat.digests(moved).collect()


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(frame(spark).where("false"))).count() == 0
