"""Chat formatting with Spark expressions only (operator 5).

Turns of a conversation are collected as structs and sorted; adjacent turns of
the same role become one block whose parts keep their own borders; blocks are
concatenated. Everything is a DataFrame expression, and each array is walked a
fixed number of times, so the work is linear in the conversation.

Layout of a block: ``<|im_start|>role<|im_sep|>part<|im_part|>part<|im_end|>``.
Roles and texts are escaped: a backslash is doubled, and a backslash is put
after the first character of every control string, so none occurs inside a
text; dropping each escaping backslash gives the text back.

Defined results: a null text or role counts as empty; turns are ordered by
turn, role and text (nulls first), so ties and repeated rows are kept in a
fixed order; rows with a null conversation id form one conversation; an empty
table gives an empty result; other columns are not read. A formatted
conversation is one string and so limited to 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, PART, END = "<|im_start|>", "<|im_sep|>", "<|im_part|>", "<|im_end|>"

# Control strings of common chat templates; "<|" begins all of this one's.
CONTROL_STRINGS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL_STRINGS:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, formatted, mask)``, one row per conversation.

    ``mask`` has one entry per turn, in order: ``gap`` characters of the
    formatted string that come before the turn's text, ``chars`` characters of
    (escaped) text, and whether these are under the loss. Lengths count code
    points.
    """
    empty = F.lit("")
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), empty).alias("text"),
        ).alias("turn"),
    )
    # Turns are put in order as they were said; escapes would order ties otherwise.
    ordered = turns.groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    sorted_turns = ordered.select(
        "conv",
        F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"),
    )
    # Positions where the role changes; the size is appended as the last border.
    borders = sorted_turns.withColumn(
        "borders",
        F.concat(
            F.filter(
                F.sequence(F.lit(0), F.size("turns") - 1),
                lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]),
            ),
            F.array(F.size("turns")),
        ),
    )
    blocks = borders.select(
        "conv",
        F.transform(
            F.slice("borders", F.lit(1), F.size("borders") - 1),
            lambda start, k: F.struct(
                F.col("turns")[start]["role"].alias("role"),
                F.slice(F.col("turns")["text"], start + 1, F.col("borders")[k + 1] - start).alias("texts"),
            ),
        ).alias("blocks"),
    )
    text = F.array_join(
        F.transform(
            "blocks",
            lambda b: F.concat(F.lit(START), b["role"], F.lit(SEP), F.array_join(b["texts"], PART), F.lit(END)),
        ),
        "",
    )

    def block_mask(block: Column, k: Column) -> Column:
        head = F.length(block["role"]) + len(START) + len(SEP) + F.when(k == 0, 0).otherwise(len(END))
        return F.transform(
            block["texts"],
            lambda t, i: F.struct(
                F.when(i == 0, head).otherwise(len(PART)).cast("bigint").alias("gap"),
                F.length(t).cast("bigint").alias("chars"),
                (block["role"] == escape(F.lit(LOSS_ROLE))).alias("loss"),
            ),
        )

    return blocks.select(
        F.col("conv").alias(conv_col),
        text.alias("formatted"),
        F.flatten(F.transform("blocks", block_mask)).alias("mask"),
    )


def _parts(formatted: Column) -> Column:
    """The parts of a formatted string as they stand in it: gap before the text, its characters, role and text, escaped."""
    split = F.split(formatted, r"<\|im_start\|>")
    blocks = F.slice(split, F.lit(2), F.size(split))

    def parts_of(block: Column, k: Column) -> Column:
        role = F.substring_index(block, SEP, 1)
        body = F.substr(block, F.length(role) + len(SEP) + 1, F.length(block) - F.length(role) - len(SEP) - len(END))
        head = F.length(role) + len(START) + len(SEP) + F.when(k == 0, 0).otherwise(len(END))
        return F.transform(
            F.split(body, r"<\|im_part\|>"),
            lambda p, i: F.struct(
                F.when(i == 0, head).otherwise(len(PART)).cast("bigint").alias("gap"),
                F.length(p).cast("bigint").alias("chars"),
                role.alias("role"),
                p.alias("text"),
            ),
        )

    return F.flatten(F.transform(blocks, parts_of))


def parse_conversations(df: DataFrame, formatted_col: str = "formatted") -> DataFrame:
    """``df`` with ``turns``: the ``(role, text)`` structs read back from the formatted string."""
    turn = lambda p: F.struct(unescape(p["role"]).alias("role"), unescape(p["text"]).alias("text"))
    return df.withColumn("turns", F.transform(_parts(F.col(formatted_col)), turn))


def digests(df: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations hold, read back from them and their masks.

    The text under the loss is what lies in the string at the mask's spans: each
    span of the mask must be that of a part of the string, or an error is raised.
    """
    span = lambda x: F.struct(x["gap"].alias("gap"), x["chars"].alias("chars"))
    placed = df.withColumn("parts", _parts(F.col("formatted")))
    agree = F.transform("parts", span) == F.transform("mask", span)
    under = F.transform(
        F.filter(F.arrays_zip("parts", "mask"), lambda x: x["mask"]["loss"]), lambda x: unescape(x["parts"]["text"])
    )
    error = F.raise_error(F.lit("the loss mask does not fit the formatted text"))
    read = placed.select(
        conv_col,
        "formatted",
        "parts",
        F.when(agree, F.array_join(under, "")).otherwise(error.cast("string")).alias("loss_text"),
    )
    said = F.transform("parts", lambda p: F.concat(unescape(p["role"]), F.lit("\n"), unescape(p["text"]), F.lit("\n")))
    return read.select(
        conv_col,
        F.size("parts").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
