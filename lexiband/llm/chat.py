"""Chat formatting: one training text for each participant of a dialogue.

The dialogue is rendered once for every participant, with that participant as the assistant,
the others as named users, and the mask on what the assistant says. DataFrame functions only.

A dialogue may hold a third of all turns, so it is never gathered whole: turns are numbered
by a distributed sort without their texts, and a text holds at most TURNS successive turns of one dialogue as seen
by one participant. Longer dialogues go on in further segments.

Defined results: a null role is the participant "unknown", a null text is empty, null
dialogue ids are one dialogue. Turns come in the order of `turn`, null last; turns of equal
number by speaker, then by a digest of the text; repeated rows are turns of their own. The
role "system" is context in every rendering and no participant; a dialogue of system turns
alone gives no text. Marks in a text are broken up by a space, so that no turn can pretend to
be another. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiband.llm.common import kept, small
from lexiband.operators.ranking import release, standing, with_rank

TURNS, COPIES, SYSTEM, UNKNOWN = 64, 4096, "system", "unknown"
OPEN, END = "<|", "<|end|>\n"


def plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, speaker, body and `place`, the number of the turn in its dialogue from 0.

    What is sorted over all dialogues has a digest in place of the text; a dialogue's first rank, which is
    combined before the shuffle, makes it a place. No window runs over a dialogue. The text
    then meets its place by what it was sorted by. Rows alike in all of that are one row with
    the number of copies, whose places follow each other.
    """
    spark = rows.sparkSession
    turns = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.replace(F.coalesce(F.col(role).cast("string"), F.lit(UNKNOWN)), F.lit(OPEN), F.lit("< |")).alias("speaker"),
        plain(F.col(text)).alias("body"),
    ).withColumn("digest", F.sha2("body", 256))
    key = ["conv", "turn", "speaker", "digest"]
    order = [F.asc_nulls_first("conv"), F.asc_nulls_last("turn"), F.asc("speaker"), F.asc("digest"), F.asc("_row")]
    mark = standing()
    ranked = with_rank(turns.select(*key, F.monotonically_increasing_id().alias("_row")), order)
    firsts = kept(ranked.groupBy(F.col("conv").alias("conv_of")).agg(F.min("rank").alias("first")))
    placed = ranked.join(small(firsts), F.col("conv").eqNullSafe(F.col("conv_of")))
    places = placed.groupBy(*key).agg(F.min(F.col("rank") - F.col("first")).alias("at"), F.count("*").alias("copies"))
    places = kept(places.select(*(F.col(name).alias(f"{name}_of") for name in key), "at", "copies"))
    release(spark, mark)

    def met(some: DataFrame) -> DataFrame:
        same = [F.col(name).eqNullSafe(F.col(f"{name}_of")) for name in key]
        return turns.join(small(some), same[0] & same[1] & same[2] & same[3])

    single = met(places.where("copies = 1")).select("conv", "speaker", "body", F.col("at").alias("place"))
    again = met(places.where("copies > 1")).groupBy("conv", "speaker", "at", "copies").agg(F.first("body").alias("body"))
    # Counted in two steps, so that no array is long.
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    again = again.select("*", steps.alias("step"))
    upto = F.least(F.col("copies") - 1, F.col("step") * COPIES + COPIES - 1)
    again = again.withColumn("copy", F.explode(F.sequence(F.col("step") * COPIES, upto)))
    return single.unionByName(again.select("conv", "speaker", "body", (F.col("at") + F.col("copy")).alias("place")))


def perspectives(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns: int = TURNS,
) -> DataFrame:
    """conv_id, speaker, segment, n_turns, text, mask: `mask` has the start and end, in
    characters, of each stretch that the speaker says, up to and with its end mark."""
    said = numbered_turns(rows, conv, turn, role, text)
    speaker = F.replace(F.coalesce(F.col(role).cast("string"), F.lit(UNKNOWN)), F.lit(OPEN), F.lit("< |"))
    speakers = kept(
        rows.select(F.col(conv).alias("conv_of"), speaker.alias("seen_by")).where(F.col("seen_by") != SYSTEM).distinct()
    )
    # The text moves once, to its segment; at most `turns` rows in a group. It is multiplied for the
    # participants only where it is rendered.
    segments = (
        said.withColumn("segment", F.floor(F.col("place") / turns).cast("int"))
        .groupBy("conv", "segment")
        .agg(F.array_sort(F.collect_list(F.struct("place", "speaker", "body"))).alias("said"))
    )
    seen = segments.join(small(speakers), F.col("conv").eqNullSafe(F.col("conv_of")))

    def head(one: Column) -> Column:
        return (
            F.when(one["speaker"] == SYSTEM, F.lit("<|system|>\n"))
            .when(one["speaker"] == F.col("seen_by"), F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), one["speaker"], F.lit("|>\n")))
        )

    def piece(one: Column) -> Column:
        return F.concat(head(one), one["body"], F.lit(END))

    def span(held: Column, one: Column) -> Column:
        start = held["at"] + F.char_length(head(one))
        end = start + F.char_length(one["body"]) + F.lit(len(END))
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(one["speaker"] == F.col("seen_by"), F.concat(held["spans"], own)).otherwise(held["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    nothing = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )
    return seen.select(
        F.col("conv").alias(conv),
        F.col("seen_by").alias("speaker"),
        "segment",
        F.size("said").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("said", piece), "").alias("text"),
        F.aggregate("said", nothing, span)["spans"].alias("mask"),
    )
