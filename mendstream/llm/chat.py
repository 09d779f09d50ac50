"""Chat formatting by perspective rotation: for every participant of a conversation, the dialogue with that speaker as assistant,
all others as named users, and masks that train on the assistant's turns only.

The result has one row per participant and turn, with the place of the turn in the rendered text, so a conversation of any length is
never gathered in one row or task. Places are running sums over blocks of turns; copies of a turn are counted first
and follow each other.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

OPEN, NAME, BODY, CLOSE = "<|", " name=", "|>\n", "<|end|>\n"
TURNS = 64  # turn numbers of a block
SLOTS = 64  # parts of the turns that share a number


def perspectives(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, speaker, seq, turn, role (assistant or user), name (of users), text, segment, start, end, mask_start, mask_end, train.

    ``speaker`` is the participant that speaks as assistant. Turns come in order of turn number (null last), those with one
    number in order of a hash of role and text; ``seq`` counts them from 0. ``segment`` is the rendered turn, at code points [start, end) of
    the whole rendering; [mask_start, mask_end) is its trained part, the text and end mark of assistant turns, empty for others. A null role is the
    participant "unknown", a null text is empty, rows equal in all four columns are turns of their own. Null is a
    conversation of its own. Other columns are not read. A conversation with one participant has one rendering without users.
    """
    rows = df.select(F.col(conv_col).alias("_c"), F.col(turn_col).cast("long").alias("_t"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("_r"), F.coalesce(F.col(text_col), F.lit("")).alias("_x"))
    rows = rows.groupBy("_c", "_t", "_r", "_x").agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_k", F.xxhash64("_r", "_x")).withColumn("_slot", F.pmod(F.shiftrightunsigned("_k", 40), F.lit(SLOTS)).cast("int"))
    rows = rows.withColumn("_block", F.when(F.col("_t").isNotNull(), F.floor(F.col("_t") / TURNS)))
    people = rows.select("_c", F.col("_r").alias("speaker")).distinct()
    both = rows.join(people, rows["_c"].eqNullSafe(people["_c"])).select(rows["*"], "speaker")
    assistant = F.col("speaker") == F.col("_r")
    head = F.when(assistant, F.lit(OPEN + "assistant" + BODY)).otherwise(F.concat(F.lit(OPEN + "user" + NAME), F.col("_r"), F.lit(BODY)))
    both = both.withColumn("segment", F.concat(head, F.col("_x"), F.lit(CLOSE))).withColumn("_head", F.length(head)).withColumn("_len", F.length("segment").cast("long"))

    key = ["_c", "speaker"]
    order = [F.col("_t").isNull(), "_t"]
    # three levels of running sums: blocks of a conversation, slots of a block, turns of a slot
    slots = both.groupBy(*key, "_block", "_t", "_slot").agg(F.sum(F.col("_len") * F.col("_n")).alias("_sl"), F.sum("_n").alias("_sn"))
    blocks = slots.groupBy(*key, "_block").agg(F.sum("_sl").alias("_bl"), F.sum("_sn").alias("_bn"))
    before = W.partitionBy(*key).orderBy(F.col("_block").isNull(), "_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*key, "_block", F.coalesce(F.sum("_bl").over(before), F.lit(0)).alias("_b0"), F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_m0"))
    inside = W.partitionBy(*key, "_block").orderBy(*order, "_slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.select(*key, "_block", "_t", "_slot", F.coalesce(F.sum("_sl").over(inside), F.lit(0)).alias("_s0"), F.coalesce(F.sum("_sn").over(inside), F.lit(0)).alias("_q0"))
    base = slots.join(blocks, slots["_c"].eqNullSafe(blocks["_c"]) & (slots["speaker"] == blocks["speaker"]) & slots["_block"].eqNullSafe(blocks["_block"])).select(slots["_c"], slots["speaker"], slots["_t"], "_slot", (F.col("_b0") + F.col("_s0")).alias("_start"), (F.col("_m0") + F.col("_q0")).alias("_seq"))
    least = W.partitionBy(*key, "_t", "_slot").orderBy("_k", "_r", "_x").rowsBetween(W.unboundedPreceding, -1)
    both = both.withColumn("_l0", F.coalesce(F.sum(F.col("_len") * F.col("_n")).over(least), F.lit(0))).withColumn("_n0", F.coalesce(F.sum("_n").over(least), F.lit(0)))
    out = both.join(base, both["_c"].eqNullSafe(base["_c"]) & (both["speaker"] == base["speaker"]) & both["_t"].eqNullSafe(base["_t"]) & (both["_slot"] == base["_slot"])).select(both["*"], "_start", "_seq")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    start = F.col("_start") + F.col("_l0") + F.col("_copy") * F.col("_len")
    out = out.withColumn("start", start).withColumn("end", F.col("start") + F.col("_len"))
    train = F.col("speaker") == F.col("_r")
    return out.select(
        F.col("_c").alias("conv_id"), "speaker", (F.col("_seq") + F.col("_n0") + F.col("_copy")).alias("seq"), F.col("_t").alias("turn"),
        F.when(train, "assistant").otherwise("user").alias("role"), F.when(~train, F.col("_r")).alias("name"), F.col("_x").alias("text"), "segment", "start", "end",
        F.when(train, F.col("start") + F.col("_head")).otherwise(F.col("end")).alias("mask_start"), F.col("end").alias("mask_end"), train.alias("train"),
    )


def op5(spark, sf_dir: str) -> DataFrame:
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# Turns that share a number come in the order of Spark's hash there; here the order is stated for distinct turn numbers and checked elsewhere otherwise.
SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS r, coalesce(text, '') AS x FROM conversations),
     p AS (SELECT DISTINCT conv_id, r AS speaker FROM t),
     b AS (SELECT t.conv_id, speaker, turn, r, x, r = speaker AS train,
                  CASE WHEN r = speaker THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || r || '|>' || chr(10) END AS head FROM t JOIN p USING (conv_id)),
     s AS (SELECT *, head || x || '<|end|>' || chr(10) AS segment FROM b),
     e AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, speaker ORDER BY turn ROWS UNBOUNDED PRECEDING) AS e,
                  row_number() OVER (PARTITION BY conv_id, speaker ORDER BY turn) - 1 AS seq FROM s)
SELECT conv_id, speaker, seq, turn, CASE WHEN train THEN 'assistant' ELSE 'user' END AS role, CASE WHEN NOT train THEN r END AS name, x AS text, segment,
       CAST(e - length(segment) AS BIGINT) AS start, CAST(e AS BIGINT) AS "end",
       CAST(CASE WHEN train THEN e - length(segment) + length(head) ELSE e END AS BIGINT) AS mask_start, CAST(e AS BIGINT) AS mask_end, train
FROM e
"""
