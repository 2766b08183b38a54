"""Gates around an answer: its context, refusals, citations, and the conversation it belongs to."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse

#: How an answer cites, and the delimiters around text that isn't trusted.
MARKER = r"\[C([0-9]+)\]"
OPEN, CLOSE = "<<<context", "context>>>"
REFUSAL = "I can't answer this from the documents I have."
#: Ours: wordings that ask the assistant to leave its role.
PROBES = r"(?i)(ignore|disregard|forget)\s+(all\s+|any\s+|your\s+|the\s+|prior\s+|previous\s+)*(instructions|rules|prompts?)|(reveal|show|print|repeat)\s+(\w+\s+){0,3}(system\s+prompt|everything\s+above)"


def injection(text: Column) -> Column:
    return F.coalesce(text.rlike(PROBES), F.lit(False))


def context_blocks(context: DataFrame) -> DataFrame:
    """(query_id, context, n_blocks): labelled blocks in order of position, each between delimiters that its own text can't close.

    context: query_id, position, marker, title, path, text.
    """
    safe = F.replace(F.replace(F.col("text"), F.lit(CLOSE), F.lit("")), F.lit(OPEN), F.lit(""))
    block = F.concat(F.lit(OPEN + "\n"), "marker", F.lit(" "), "title", F.when(F.col("path") != "", F.concat(F.lit(" > "), "path")).otherwise(F.lit("")), F.lit("\n"), safe, F.lit("\n" + CLOSE))
    ordered = F.array_sort(F.collect_list(F.struct("position", block.alias("block"))))  # at most the context's size
    return context.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda x: x["block"]), "\n\n").alias("context"), F.count("*").cast("int").alias("n_blocks"))


def citations(answers: DataFrame) -> DataFrame:
    """(query_id, marker_index) of every different marker in an answer's text."""
    found = F.array_distinct(F.regexp_extract_all("answer", F.lit(MARKER), F.lit(1)))
    return answers.select("query_id", F.explode(found).alias("n")).select("query_id", F.col("n").try_cast("int").alias("marker_index"))


def validated(cited: DataFrame, context: DataFrame) -> DataFrame:
    """Citations with ``valid``: whether the marker names a block of the query's context, and that block's doc_id."""
    known = context.select("query_id", F.col("position").alias("marker_index"), "doc_id")
    return cited.join(known, ["query_id", "marker_index"], "left").withColumn("valid", F.col("doc_id").isNotNull())


def finish(questions: DataFrame, answers: DataFrame, context: DataFrame) -> DataFrame:
    """(query_id, finish_reason, answer): what each question ends with.

    A question that asks the assistant out of its role is refused by the
    guardrail; one without context is refused before an answer is made; an
    answer without a valid marker is replaced by the refusal; a question with
    context but no answer is an error.
    """
    blocks = context.groupBy("query_id").agg(F.count("*").alias("n_blocks"))
    valid = validated(citations(answers), context).groupBy("query_id").agg(F.count_if("valid").alias("n_valid"))
    rows = questions.select("query_id", "text").join(answers.select("query_id", "answer"), "query_id", "left").join(blocks, "query_id", "left").join(valid, "query_id", "left")
    reason = (
        F.when(injection(F.col("text")), "refused_guardrail").when(F.col("n_blocks").isNull(), "refused_no_context")
        .when(F.col("answer").isNull(), "error").when(F.coalesce("n_valid", F.lit(0)) == 0, "refused_no_context").otherwise("answered")
    )
    return rows.select("query_id", reason.alias("finish_reason"), "answer").withColumn(
        "answer", F.when(F.col("finish_reason") == "answered", F.col("answer")).when(F.col("finish_reason") != "error", F.lit(REFUSAL))
    )


def resolve(cited: DataFrame, chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """The passage behind every valid citation: chunk joined with its document."""
    return cited.where("valid").join(chunks, "doc_id").join(documents, "document_id")


def condensed(turns: DataFrame, questions: DataFrame, most: int = 6) -> DataFrame:
    """(query_id, text, verbatim): the standalone query for retrieval, and the last three turns for the answer.

    turns: conv_id, turn, role, text; questions: query_id, conv_id, turn, text.
    Without a model the query is the question itself; a rewriting model takes
    ``history``, the last ``most`` turns before it.
    """
    t = turns.select("conv_id", F.col("turn").alias("earlier"), F.concat("role", F.lit(": "), "text").alias("line"))
    before = questions.join(t, "conv_id").where("earlier < turn")
    near = before.withColumn("back", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("earlier")))).where(F.col("back") <= most)
    lines = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("earlier", "line")))), lambda x: x["line"]), "\n")
    history = near.groupBy("query_id").agg(lines(F.lit(True)).alias("history"), lines(F.col("back") <= 3).alias("verbatim"))
    return questions.select("query_id", "text").join(history, "query_id", "left")


def cached(questions: DataFrame) -> DataFrame:
    """``questions`` with ``asked_first``: the earliest query_id with the same words (case, white space and signs at the end folded)."""
    key = F.regexp_replace(F.lower(collapse(F.col("text"))), r"[ ?!.]+$", "")
    keyed = questions.withColumn("cache_key", F.sha2(F.coalesce(key, F.lit("")), 256))
    # A popular question is one row before the shuffle, and the join can split its rows.
    first = keyed.groupBy("cache_key").agg(F.min("query_id").alias("asked_first"))
    return keyed.join(first, "cache_key").select(*questions.columns, "cache_key", "asked_first")


def owned(conversations: DataFrame, callers: DataFrame) -> DataFrame:
    """Conversations of the callers (user_id) that aren't archived; others are as if they weren't there."""
    return conversations.where(~F.coalesce("is_archived", F.lit(False))).join(callers.select("user_id").distinct(), "user_id", "left_semi")


def archived(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """``conversations`` with those of ``ids`` (conv_id) marked as archived; no row goes."""
    gone = ids.select("conv_id", F.lit(True).alias("gone")).distinct()
    return conversations.join(gone, "conv_id", "left").withColumn("is_archived", F.coalesce("gone", "is_archived", F.lit(False))).drop("gone")


def page(rows: DataFrame, keys: list[str], after: tuple, size: int) -> DataFrame:
    """The next ``size`` rows after the cursor ``after`` in ascending order of ``keys``; a short page is the last."""
    later = F.lit(False)
    for i in reversed(range(len(keys))):
        later = (F.col(keys[i]) > after[i]) | ((F.col(keys[i]) == after[i]) & later)
    return rows.where(later).orderBy(*keys).limit(size)


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, transcript_hash): digest of a conversation's lines "role: text" in order of turns.

    The turns of a conversation meet in order, and only the digest so far is
    carried from one to the next, so a conversation of any length needs no
    memory.  Turns without a role or text have no line but count.
    """

    def run(batches):
        key, digest, n, lines = run, hashlib.sha256(), 0, 0  # no key is equal to a function

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "n_turns", "transcript_hash"])

        for batch in batches:
            for k, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if k != key:
                    if n:
                        yield out()
                    key, digest, n, lines = k, hashlib.sha256(), 0, 0
                n += 1
                if line is not None:
                    digest.update(("\n" if lines else "").encode() + line.encode("utf-8", "surrogatepass"))
                    lines += 1
        if n:
            yield out()

    lines = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.concat("role", F.lit(": "), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "turn").mapInArrow(run, "conv_id long, n_turns long, transcript_hash string")
