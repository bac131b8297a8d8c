"""Quality rules on whole texts, with line frequencies across the documents of a host.

Only DataFrame functions are used. Word statistics stay inside the row as arrays; what is shuffled is one
hash per distinct line of a document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import WORD_PATTERN, id_of, text_of, words_of

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class LineLimits:
    """A line is above the limit if at least ``min_documents`` distinct documents of its host have it. A document is
    depleted if less than ``kept_share`` of its words is left.

    The count alone decides: a line above the limit stays above it, however much its host grows."""

    min_documents: int = 10
    kept_share: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD_PATTERN)))


def normal_hash(line: Column) -> Column:
    """Hash of a line in lower case with single spaces."""
    return F.xxhash64(F.lower(F.array_join(words_of(line), " ")))


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as the output of a generator of one row.

    The functions over arrays below name these columns inside of lambdas. Spark may replace the name of a plain column
    by its expression, when a filter moves down, and would then work it out again for each element.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _repeat_words(frame: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in 3-word windows that the text has twice or more.

    Each window becomes one long: the upper bits of its hash, the lower bits its place, as many as the
    text needs. Sorted, equal windows are neighbours. No less than 40 bits of hash remain in texts below 16
    million words, and two windows must agree in all of them within one text to be mistaken for each other.
    """
    mask = F.col("_mask")
    frame = once(frame, _mask=F.expr("shiftleft(1L, cast(ceil(log2(size(_words) + 1)) as int)) - 1"))
    packed = F.transform(
        "_words",
        lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))
        .bitwiseAND(F.bitwise_not(mask))
        .bitwiseOR(i.cast("long")),
    )
    frame = once(
        frame,
        _windows=F.when(F.size("_words") >= 3, F.sort_array(F.slice(packed, F.lit(1), F.size("_words") - 2))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    same = lambda x, y: F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0, F.lit(False))
    places = F.filter(
        "_windows", lambda x, i: same(x, F.get("_windows", i + 1)) | same(x, F.get("_windows", i - 1))
    )
    covered = F.aggregate(
        F.sort_array(F.transform(places, lambda x: x.bitwiseAND(mask))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n"), p.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return once(frame, n_repeat_words=covered).drop("_mask", "_windows")


def measured(documents: DataFrame, text_col: str, host_col: str, limits: LineLimits) -> DataFrame:
    """``documents`` with the base figures and ``_host``, ``_text_hash``."""
    text = text_of(text_col)
    frame = once(documents, _words=words_of(text), _lines=lines_of(text))
    frame = _repeat_words(frame)
    return frame.withColumns(
        {
            "_host": F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")),
            "_text_hash": F.xxhash64(text),
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "base_failed": (F.size("_words") < limits.min_words)
            | (F.col("n_repeat_words") * 100 > F.size("_words") * limits.max_repeat_percent),
        }
    ).drop("_words", "_lines")


def frequent_lines(
    documents: DataFrame, id_col: str, text_col: str, host_col: str, limits: LineLimits
) -> DataFrame:
    """``_host, _text_hash, _line, words``: the lines above the limits, for each distinct text that has them.

    A document is known by its id and text: repeated rows count once, copies under ids of their own count each. ``words``
    are the words of all lines of that text with this hash.
    """
    text = text_of(text_col)
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("_host")
    text_hash = F.xxhash64(text).alias("_text_hash")
    held = documents.select(
        host, id_of(id_col).alias("_id"), text_hash,
        F.explode(F.array_distinct(F.transform(lines_of(text), normal_hash))).alias("_line"),
    )
    # Rows of a hot line are spread by document and combined there, before one row per task counts them.
    per_line = held.distinct().groupBy("_host", "_line").agg(F.count("*").alias("documents"))
    above = per_line.filter(F.col("documents") >= limits.min_documents).select("_host", "_line")
    measured_lines = F.transform(
        lines_of(text), lambda x: F.struct(normal_hash(x).alias("line"), F.size(words_of(x)).alias("words"))
    )
    # Rows of one text agree on what stands at a place, so each place of a text counts once.
    return (
        documents.select(host, text_hash, F.posexplode(measured_lines).alias("_at", "_x"))
        .select("_host", "_text_hash", "_at", F.col("_x.line").alias("_line"), "_x.words")
        .join(above, ["_host", "_line"])
        .groupBy("_host", "_text_hash", "_line", "_at")
        .agg(F.max("words").alias("words"))
        .groupBy("_host", "_text_hash", "_line")
        .agg(F.sum("words").alias("words"))
    )


def apply_rules(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words``.

    One row per row of ``documents``. A null text is empty (no words: the base rules fail it), a null host is a
    host of its own, a null id stays null (rows without an id are documents by their texts). Repeated rows get equal
    rows. A document is kept if the base rules pass and at least ``kept_share`` of its words stand in lines below the
    limits; so ``min_documents`` copies on one host are depleted, as they have each other's lines.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"), F.col(host_col).alias("_h"))
    lost = (
        frequent_lines(rows, "doc_id", "_t", "_h", limits)
        .groupBy("_host", "_text_hash")
        .agg(F.sum("words").alias("n_removed_words"))
    )
    base = measured(rows, "_t", "_h", limits).drop("_t", "_h")
    removed = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    left = F.col("n_words") - removed
    return (
        base.join(lost, ["_host", "_text_hash"], "left")
        .withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * limits.kept_share))
        .withColumn("n_removed_words", removed)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "n_removed_words",
        )
    )


def clean_documents(documents: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """The documents that the rules keep, without their lines above the limits; the columns of ``documents``.

    ``n_chars``, where there is one, is counted anew for texts that changed.
    """
    frequent = frequent_lines(documents, "doc_id", "text", "source", limits)
    lost = frequent.groupBy("_host", "_text_hash").agg(
        F.sum("words").alias("_lost"), F.collect_list("_line").alias("_above")
    )
    names = [c for c in documents.columns]
    boxed = documents.select(F.struct(*names).alias("_row"), F.col("text").alias("_t"), F.col("source").alias("_h"))
    kept = (
        measured(boxed, "_t", "_h", limits)
        .filter(~F.col("base_failed"))
        .join(lost, ["_host", "_text_hash"], "left")
        .filter(F.col("n_words") - F.coalesce("_lost", F.lit(0)) >= F.col("n_words") * limits.kept_share)
    )
    text = F.when(F.col("_above").isNull(), F.col("_t")).otherwise(
        F.array_join(
            F.filter(
                F.split("_t", "\n"),
                lambda x: ~F.coalesce(F.array_contains("_above", normal_hash(x)), F.lit(False)),
            ),
            "\n",
        )
    )
    out = kept.withColumn("_new", text)
    columns = {c: F.col(f"_row.{c}") for c in names}
    columns["text"] = F.col("_new")
    if "n_chars" in names:
        same = F.col("_above").isNull()
        columns["n_chars"] = F.when(same, columns["n_chars"]).otherwise(F.length("_new")).cast(
            documents.schema["n_chars"].dataType
        )
    return out.select(*[columns[c].alias(c) for c in names])
