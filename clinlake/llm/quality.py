"""Quality rules: measures of each text, and lines that too many documents of a host share.

A line is compared by the hash of its normal form (lower case, runs of blanks as one space, none at the ends).
Its document count is the number of different texts of its host that hold it, so that copies of one text count
once. A line of a host is shared when that count is at least ``MIN_DOCUMENTS``, and above ``MAX_SHARE`` of the
host's different texts or at least ``MAX_DOCUMENTS``: a share alone would let more documents hold a line the larger the
host is. Shared lines are removed; a document that keeps too little is depleted and rejected.

The texts of a group of near copies differ, so that their count alone would take every line that the copies were not
edited in, and deplete them all. Lines are therefore counted a second time, and texts that the first count would deplete
and that have the same smallest shared line (by hash) then count once. Edited lines are not shared, so that near copies
agree in it. A line is removed when it is shared by both counts, as it is when it stands in texts of another body. What
is lost: where every text that holds a line is depleted by it, as are pages of nothing else, the line may stay.

Defined results: a null text has no words and fails; a null source is a host of its own; repeated rows are
judged alike and each is returned; a line without words is never removed; columns other than doc_id, text and
source are passed through by ``kept_documents`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.native import BLANK_RUN, BLANKS, let, without, words_of
from clinlake.session import stored

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"

MIN_DOCUMENTS = 10
MAX_SHARE, MAX_DOCUMENTS = 0.02, 100
#: A document is depleted when less than this share of its words is left.
MIN_LEFT_SHARE = 0.3


def measures(docs: DataFrame, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """_doc (struct of doc_id and the columns carried), _key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_doc"),
        _row_key().alias("_key"),
        F.length(without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(
            F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != ""),
            lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        ).alias("n_dup_lines"),
        let(words_of(text), lambda words: F.struct(F.size(words).cast("long").alias("n"), _repeat_words(words).alias("repeat"))).alias("_w"),
    )
    return counted.select(
        "_doc",
        "_key",
        F.col("_w.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("_w.repeat").alias("n_repeat_words"),
        ((F.col("_w.n") < MIN_WORDS) | (100 * F.col("_w.repeat") > MAX_REPEAT_PERCENT * F.col("_w.n"))).alias("base_failed"),
    )


def _repeat_words(words: Column) -> Column:
    """Words that stand in a window of WINDOW_WORDS words whose like occurs twice or more in the text.

    Windows are compared by hash. Texts without a repeated window, nearly all, end at the distinct count.
    """
    windows = F.when(
        F.size(words) >= WINDOW_WORDS,
        F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS))),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))


def _covered(hashes: Column) -> Column:
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def repeated(all_placed: Column) -> Column:
        same = F.filter(
            all_placed,
            lambda w, k: F.coalesce(F.get(all_placed, k + 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get(all_placed, k - 1)["h"] == w["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda w: w["at"]))

    def total(at: Column) -> Column:
        reach = F.transform(at, lambda p, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW_WORDS))).cast("long"))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, b: a + b)

    return let(placed, lambda p: let(repeated(p), total))


def _row_key() -> Column:
    return F.xxhash64("text", "source", "doc_id")


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, _key, _host, _content, _text_words, line_no, _line (hash), _words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Words are counted below the explosion; beside it they would be counted once a line.
    counted = docs.select("doc_id", "text", "source", F.size(words_of(text)).alias("_text_words"))
    rows = counted.select(
        "doc_id",
        _row_key().alias("_key"),
        F.coalesce(F.col("source"), F.lit("")).alias("_host"),
        F.xxhash64("text").alias("_content"),
        "_text_words",
        F.posexplode(F.split(F.lower(text), "\n")).alias("line_no", "_text"),
    )
    normal = rows.withColumn("_text", F.trim(F.regexp_replace("_text", BLANK_RUN, " "), F.lit(BLANKS))).filter("_text != ''")
    return normal.select(
        "doc_id",
        "_key",
        "_host",
        "_content",
        "_text_words",
        "line_no",
        line_hash(F.col("_text")).alias("_line"),
        F.size(F.split("_text", " ")).alias("_words"),
    )


def line_hash(text: Column) -> Column:
    """The first 60 bits of the MD5 digest, as long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _shared(n: str) -> Column:
    return F.expr(f"{n} >= {MIN_DOCUMENTS} and ({n} > {MAX_SHARE}D * _n or {n} >= {MAX_DOCUMENTS})")


def shared_lines(docs: DataFrame) -> DataFrame:
    """_host, _line (hash) and n_documents of the lines above the limits by the first count."""
    return _above_limits(docs, _lines(docs)).select("_host", "_line", "n_documents")


def _above_limits(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``shared_lines`` with _n, the number of different texts of the host."""
    by_line = lines.groupBy("_host", "_line").agg(F.count_distinct("_content").alias("n_documents"))
    hosts = docs.select(F.coalesce(F.col("source"), F.lit("")).alias("_host"), F.xxhash64("text").alias("_content"))
    sizes = hosts.groupBy("_host").agg(F.count_distinct("_content").alias("_n"))
    often = by_line.filter(F.col("n_documents") >= MIN_DOCUMENTS)
    return often.join(sizes, "_host").filter(_shared("n_documents")).select("_host", "_line", "n_documents", "_n")


def _once_a_body(found: DataFrame) -> DataFrame:
    """Lines of documents that are shared -> _host and _line of those that are so with near copies counted once."""
    # By text: a set, for repeated rows have the same lines.
    texts = found.groupBy("_host", "_content").agg(
        F.first("_text_words").alias("_text_words"),
        F.first("_n").alias("_n"),
        F.collect_set(F.struct("line_no", "_line", "_words")).alias("_shared"),
    )
    gone = F.aggregate("_shared", F.lit(0).cast("long"), lambda a, x: a + x["_words"])
    depleted = F.col("_text_words") - gone < MIN_LEFT_SHARE * F.col("_text_words")
    body = F.when(depleted, F.array_min(F.transform("_shared", lambda x: x["_line"]))).otherwise(F.col("_content"))
    lines = F.explode(F.array_distinct(F.transform("_shared", lambda x: x["_line"])))
    counted = texts.select("_host", "_n", body.alias("_body"), lines.alias("_line")).groupBy("_host", "_line")
    bodies = counted.agg(F.count_distinct("_body").alias("_bodies"), F.first("_n").alias("_n"))
    return bodies.filter(_shared("_bodies")).select("_host", "_line")


def removed_lines(docs: DataFrame) -> DataFrame:
    """Per row with shared lines: doc_id, _key, _removed (array of struct line_no, words).

    Texts are cut and hashed once; the lines are stored, and read for the counts and for what is removed.
    """
    lines = stored(_lines(docs), "lines")
    found = stored(lines.join(_above_limits(docs, lines), ["_host", "_line"]), "shared-lines")
    kept = found.join(_once_a_body(found), ["_host", "_line"], "left_semi")
    # A set, for repeated rows have one key.
    return kept.groupBy("doc_id", "_key").agg(F.collect_set(F.struct("line_no", F.col("_words").alias("words"))).alias("_removed"))


def judged(docs: DataFrame, carried: Sequence[str] = ("doc_id",), removed: DataFrame | None = None) -> DataFrame:
    """``measures`` with _removed (line numbers), words_left and kept; ``removed`` is ``removed_lines`` of the same rows."""
    m, r = measures(docs, carried).alias("m"), (removed_lines(docs) if removed is None else removed).alias("r")
    joined = m.join(r, F.expr("m._key = r._key and m._doc.doc_id <=> r.doc_id"), "left")
    gone = F.coalesce(F.aggregate("_removed", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0).cast("long"))
    left = joined.select("m.*", F.transform("_removed", lambda x: x["line_no"]).alias("_removed"), (F.col("n_words") - gone).alias("words_left"))
    kept = ~F.col("base_failed") & (F.col("words_left") >= MIN_LEFT_SHARE * F.col("n_words"))
    return left.withColumn("kept", kept)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with; shared lines are gone from text, and n_chars follows."""
    lines = F.filter(F.split(F.col("_doc.text"), "\n"), lambda line, i: ~F.array_contains(F.col("_removed"), i))
    # What is removed grows with the documents, so it is not broadcast at any size.
    passed = judged(docs, docs.columns, removed_lines(docs).hint("merge")).filter("kept").withColumn(
        "_text", F.when(F.col("_removed").isNull(), F.col("_doc.text")).otherwise(F.array_join(lines, "\n"))
    )
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return passed.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
