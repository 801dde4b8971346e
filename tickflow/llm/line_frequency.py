"""Quality rules: line frequency across documents, after a base check of each text alone.

Everything is made of Spark's own expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import SPACE_CHARACTERS, WORD, fresh, held, named, stored, texts

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line is too frequent on its host if more documents than both hold it: so many, and so many percent of the host's.
MIN_DOCUMENTS = 20
MAX_DOCUMENT_PERCENT = 1
#: A document without its too frequent lines is depleted below so many words, or so many percent of its words.
MIN_LEFT_WORDS = 20
MIN_LEFT_PERCENT = 30


def _one_spaced(text: Column) -> Column:
    """In lower case, with every run of spaces inside a line as one space; single spaces are left alone."""
    return F.regexp_replace(F.lower(text), r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " ")


def normalised_lines(text: Column) -> Column:
    """Lines with a word, in lower case, with single spaces between words."""
    lines = F.transform(F.split(_one_spaced(text), "\n"), lambda line: F.btrim(line, F.lit(" ")))
    return F.filter(lines, lambda line: line != "")


def line_hash(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _window_hashes(words: Column, n_words: Column) -> Column:
    hashes = F.transform(
        F.sequence(F.lit(0), n_words - 3), lambda at: F.xxhash64(words[at], words[at + 1], words[at + 2])
    )
    return F.when(n_words >= 3, hashes)


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """``rows`` (with words and n_words) with n_repeat_words: words in windows of three words that the text holds twice
    or more.

    Windows are sorted by hash with their positions; neighbours of equal hash and equal words give the positions of all
    repeated windows, and each position covers three words or as many as there are up to the next one. Texts whose
    window hashes all differ have nothing to sort.
    """
    rest, words = 2**30, F.col("words")
    rows = held(rows, hashes=_window_hashes(words, F.col("n_words")))
    placed = F.transform("hashes", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    repeating = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = held(rows, ordered=F.when(repeating, F.sort_array(placed)))

    def pair(a: Column, b: Column) -> Column:
        equal = a["h"] == b["h"]
        for k in range(3):
            equal = equal & (words[a["at"] + k] == words[b["at"] + k])
        return F.when(equal, F.array(a["at"], b["at"]))

    pairs = F.zip_with("ordered", F.slice("ordered", 2, rest), pair)
    positions = F.flatten(F.filter(pairs, lambda found: found.isNotNull()))
    rows = held(rows, repeated=F.sort_array(F.array_distinct(positions)))
    covered = F.zip_with(
        "repeated", F.slice("repeated", 2, rest), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0), lambda so_far, n: so_far + n)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0))).drop("hashes", "ordered", "repeated")


def base_signals(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARACTERS)) != "")
    rows = held(rows, words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lines=lines)
    rows = rows.withColumns(
        {
            "n_words": F.size("words"),
            "word_chars": F.length(F.array_join("words", "")),
            "n_symbols": F.size(F.regexp_extract_all("text", F.lit(SYMBOLS), F.lit(0))),
            "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        }
    )
    rows = _with_repeat_words(rows).drop("words", "lines")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = rows.withColumns({name: F.col(name).cast("long") for name in counts})
    repetitive = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repetitive)


def line_rows(docs: DataFrame) -> DataFrame:
    """A row per line with a word: doc_id, text_id, host, line_hash, line_words."""
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_id"), "host", F.explode(normalised_lines(F.col("text"))).alias("line")
    )
    line_words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return rows.select("doc_id", "text_id", "host", line_hash(F.col("line")).alias("line_hash"), line_words.alias("line_words"))


def frequent_lines(
    docs: DataFrame, lines: DataFrame, min_documents: int = MIN_DOCUMENTS, max_percent: float = MAX_DOCUMENT_PERCENT
) -> DataFrame:
    """host, line_hash, n_documents of the lines above the limits, for ``docs`` of doc_id, text, host and their lines.

    Counted are the distinct documents of a host that hold a line. Equal texts are one document in both counts: copies
    are for deduplication to remove and make no line frequent. Distinct (host, line, text) are formed in each task and
    again after a shuffle by all three, so that a line of half the documents is spread over its texts.
    """
    seen = lines.select("host", "line_hash", "text_id").distinct()
    counts = seen.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n_documents"))
    counts = counts.filter(F.col("n_documents") > min_documents)
    hosts = docs.select("host", F.xxhash64("text").alias("text_id")).distinct()
    hosts = hosts.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    above = counts.join(hosts, counts.host.eqNullSafe(hosts.host)).drop(hosts.host)
    return above.filter(100 * F.col("n_documents") > max_percent * F.col("host_documents")).drop("host_documents")


def line_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_percent: float = MAX_DOCUMENT_PERCENT,
    min_left_words: int = MIN_LEFT_WORDS,
    min_left_percent: float = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Each document with base signals, left_words (words outside too frequent lines), base_failed and kept.

    A document is kept if it does not fail the base check and is not depleted. NULL texts count as empty, fail the
    base check and have no lines; NULL hosts are one host; a NULL id is an id like others. Repeated rows are returned
    as often as they come, with the same verdict. An empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col, host=host_col)
    verdict = _judged(rows, min_documents, max_percent, min_left_words, min_left_percent)
    return verdict.drop("text_id", "removed")


def keep_good_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits: float
) -> DataFrame:
    """The documents that :func:`line_verdicts` keeps, without their too frequent lines, with all their columns;
    ``n_chars``, if there, counts anew. Texts without such a line stay as they are, to the byte."""
    rows = texts(docs, id_col, text_col, host=host_col)
    given = {"min_documents": MIN_DOCUMENTS, "max_percent": MAX_DOCUMENT_PERCENT}
    given |= {"min_left_words": MIN_LEFT_WORDS, "min_left_percent": MIN_LEFT_PERCENT}
    own = ["doc_id", "host", "text_id", "removed"]
    judged = dict(zip(own, fresh(docs, "judged_id", "judged_host", "judged_text", "judged_lines")))
    judged_id, judged_host, judged_text, judged_lines = map(F.col, judged.values())
    # Written first: a filter on a verdict would be formed from the text anew, with every step many times over.
    verdict = stored(_judged(rows, **(given | limits)).select("kept", *own))
    kept = verdict.filter("kept").dropDuplicates(own[:3]).withColumnsRenamed(judged).drop("kept")
    text = F.coalesce(named(text_col), F.lit(""))
    same = (
        named(id_col).eqNullSafe(judged_id) & named(host_col).eqNullSafe(judged_host) & (F.xxhash64(text) == judged_text)
    )

    def stays(line: Column) -> Column:
        return ~F.array_contains(judged_lines, line_hash(F.btrim(_one_spaced(line), F.lit(" "))))

    without = F.array_join(F.filter(F.split(text, "\n"), stays), "\n")
    left = F.when(judged_lines.isNull(), named(text_col)).otherwise(without)
    new = {text_col: left}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(left).cast(docs.schema["n_chars"].dataType)
    columns = [new.get(c, named(c)).alias(c) for c in docs.columns]
    return docs.join(kept, same).select(columns)


def _judged(
    rows: DataFrame, min_documents: int, max_percent: float, min_left_words: int, min_left_percent: float
) -> DataFrame:
    signals = base_signals(rows).withColumn("text_id", F.xxhash64("text")).drop("text")
    removed = _removed(rows, min_documents, max_percent)
    # Repeated rows count alike in both sums, so their quotient is the document's own.
    removed_words = F.floor(F.col("removed_words") * F.col("n_words") / F.col("all_words")).cast("long")
    same = (
        signals.doc_id.eqNullSafe(removed.doc_id)
        & signals.host.eqNullSafe(removed.host)
        & (signals.text_id == removed.text_id)
    )
    joined = signals.join(removed, same, "left").select(signals["*"], "removed_words", "all_words", "removed")
    joined = joined.withColumn("left_words", F.col("n_words") - F.coalesce(removed_words, F.lit(0)))
    depleted = (F.col("left_words") < min_left_words) | (100 * F.col("left_words") < min_left_percent * F.col("n_words"))
    verdict = joined.withColumn("kept", ~F.col("base_failed") & ~depleted)
    return verdict.drop("removed_words", "all_words")


def _removed(rows: DataFrame, min_documents: int, max_percent: float) -> DataFrame:
    """Documents with too frequent lines: doc_id, host, text_id, removed_words, all_words, removed (line hashes)."""
    lines = stored(line_rows(rows))
    frequent = frequent_lines(rows, lines, min_documents, max_percent)
    frequent = frequent.select(F.col("host").alias("frequent_host"), F.col("line_hash").alias("frequent_hash"))
    found = F.col("host").eqNullSafe(F.col("frequent_host")) & (F.col("line_hash") == F.col("frequent_hash"))
    lines = lines.join(frequent, found, "left")
    hit = F.col("frequent_hash").isNotNull()
    sums = lines.groupBy("doc_id", "host", "text_id").agg(
        F.sum("line_words").alias("all_words"),
        F.sum(F.when(hit, F.col("line_words"))).alias("removed_words"),
        F.collect_set("frequent_hash").alias("removed"),
    )
    return sums.filter("removed_words > 0")
