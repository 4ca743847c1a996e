"""Quality rules by distribution divergence, in DataFrame expressions only.

Two histograms are taken of each whole text: character classes, and common words (a fixed list of frequent
function words; every other word is one more bin).  They are compared with references, the same histograms
summed over each language's well-formed documents, by Jensen-Shannon distance (base 2, 0 to 1).  The nearest
reference by the sum of both distances counts, so a missing or wrong language label does no harm, and a language needs
a number of documents and words to be a reference, so a few rows of a rare label make none.  A text goes if its
classes are too far off, if both histograms are off, or, for long texts, if its common words alone are.  Short texts
have noisy histograms, so each comparison has a minimum length; a text below it passes that comparison.

Base rules: a text fails with under 50 words, or if over half of its words stand in 3-word windows that
occur twice or more in it.  Windows are compared by a 64-bit hash.

A null text counts as empty: no words, ``base_failed``.  Repeated rows are judged alike, row by row.  An
empty table gives no rows.  If no document is fit for a reference, only the base rules judge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS = 200               # word characters from which the histograms are compared
MIN_WORDS_IN_REFERENCE = 100  # words from which a document counts for its language's reference
MAX_CLASS_DISTANCE = 0.28     # character classes alone
BOTH_CLASS_DISTANCE = 0.17    # character classes and common words both far off
BOTH_COMMON_DISTANCE = 0.27
MIN_WORDS_FOR_COMMON = 80     # words from which the common words are compared
# Common words alone, for long texts: from so many words on, the distance that is too far.
COMMON_ALONE = ((300, 0.31), (800, 0.25))
# What a language must have to be a reference: documents that are fit for it, and words in them.
MIN_REFERENCE_DOCS, MIN_REFERENCE_WORDS = 10, 2000

# Frequent function words of English, French, German and Spanish.
COMMON_WORDS = {
    "en": "the of and to in is that for it with as on by at are was this",
    "fr": "de la le et les des en un une du que est pour qui dans par sur",
    "de": "der die und in den von zu das mit sich des auf für ist im ein",
    "es": "de la que el en y a los se del las un por con una su para es",
}
COMMON = sorted({w for words in COMMON_WORDS.values() for w in words.split()})

SPACE = r"[\x20\x09-\x0D]+"
# Character classes after blanks and lower-case a-z, each counted in what the ones before it left over; the
# rest is one more class.
CLASSES = [("space", SPACE), ("upper", "[A-Z]+"), ("mark", r"[.,;:!?'\"()-]+"), ("digit", "[0-9]+"), ("letter", r"[\p{L}\p{M}]+")]
N_CLASSES = len(CLASSES) + 2
SYMBOLS = r"[#*$%&|<>]+"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _length(c: str) -> Column:
    return F.char_length(F.col(c)).cast("long")


def measure(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``_row`` (``keep``, by default all columns, of ``docs``), ``_lang`` and ``_q``: the five base figures and
    both histograms."""
    kept = ["_row", "_lang"]
    d = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("_row"), docs["lang"].alias("_lang"),
                    F.coalesce(docs["text"], F.lit("")).alias("_t"))
    # character classes: each step removes one class, the difference in length is its count
    blanks = (F.octet_length("_t") - F.octet_length(F.replace("_t", F.lit(" "), F.lit("")))).cast("long")
    d = d.withColumn("_r0", F.regexp_replace("_t", "[a-z ]+", ""))
    for i, (_, pattern) in enumerate(CLASSES, 1):
        d = d.withColumn(f"_r{i}", F.regexp_replace(f"_r{i - 1}", pattern, ""))
    sizes = [_length(f"_r{i}") for i in range(len(CLASSES) + 1)]
    counts = [x - y for x, y in zip(sizes, sizes[1:])] + [sizes[-1]]
    last = f"_r{len(CLASSES)}"
    d = d.select(*kept, "_t", blanks.alias("_blanks"), _length("_t").alias("_chars"), sizes[0].alias("_left"),
                 F.array(*counts).alias("_rest"),
                 (sizes[-1] - F.char_length(F.regexp_replace(last, SYMBOLS, ""))).cast("long").alias("_symbols"),
                 F.filter(F.split("_t", SPACE), lambda w: w != "").alias("_w"),
                 F.filter(F.split("_t", "\n"), lambda line: F.regexp_replace(line, SPACE, "") != "").alias("_lines"))
    space = F.col("_blanks") + F.get("_rest", F.lit(0))
    classes = F.concat(F.array(F.col("_chars") - F.col("_left") - F.col("_blanks"), space), F.slice("_rest", 2, N_CLASSES))
    # the listed words as one string of <word> marks: removing a mark tells how often it stood there
    marks = F.transform(F.filter("_w", lambda w: w.isin(*COMMON)), lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    d = d.select(*kept, "_w", "_lines", "_symbols", classes.alias("_classes"), (F.col("_chars") - space).alias("_word_chars"),
                 F.size("_w").cast("long").alias("_n"), F.array_join(marks, "").alias("_marks"))
    d = d.withColumn("_common", F.array(*[
        ((F.octet_length("_marks") - F.octet_length(F.replace("_marks", F.lit(f"<{w}>"), F.lit("")))) / len(f"<{w}>".encode())).cast("long")
        for w in COMMON]))
    # windows that occur again, by sorting (hash, place) pairs; texts whose windows all differ skip the sort
    d = d.withColumn("_h", F.when(F.col("_n") >= 3, F.transform(F.sequence(F.lit(0), (F.col("_n") - 3).cast("int")),
                                  lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))))
                     .otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.array().cast("array<struct<h:bigint,i:int>>"))
                     .otherwise(F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_s", lambda x, j: (F.get("_s", j - 1)["h"].eqNullSafe(x["h"])) | (F.get("_s", j + 1)["h"].eqNullSafe(x["h"])))
    d = d.withColumn("_p", F.array_sort(F.transform(again, lambda x: x["i"])))
    # a window covers three words, fewer if the next repeated window starts earlier
    repeat = F.aggregate(F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3)))),
                         F.lit(0), lambda a, b: a + b).cast("long")
    words_listed = F.aggregate("_common", F.lit(0).cast("long"), lambda a, b: a + b)
    return d.select(*kept, F.struct(
        F.col("_n").alias("n_words"), F.col("_word_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"), F.col("_classes").alias("classes"),
        F.concat("_common", F.array(F.col("_n") - words_listed)).alias("common")).alias("_q"))


def references(measured: DataFrame) -> DataFrame:
    """One row: an array of the languages' reference histograms (as shares).

    Sums of counts over each language's documents with enough words and few symbols; one row per bin and
    language leaves the aggregation.  The number of languages is the number of labels, not of documents.
    """
    fit = measured.where(F.col("_lang").isNotNull() & (F.col("_q.n_words") >= MIN_WORDS_IN_REFERENCE)
                         & (10 * F.col("_q.n_symbols") < F.col("_q.word_chars")))
    size = F.array(F.lit(1).cast("long"), F.col("_q.n_words"))
    bins = fit.select(F.col("_lang").alias("lang"), F.posexplode(F.concat(size, "_q.classes", "_q.common"))) \
        .groupBy("lang", "pos").agg(F.sum("col").alias("n"))
    rows = bins.groupBy("lang").agg(F.expr("transform(sort_array(collect_list(struct(pos, n))), x -> x.n)").alias("n")) \
        .where((F.get("n", F.lit(0)) >= MIN_REFERENCE_DOCS) & (F.get("n", F.lit(1)) >= MIN_REFERENCE_WORDS)) \
        .withColumn("n", F.slice("n", 3, N_CLASSES + len(COMMON) + 1)) \
        .select("lang", _shares(F.slice("n", 1, N_CLASSES)).alias("classes"),
                _shares(F.slice("n", N_CLASSES + 1, len(COMMON) + 1)).alias("common"))
    rows = rows.withColumn("classes_terms", _entropy_terms(F.col("classes"))) \
        .withColumn("common_terms", _entropy_terms(F.col("common")))
    return rows.agg(F.sort_array(F.collect_list(F.struct("lang", "classes", "common", "classes_terms", "common_terms"))).alias("_refs"))


def _shares(counts: Column) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(1).cast("long"))
    return F.transform(counts, lambda n: n / total)


def _entropy_terms(shares: Column) -> Column:
    """Sum of x log2 x; the tiny addend makes the term of 0 be 0."""
    return F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x * F.log2(x + 1e-300))


def js_distance(p: Column, q: Column, p_terms: Column, q_terms: Column) -> Column:
    """Jensen-Shannon distance of two share arrays: 0 for equal ones, 1 for disjoint ones.

    With f(x) = x log2 x the divergence is 1 + (sum f(p) + sum f(q) - sum f(p + q)) / 2.
    """
    divergence = 1 + (p_terms + q_terms - _entropy_terms(F.zip_with(p, q, lambda a, b: a + b))) / 2
    return F.sqrt(F.least(F.greatest(divergence, F.lit(0.0)), F.lit(1.0)))


def _once(value: Column) -> Column:
    """A value as a row of its own, so that the optimizer does not write it out again wherever it is used."""
    return F.explode(F.array(value))


def judge(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """Adds the struct ``_verdict`` (base_failed, class_distance, common_distance, kept) to measured rows."""
    cols = measured.columns
    d = measured.join(F.broadcast(refs))  # one row
    d = d.withColumn("_pc", _once(_shares(F.col("_q.classes")))).withColumn("_pw", _once(_shares(F.col("_q.common"))))
    d = d.withColumn("_fc", _entropy_terms(F.col("_pc"))).withColumn("_fw", _entropy_terms(F.col("_pw")))

    def to(r: Column) -> Column:
        classes = js_distance(F.col("_pc"), r["classes"], F.col("_fc"), r["classes_terms"])
        common = js_distance(F.col("_pw"), r["common"], F.col("_fw"), r["common_terms"])
        return F.struct((classes + common).alias("both"), classes.alias("classes"), common.alias("common"))
    d = d.withColumn("_near", _once(F.array_min(F.transform("_refs", to))))
    d = d.withColumn("_dc", F.col("_near.classes")).withColumn("_dw", F.col("_near.common"))
    base = (F.col("_q.n_words") < MIN_WORDS) | \
        (100 * F.col("_q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q.n_words"))
    long_enough = (F.col("_q.word_chars") >= MIN_CHARS) & (F.col("_q.n_words") >= MIN_WORDS)
    bad = long_enough & ((F.col("_dc") > MAX_CLASS_DISTANCE)
                         | (F.col("_q.n_words") >= MIN_WORDS_FOR_COMMON) & (F.col("_dc") > BOTH_CLASS_DISTANCE) & (F.col("_dw") > BOTH_COMMON_DISTANCE))
    for words, distance in COMMON_ALONE:
        bad = bad | long_enough & (F.col("_q.n_words") >= words) & (F.col("_dw") > distance)
    bad = F.coalesce(bad, F.lit(False))
    return d.select(*cols, F.struct(base.alias("base_failed"), F.col("_dc").alias("class_distance"),
                                    F.col("_dw").alias("common_distance"), (~base & ~bad).alias("kept")).alias("_verdict"))


def apply_rules(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang and any others): ``_row`` (``keep``, by default all columns),
    ``_q`` and ``_verdict``.

    The measures are taken once and written to the shared checkpoint folder; the references and the
    verdicts both read them from there.
    """
    measured = cut_lineage(measure(docs, keep), "quality")
    return judge(measured, references(measured))
