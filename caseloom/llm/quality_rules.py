"""Quality rules: simple counts, and how far a text's histograms are from those of its language.

Two histograms per document: character classes, and common words of its language (with one bin for all other words).  The
character reference of a language is the median share of each class over all its documents that pass the base rules, so junk
does not shift it while it is less than half; the word reference is the mean share of each word over those that also keep
to the character reference (words are rare events, whose medians would be 0).  A document fails when the Jensen-Shannon distance (root of the divergence in bits, 0
to 1) of either histogram to the reference is over its limit.  Short texts make noisy histograms, so each comparison has a
minimum length below which it does not judge.

Everything is built-in SQL functions over one row at a time; the references are a few dozen numbers per language.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import stored

# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on are as with be by this from or an at have not".split(),
    "fr": "le la les de des du et un une en à est que qui dans pour par sur au ce il elle ne".split(),
    "de": "der die das und ein eine in zu den von mit ist des für auf dem nicht im sich als auch es an".split(),
    "es": "el la los las de del y un una en que es por con para se su al lo no como más o".split(),
}
BINS = 24  # 23 common words and the rest
CHAR_CLASSES = ("lower", "space", "upper", "digit", "stop", "other")
EVERY = "*"  # the reference for languages without a list

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# (least, by root): a limit is least + by root / sqrt(length), as the distance of a sample falls with its root
CHAR_MIN_CHARS, CHAR_LIMIT = 200, (0.12, 3.0)
WORD_MIN_WORDS, WORD_LIMIT = 100, (0.14, 1.4)

_WHITE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words: words covered by a 3-word window whose words occur twice or more in the text."""
    # steps of their own: a column that a lambda reads must be computed before it, not once per element
    df = df.withColumn(
        "_grams",
        F.when(
            F.size("_words") >= 3,
            F.transform(
                F.slice("_words", F.lit(1), F.size("_words") - 2),
                lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ),
    )
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    df = df.withColumn("_sorted", F.when(repeated, F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    equal = lambda e, k: F.coalesce(F.get("_sorted", k)["g"] == e["g"], F.lit(False))
    places = F.filter("_sorted", lambda e, k: equal(e, k - 1) | equal(e, k + 1))
    df = df.withColumn("_places", F.sort_array(F.transform(places, lambda e: e["i"])))
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")),
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, and the two histograms as arrays of counts."""
    docs = documents.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("_text"))
    docs = docs.withColumn("_words", F.filter(F.split("_text", _WHITE), lambda w: w != ""))
    docs = docs.withColumn("_r1", F.regexp_replace("_text", r"\p{Ll}+", ""))  # what is left shrinks from step to step
    docs = docs.withColumn("_r2", F.regexp_replace("_r1", _WHITE, ""))
    docs = docs.withColumn("_r3", F.regexp_replace("_r2", r"\p{L}+", ""))
    docs = docs.withColumn("_r4", F.regexp_replace("_r3", r"\p{Nd}+", ""))
    docs = docs.withColumn("_r5", F.regexp_replace("_r4", r"[.,;:!?'\"()-]+", ""))
    sizes = [F.length(c) for c in ("_text", "_r1", "_r2", "_r3", "_r4", "_r5")]
    classes = F.array(*[(a - b).cast("double") for a, b in zip(sizes, sizes[1:])], sizes[-1].cast("double"))

    lists = {k: F.array(*map(F.lit, words)) for k, words in COMMON_WORDS.items()}
    own_list = reduce(lambda c, k: c.when(F.col("lang") == k, lists[k]), lists, F.when(F.lit(False), lists["en"]))
    docs = docs.withColumn("_list", own_list).withColumn("_tokens", F.when(F.col("_list").isNotNull(), F.split(F.lower("_text"), r"[^\p{L}]+")))
    docs = docs.withColumn("_tokens", F.filter("_tokens", lambda w: w != ""))
    docs = docs.withColumn("_hits", F.filter(F.transform("_tokens", lambda w: F.array_position("_list", w)), lambda i: i > 0))

    def hits_of(place: int) -> Column:
        return F.size(F.filter("_hits", lambda i: i == place)).cast("double")

    hits = [hits_of(k) for k in range(1, BINS)]
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn("_lines", lines)
    docs = _repeat_words(docs)
    return docs.select(
        "doc_id",
        "lang",
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - F.length("_r1") + F.length("_r2")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        classes.alias("classes"),
        F.length("_text").alias("chars"),
        F.when(F.col("_list").isNotNull(), F.array(*hits, (F.size("_tokens") - F.size("_hits")).cast("double"))).alias("common"),
        F.size("_tokens").alias("tokens"),
    )


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1.0)))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of shares, base 2."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _limit(length: str, limit: tuple[float, float]) -> Column:
    return limit[0] + limit[1] / F.sqrt(F.greatest(F.col(length), F.lit(1)).cast("double"))


def _languages() -> Column:
    """A document counts for the reference of its own language, if that has a word list, and for the one over all."""
    own = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang"))
    return F.explode(F.array_compact(F.array(own, F.lit(EVERY))))


def class_references(rows: DataFrame) -> DataFrame:
    """key, ref_classes: median shares.  At most one row per word list and one more, whatever ``lang`` holds."""
    medians = [F.coalesce(F.percentile_approx(F.get("class_shares", F.lit(i)), 0.5, 1000), F.lit(0.0)) for i in range(len(CHAR_CLASSES))]
    found = rows.withColumn("key", _languages()).groupBy("key").agg(F.array(*medians).alias("medians"))
    return found.select("key", _shares("medians").alias("ref_classes"))


def word_references(rows: DataFrame) -> DataFrame:
    """key, ref_common: mean shares, one row per word list at most."""
    means = [F.avg(F.get("common_shares", F.lit(i))) for i in range(BINS)]
    known = rows.where(F.col("lang").isin(*COMMON_WORDS))
    return known.groupBy(F.col("lang").alias("key")).agg(F.array(*means).alias("ref_common"))


def judged(documents: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every row.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, then char_distance and
    word_distance (NULL where not judged).  Words are ``[^\\x20\\x09-\\x0D]+``; a NULL or empty text has none and fails.  A NULL or
    unknown language is compared by character classes with the reference over all documents, and not by words.  Rows are
    judged one by one, so NULL ids, repeated rows and further columns (left out) change nothing; an empty table gives no rows.
    """
    rows = stored(measured(documents), "measured")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    rows = rows.withColumn("class_shares", _shares("classes")).withColumn("common_shares", _shares("common"))
    rows = rows.withColumn("key", F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(EVERY))
    # both reference tables have one row per word list and one more: a broadcast of fixed size
    rows = rows.join(F.broadcast(class_references(rows.where("not base_failed"))), "key", "left")
    by_class = F.when((F.col("chars") >= CHAR_MIN_CHARS) & F.col("ref_classes").isNotNull(), distance("class_shares", "ref_classes"))
    rows = rows.withColumn("char_distance", by_class)
    strange = F.coalesce(F.col("char_distance") > _limit("chars", CHAR_LIMIT), F.lit(False))
    near = rows.where(~F.col("base_failed") & ~strange)
    rows = rows.join(F.broadcast(word_references(near)), "key", "left")
    by_word = F.when((F.col("tokens") >= WORD_MIN_WORDS) & F.col("ref_common").isNotNull(), distance("common_shares", "ref_common"))
    rows = rows.withColumn("word_distance", by_word)
    far = strange | F.coalesce(F.col("word_distance") > _limit("tokens", WORD_LIMIT), F.lit(False))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance",
    )
