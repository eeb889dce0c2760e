"""Quality rules: divergence of character-class and common-word histograms from language references.

Everything is an expression over the document's own row (whole-text SQL functions); only the language
references are aggregated, with partial aggregation, over all documents.

* *base rules*: too few words, or over half of the words in repeated three-word windows;
* *character classes*: six shares of a document's characters against the median share of its
  language (a median is not moved by a minority of junk);
* *common words*: shares of the language's function words and of all other words against the pooled
  shares of the language.

A histogram is judged by its Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).
Guards: short texts, and languages or tables with too few documents for a reference, are not judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffrank.session import ensure_checkpoint_dir

MIN_WORDS = 50            # base rule
MIN_CHARS = 200           # guard of the character test
MIN_COMMON_WORDS = 150    # guard of the common-word test (words in the text)
MIN_REFERENCE = 30        # documents that a language reference needs
MAX_CHAR_DISTANCE = 0.17
MAX_WORD_DISTANCE = 0.28
BROADCAST_LANGUAGES = 8192
_STEPS = 4096             # resolution of the median shares
_SPACE = r"[\x20\x09-\x0D]+"

# Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
_N_COMMON = 16
_LONGEST = max(len(w.encode()) for words in COMMON_WORDS.values() for w in words)
_WORDS = 100  # number of the first common-word bin in the reference counts
_CLASSES = {  # counted by pattern; blanks, and plain letters with digits, are what remains
    "upper": "[A-Z]", "sentence": "[.,;:!?'\"()\\-]",
    "symbol": r"[#*$%&|<>@~^_=+/\\\[\]{}`]", "foreign": r"[^\x00-\x7F]",
}


def _count(pattern: str) -> Column:
    """How many characters of the text a pattern of one character matches: the text falls into one part more."""
    return F.size(F.split("_q_text", pattern, -1)) - 1


def _base(docs: DataFrame) -> DataFrame:
    """Add the columns that both the references and the verdict need."""
    lists = F.create_map(*[x for lang, words in COMMON_WORDS.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.withColumn("_q_text", text).withColumn("_q_lang", F.coalesce(F.col("lang").cast("string"), F.lit("")))
    df = df.withColumns({
        "_q_words": F.filter(F.split("_q_text", _SPACE), lambda w: w != ""),
        "_q_list": F.coalesce(F.element_at(lists, F.col("_q_lang")), F.array().cast("array<string>")),
    })
    counts = {f"_q_{name}": _count(pattern) for name, pattern in _CLASSES.items()}
    df = df.withColumns({"n_words": F.size("_q_words").cast("long"), **counts,
                         "word_chars": F.char_length(F.array_join("_q_words", "")).cast("long"),
                         "_q_length": F.char_length("_q_text")})
    blank = F.col("_q_length") - F.col("word_chars")
    plain = F.col("word_chars") - sum((F.col(f"_q_{name}") for name in _CLASSES), F.lit(0))
    chars = F.array(*[F.col(f"_q_{name}").cast("double") for name in _CLASSES], blank.cast("double"), plain.cast("double"))
    # positions in the word list; with one sentinel of each, sorted, a word's count is a difference of places
    # no longer word is in a list (lower case does not shorten a word to one that is)
    short = F.filter("_q_words", lambda w: F.octet_length(w) <= _LONGEST)
    found = F.filter(F.transform(short, lambda w: F.array_position("_q_list", F.lower(w)).cast("int")), lambda k: k > 0)
    df = df.withColumn("_q_found", F.sort_array(F.concat(found, F.sequence(F.lit(1), F.lit(_N_COMMON + 1)))))
    common = F.transform(F.sequence(F.lit(1), F.lit(_N_COMMON)), lambda k: (
        F.array_position("_q_found", k + 1) - F.array_position("_q_found", k) - 1).cast("double"))
    other = F.array((F.col("n_words") - (F.size("_q_found") - _N_COMMON - 1)).cast("double"))
    return df.withColumns({"_q_chars": chars, "_q_common": F.concat(common, other)})


def references(docs: DataFrame) -> DataFrame:
    """(lang, chars, letters, common): reference shares of each language, and of all together under ''.

    ``chars`` are medians over documents of at least ``MIN_CHARS`` characters, found from counts of
    the shares in steps of 1/4096; ``letters`` are the same with foreign and plain letters as one
    class, for texts of languages without a reference; ``common`` are pooled over documents of at
    least ``MIN_COMMON_WORDS`` words.  A reference needs ``MIN_REFERENCE`` documents.
    """
    df = _base(docs.select("text", "lang")).where(F.col("_q_length") >= MIN_CHARS)
    both = F.array(F.get("_q_chars", len(_CLASSES) - 1) + F.get("_q_chars", len(_CLASSES) + 1))
    steps = F.transform(F.concat("_q_chars", both), lambda n, i: F.struct(
        i.alias("class"), F.floor(n / F.col("_q_length") * _STEPS).cast("int").alias("step"), F.lit(1).cast("long").alias("n")))
    words = F.transform("_q_common", lambda n, k: F.struct((k + _WORDS).alias("class"), F.lit(0).alias("step"), n.cast("long").alias("n")))
    parts = F.when(F.col("n_words") >= MIN_COMMON_WORDS, F.concat(steps, words)).otherwise(steps)
    counts = df.select("_q_lang", F.explode(parts).alias("p")).groupBy("_q_lang", "p.class", "p.step").agg(F.sum("p.n").alias("n")).checkpoint()
    counts = (counts.select(F.explode(F.array_distinct(F.array("_q_lang", F.lit("")))).alias("lang"), "class", "step", "n")
              .groupBy("lang", "class", "step").agg(F.sum("n").alias("n")))
    shares, pooled = counts.where(F.col("class") < _WORDS), counts.where(F.col("class") >= _WORDS)
    # at most 4097 steps a class: a window over (lang, class) sees a bounded number of rows
    totals = shares.groupBy("lang", "class").agg(F.sum("n").alias("docs"))
    ranked = shares.selectExpr("*", "sum(n) OVER (PARTITION BY lang, class ORDER BY step) AS upto")
    medians = (ranked.join(totals, ["lang", "class"]).where((F.col("upto") * 2 >= F.col("docs")) & (F.col("docs") >= MIN_REFERENCE))
               .groupBy("lang", "class").agg(F.min("step").alias("value")))
    in_order = lambda d: d.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("class", "value"))), lambda s: s["value"].cast("double")).alias("v"))
    chars = in_order(medians).select("lang", "v")
    common = in_order(pooled.select("lang", "class", F.col("n").alias("value"))).select("lang", F.col("v").alias("w"))
    return chars.join(common, "lang", "left").select(
        "lang", _normal(F.slice("v", 1, len(_CLASSES) + 2)).alias("chars"), _normal(_one_alphabet(F.col("v"))).alias("letters"), _normal(F.col("w")).alias("common"))


def _one_alphabet(hist: Column) -> Column:
    """Seven values (the classes, then foreign and plain letters together) without the two parts."""
    foreign, plain = len(_CLASSES) - 1, len(_CLASSES) + 1
    return F.filter(hist, lambda x, i: (i != foreign) & (i != plain))


def _normal(hist: Column) -> Column:
    total = F.aggregate(hist, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(hist, lambda x: x / total))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays: sqrt of the divergence with logarithms to base 2."""
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def _repeated_words() -> Column:
    """Words covered by three-word windows that the text holds twice or more.

    Each window becomes one number: the leading bits of its hash, then its place.  Sorted, equal
    windows are neighbours; neighbours are compared word by word, so that a hash cannot merge two.
    """
    w, n = F.col("_q_words"), F.col("n_words").cast("int")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    packed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: window(i).bitwiseAND(-F.col("_q_places")).bitwiseOR(i.cast("long")))
    return F.when(n >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>"))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` (text, lang, any other columns) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance (null: not judged) and kept.

    Columns of these names in ``docs`` are replaced.  Defined cases: a null or empty text has no
    words and fails the base rules; an unknown or null language is judged by the characters of all
    documents together, alphabets aside; equal rows get equal verdicts; an empty table gives an empty table; without
    enough documents for a reference only the base rules decide.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.drop(*names)
    # other columns travel in a struct, so that no name of theirs can clash
    given = docs.columns
    docs = docs.select("text", "lang", F.struct(F.col("lang"), *[F.col(f"`{c}`") for c in given if c not in ("text", "lang")]).alias("other"))
    refs = references(docs).checkpoint()
    overall = refs.where("lang = ''").select("letters").first()
    letters = F.array(*map(F.lit, overall[0])) if overall else F.lit(None).cast("array<double>")
    refs = refs.where("lang <> ''").select(F.col("lang").alias("_q_ref"), F.col("chars").alias("_q_ref_chars"), F.col("common").alias("_q_ref_common"))
    if refs.count() <= BROADCAST_LANGUAGES:  # one short row per language
        refs = F.broadcast(refs)
    df = _base(docs)
    lines = F.filter(F.split("_q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({
        "n_symbols": _count("[#*$%&|<>]").cast("long"),
        "_q_lines": lines,
        "_q_places": F.expr("shiftleft(1L, length(bin(n_words)))"),
    }).withColumn("_q_packed", _repeated_words())
    place = lambda x: x.bitwiseAND(F.col("_q_places") - 1).cast("int")
    same = lambda a, b: (F.get("_q_words", a) == F.get("_q_words", b)) & (F.get("_q_words", a + 1) == F.get("_q_words", b + 1)) & (F.get("_q_words", a + 2) == F.get("_q_words", b + 2))
    high = lambda x: x.bitwiseAND(-F.col("_q_places"))
    twin = lambda x, i: (high(x) == high(F.get("_q_packed", i))) & same(place(x), place(F.get("_q_packed", i)))
    repeated = F.filter("_q_packed", lambda x, i: F.coalesce(F.when(i > 0, twin(x, i - 1)), F.lit(False)) | F.coalesce(twin(x, i + 1), F.lit(False)))
    df = df.withColumn("_q_starts", F.sort_array(F.transform(repeated, place)))
    covered = F.aggregate(
        F.col("_q_starts"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + x + 3 - F.greatest(s["end"], x)).alias("n"), (x + 3).alias("end")), lambda s: s["n"])
    # the id keeps later filters on these columns above their projection; below it, the optimizer
    # would copy the whole-text expressions into the filter, once for each place that uses them
    once = F.monotonically_increasing_id() >= 0
    df = df.withColumns({
        "n_dup_lines": F.when(once, F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_repeat_words": F.when(once, covered),
    }).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    df = df.join(refs, F.col("_q_lang") == F.col("_q_ref"), "left")
    both = F.array(F.get("_q_chars", len(_CLASSES) - 1) + F.get("_q_chars", len(_CLASSES) + 1))
    char = F.when(F.col("_q_length") >= MIN_CHARS, F.when(F.col("_q_ref_chars").isNotNull(), js_distance(_normal(F.col("_q_chars")), F.col("_q_ref_chars")))
                  .otherwise(js_distance(_normal(_one_alphabet(F.concat("_q_chars", both))), letters)))
    word = F.when((F.col("n_words") >= MIN_COMMON_WORDS) & (F.size("_q_list") > 0), js_distance(_normal(F.col("_q_common")), F.col("_q_ref_common")))
    df = df.withColumns({"char_distance": F.when(once, char), "word_distance": F.when(once, word)})
    far = F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False))
    df = df.withColumn("kept", ~F.col("base_failed") & ~far & once)
    return df.select(*[F.col(c) if c in ("text", "lang") else F.col("other").getField(c).alias(c) for c in given], *names)
