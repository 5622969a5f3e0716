"""Quality rules: a threshold table compiled into one projection, SQL functions only.

``MEASURES`` derives numbers from the words and lines of a text, ``RULES`` is a
table of (name, measure, lower bound, upper bound); ``compile_rules`` turns it
into one column per rule and one verdict. Everything is a column expression.

Words are runs of characters other than space and \\t..\\r. The base counts
(fixed definitions): code points in words, symbols ``#*$%&|<>``, lines with a
word equal to an earlier line, and words that lie in an 8-word window found
twice or more. The last one compares 64-bit hashes of windows within a text.

The bounds are wide: they are meant to drop texts that hardly contain prose
(symbols behind every word, tables, shouting, one line or word again and again)
and to keep any ordinary text, also short of stop words. The stop words are
those of a few languages, so their rule judges only texts in the letters of
these languages: a text with one letter in a hundred beyond them (Cyrillic,
Greek, Han, Polish or Turkish letters) passes it. A text of another language
that is written without such letters is judged by the rule.

Defined cases: null text has no words and fails; ids may be null or repeated;
other columns of the input are ignored; a rule whose denominator is 0 passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents

NOT_WORD = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NOT_LETTER = r"[^\p{L}]+"
NOT_UPPER = r"[^\p{Lu}]+"
REPEAT_WINDOW = 8

# Frequent function words of the four languages of the tables.
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "with",
              "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im",
              "le", "la", "les", "de", "des", "et", "en", "un", "une", "du",
              "el", "los", "las", "que", "y", "es", "por", "con", "del", "se")

# Letters of the languages of the stop words.
ALPHABET = "A-Za-zÀ-ÂÄÆ-ÏÑÓÔÖÙ-ÜßŒà-âäæ-ïñóôöù-üÿœ"
NOT_FOREIGN = rf"[\P{{L}}{ALPHABET}]+"

# (rule, measure, lower bound, upper bound); None: no bound. Ratios are per word,
# per line or per character as the measure says.
RULES = (
    ("n_words", "n_words", 20, None),
    ("word_length", "mean_word_chars", 2.0, 15.0),
    ("symbols", "symbols_per_word", None, 0.25),
    ("letters", "letter_share", 0.5, None),
    ("capitals", "capital_share", None, 0.6),
    ("stop_words", "stop_word_share", 0.01, None),
    ("duplicate_lines", "dup_line_share", None, 0.5),
    ("repeats", "repeat_share", None, 0.3),
    ("stutter", "stutter_share", None, 0.25),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


MEASURES = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: _ratio(F.col("word_chars"), F.col("n_words")),
    "symbols_per_word": lambda: _ratio(F.col("n_symbols"), F.col("n_words")),
    "letter_share": lambda: _ratio(F.col("n_letters"), F.col("word_chars")),
    "capital_share": lambda: _ratio(F.col("n_capitals"), F.col("n_letters")),
    # null, so no verdict, where the letters are not those of the list
    "stop_word_share": lambda: F.when(100 * F.col("n_foreign") <= F.col("n_letters"),
                                      _ratio(F.col("n_stop_words"), F.col("n_words"))),
    "dup_line_share": lambda: _ratio(F.col("n_dup_lines"), F.col("n_lines")),
    "repeat_share": lambda: _ratio(F.col("n_repeat_words"), F.col("n_words")),
    "stutter_share": lambda: _ratio(F.col("n_stutters"), F.col("n_words")),
}


def compile_rules(rules=RULES) -> tuple[list[Column], Column]:
    """One boolean column per rule (``ok_<name>``) and their conjunction."""
    oks, verdict = [], F.lit(True)
    for name, measure, low, high in rules:
        value = MEASURES[measure]()
        ok = F.lit(True)
        if low is not None:
            ok = ok & (value >= low)
        if high is not None:
            ok = ok & (value <= high)
        ok = F.coalesce(ok, F.lit(True))
        oks.append(ok.alias(f"ok_{name}"))
        verdict = verdict & ok
    return oks, verdict


def _left(text: Column, drop: str) -> Column:
    """Code points left when runs of ``drop`` are taken out."""
    return F.char_length(F.regexp_replace(text, drop, ""))


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and all counts the rules use."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = df.select(F.col(id_col).alias("doc_id"), t.alias("t"))
    d = d.select("doc_id", "t", F.filter(F.split("t", NOT_WORD), lambda w: w != "").alias("ws"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    k = REPEAT_WINDOW
    window = lambda i: F.xxhash64(*[F.get("ws", i + j) for j in range(k)])
    d = d.withColumn("hashes", F.when(F.size("ws") >= k, F.transform(F.sequence(F.lit(0), F.size("ws") - k), window))
                     .otherwise(F.array().cast("array<bigint>")))
    # Only texts with an equal pair of windows go on: their (hash, position)
    # pairs are sorted, so equal windows are neighbours, and the positions of
    # those, sorted, give the length of the union of the windows.
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    d = d.withColumn("pairs", F.when(some, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: F.coalesce(F.get("pairs", i)["h"] == x["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter("pairs", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")), lambda a, i: F.struct(
        (i + k).alias("end"), (a["sum"] + k - F.greatest(F.lit(0), a["end"] - i)).alias("sum")), lambda a: a["sum"])
    return d.select(
        "doc_id", F.size("ws").cast("long").alias("n_words"),
        F.char_length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        _left(F.col("t"), NOT_SYMBOL).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _left(F.col("t"), NOT_LETTER).cast("long").alias("n_letters"),
        _left(F.col("t"), NOT_UPPER).cast("long").alias("n_capitals"),
        _left(F.col("t"), NOT_FOREIGN).cast("long").alias("n_foreign"),
        F.size(F.filter("ws", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        # words equal to the word before
        F.size(F.filter("ws", lambda w, i: F.coalesce(F.get("ws", i - 1) == w, F.lit(False)))).cast("long").alias("n_stutters"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality(df: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, one ``ok_`` column per rule, base_failed and kept."""
    oks, verdict = compile_rules(rules)
    return measures(df, id_col, text_col).select("*", *oks, base_failed().alias("base_failed"),
                                                 (~base_failed() & verdict).alias("kept"))


BASE_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select(*BASE_COLUMNS)


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
w AS (SELECT rid, i, ws[i:i + 7] AS w FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM d WHERE len(ws) >= 8)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM w) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + 7)) AS p FROM r) GROUP BY rid),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS n_letters,
             length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_capitals,
             length(regexp_replace(t, '[\P{L}ALPHABET]+', '', 'g')) AS n_foreign,
             len(list_filter(ws, lambda x: list_contains([STOPS], lower(x)))) AS n_stop_words,
             len(list_filter(generate_series(2, len(ws)), lambda i: ws[i] = ws[i - 1])) AS n_stutters
      FROM d LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 15.0 * n_words AND n_symbols <= 0.25 * n_words
       AND n_letters >= 0.5 * word_chars AND n_capitals <= 0.6 * n_letters AND (n_stop_words >= 0.01 * n_words OR 100 * n_foreign > n_letters)
       AND n_dup_lines <= 0.5 * n_lines AND 10 * n_repeat_words <= 3 * n_words
       AND n_stutters <= 0.25 * n_words AS kept
FROM b
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS)).replace("ALPHABET", ALPHABET)
