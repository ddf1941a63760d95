"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols (``SYMBOLS``). Every word lists the full one-edit neighbourhood of its reduced
form: all deletions, replacements and insertions of a symbol, and the reduced form itself, for letters replaced by
one of the same symbol. The neighbourhoods are joined with the reduced forms of all words; what meets is verified on the
words themselves. Two words one edit apart always meet, because their reduced forms are at most one edit apart.

A reduced form alone is shared by many words. An edit leaves either the first or the last ``ANCHOR`` letters of a word as
they are, and which of them follows from its place, so these letters are part of the join key. A key holds words that differ in
letters of the same symbol only.

Words are maximal runs of ASCII letters and of characters from U+00C0 to U+00FF, with A-Z lower-cased. As the table's
typing errors, a run loses one character where 199 divides crc32 of ``doc_id:run``.

Defined results: null and empty texts have no words; a missing doc_id counts as the text ``null`` in the hash; repeated rows count
each; a word without near word has no form and is its own root; ties go to the smaller word in code-point
order; an empty table gives no rows. Only doc_id and text are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed

LEAST_LENGTH, LEAST_COUNT = 6, 5  # code points of a word, and how often it must occur
TIMES = 5  # a form occurs at least this many times as often as its variant
SYMBOLS = "0123"  # the reduced alphabet
ANCHOR = 3  # letters; a word has at least twice as many

_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_ERROR = 199


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, with the table's deletions."""
    runs = F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc"), F.explode(runs).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.col("run"))
    rows = rows.select("doc", low.alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    place = (h % F.length("run")).cast("int")
    cut = F.concat(F.expr("left(run, place)"), F.expr("substr(run, place + 2)"))
    words = rows.withColumns({"h": h, "place": place}).select(
        F.when(F.col("h") % _ERROR == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def reduced(word: Column) -> Column:
    symbols = "".join(SYMBOLS[(ord(c) * 0x9E3779B1 >> 16) % len(SYMBOLS)] for c in _LETTERS)
    return F.translate(word, _LETTERS, symbols)


def _head(word: Column) -> Column:
    return F.concat(F.lit("^"), F.left(word, F.lit(ANCHOR)))


def _tail(word: Column) -> Column:
    return F.concat(F.lit("$"), F.right(word, F.lit(ANCHOR)))


def _key(form: Column, anchor: Column) -> Column:
    return F.xxhash64(form, anchor)


def neighbourhood(word: Column, form: Column) -> Column:
    """Keys of the one-edit neighbourhood of a word's reduced ``form``, each with the letters that its edit leaves."""
    n = F.length(form)

    def anchor(p: Column) -> Column:
        return F.when(p > ANCHOR, _head(word)).otherwise(_tail(word))

    def before(p: Column) -> Column:
        return F.substring(form, F.lit(1), p - 1)

    def after(p: Column, skip: int) -> Column:
        return F.substring(form, p + skip, n)

    places = F.sequence(F.lit(1), n)
    kinds = [F.transform(places, lambda p: _key(F.concat(before(p), after(p, 1)), anchor(p)))]
    for symbol in SYMBOLS:
        kinds.append(F.transform(places, lambda p: _key(F.concat(before(p), F.lit(symbol), after(p, 1)), anchor(p))))
        kinds.append(F.transform(
            F.sequence(F.lit(1), n + 1), lambda p: _key(F.concat(before(p), F.lit(symbol), after(p, 0)), anchor(p))))
    return F.array_distinct(F.concat(*kinds))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of words one edit apart, both ways round, in partitions by ``word``."""
    forms = words.select("word", "n", reduced(F.col("word")).alias("form"))
    asking = forms.select(
        "word", "n", F.explode(neighbourhood(F.col("word"), F.col("form"))).alias("key"))
    both = F.array(_key(F.col("form"), _head(F.col("word"))), _key(F.col("form"), _tail(F.col("word"))))
    asked = forms.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(both).alias("key"))
    met = asking.join(asked, "key").where("word <> other")
    met = met.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")
    # One shuffle by word serves both steps: the same pair may have met under several keys.
    return met.repartition("word").dropDuplicates(["word", "other"])


def rooted(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """(word, root) of words that have a ``form``: forms followed to the last, in jumps that double."""
    cur = landed(forms.select("word", F.col("form").alias("root")))
    for _ in range(rounds):
        onward = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cur.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = landed(step)
        cur = step.drop("moved")
        if step.where("moved").isEmpty():
            return cur
    raise RuntimeError(f"forms did not end in {rounds} rounds")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = landed(counted(docs))
    # Ends in the code-point order of other for equal counts: least (-other_n, other).
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    larger = -F.col("b.m") >= TIMES * F.col("n")
    near = landed(near.select(
        "word", "n_near", F.when(larger, F.col("b.form")).alias("form"), F.when(larger, -F.col("b.m")).alias("form_n")))
    roots = rooted(near.where("form is not null").select("word", "form"))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
