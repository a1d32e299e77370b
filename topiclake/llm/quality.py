"""Quality rules that clean line by line first and judge the document by what is left; built-in expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclake.llm.common import SPACE_RUN, SPACES

SYMBOLS = "#*$%&|<>"

# Wording of navigation and boilerplate lines.
BOILERPLATE = (
    r"(?i)\b(cookies?|privacy policy|terms of (use|service)|all rights reserved|javascript|subscribe|sign (in|up)|log ?in|"
    r"click here|read more|share this|skip to content|back to top|powered by|lorem ipsum)\b"
)
#: A boilerplate phrase condemns short lines only; long ones merely mention it.
BOILERPLATE_WORDS = 25
#: Share of symbol characters from which a line is decoration rather than text.
SYMBOL_SHARE = 0.1
#: Share of upper case among letters from which a line shouts, and the letters it needs to be judged.
SHOUT_SHARE, SHOUT_LETTERS = 0.7, 12
#: Separators in one line from which it is a menu.
MENU_SEPARATORS = 3
#: A document is rejected when less than this share of its characters is left.
KEPT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _count(text: Column, characters: str) -> Column:
    """How often any of the characters occurs."""
    return F.length(text) - F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text))


def line_passes(line: Column) -> Column:
    """Whether a line is running text: punctuated, no menu, no shouting, no decoration, no boilerplate.

    Blank lines pass; they weigh nothing.
    """
    bare = F.btrim(line, F.lit(SPACES))
    letters = F.length(F.regexp_replace(bare, r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(bare, r"[^\p{Lu}]", ""))
    spoken = bare.rlike(r"[.!?:;…。！？][\"'”’»)\]]*$") | bare.rlike(r"[.!?…。！？][\"'”’»)\]]* ")
    menu = (_count(bare, "|") >= MENU_SEPARATORS) | (_count(bare, "»›>") >= MENU_SEPARATORS)
    decorated = _count(bare, SYMBOLS) > SYMBOL_SHARE * F.length(bare)
    shouted = (letters >= SHOUT_LETTERS) & (upper > SHOUT_SHARE * letters)
    boilerplate = bare.rlike(BOILERPLATE) & (_count(bare, " ") < BOILERPLATE_WORDS)
    return (bare == "") | (spoken & ~menu & ~decorated & ~shouted & ~boilerplate)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept`` and ``clean_text``.

    Null text counts as empty: no words, not kept, empty ``clean_text``. Texts of any length are read whole, repeated rows
    are judged alike, an empty table gives an empty result. Columns of the input stay, but for those with an added name,
    which are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(t, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))
    lines = F.split(t, "\n")
    own = [c for c in docs.columns if c not in ADDED]
    df = docs.select(*own, words.alias("_words"), lines.alias("_lines"), F.length(t).alias("_chars"), _count(t, SYMBOLS).cast("long").alias("n_symbols"))
    n = F.size("_words")
    seq = F.greatest(n, F.lit(1))
    triples = F.slice(F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, seq).alias("b"), F.slice("_words", 3, seq).alias("c")), F.lit(1), F.greatest(n - 2, F.lit(0)))
    spoken = F.filter("_lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.select(
        *own, "_lines", "_chars", "n_symbols", n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.transform(triples, lambda z: F.xxhash64(z["a"], z["b"], z["c"])).alias("_grams"), spoken.alias("_spoken"),
    )
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.select(
        *[c for c in df.columns if c not in ("_grams", "_spoken")], (F.size("_spoken") - F.size(F.array_distinct("_spoken"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, placed).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")).alias("_placed"),
        F.filter("_lines", line_passes).alias("_passed"),
    )
    both = F.arrays_zip(F.col("_placed").alias("x"), F.slice("_placed", F.lit(2), F.greatest(F.size("_placed"), F.lit(1))).alias("y"))
    same = F.filter(both, lambda p: p["x"]["g"] == p["y"]["g"])
    covered = F.flatten(F.transform(same, lambda p: F.array(*[p[s]["i"] + k for s in "xy" for k in range(3)])))
    df = df.select(*[c for c in df.columns if c not in ("_placed", "_lines", "_passed")], F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"), F.array_join("_passed", "\n").alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    left = F.length("clean_text") >= KEPT_SHARE * F.col("_chars")
    return df.withColumn("kept", ~F.col("base_failed") & left).drop("_chars")


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text", "_words", "_lines", "_chars", "_grams", "_spoken", "_placed", "_passed")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their columns as they were."""
    verdict = measure(docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias(text)), text)
    # a plain filter would be moved below the projections, with everything that it rests on worked out again for each use
    return verdict.select("_row", F.explode(F.array("kept")).alias("kept")).where("kept").select("_row.*")
