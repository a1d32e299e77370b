"""Secret scan: candidates found by patterns, false positives removed by a random forest; built-in expressions only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclake.llm.common import cut, small

# Forms of known issuers.
_ISSUER = r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|(?<![_-])eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+"
#: Also inside a longer value, where it begins a word.
ISSUED = rf"(?<![A-Za-z0-9])(?:{_ISSUER})"
#: A candidate: what something named as a credential is set to, a run of key characters with a digit, or of a known
#: issuer's form. Nothing is cut off at its end.
_RUN = r"(?=[A-Za-z+/_.=~-]*+[0-9])[A-Za-z0-9+/_=~.-]{16,}"
_KEYWORD = r"(?i:passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key)"
_NAMED = rf"""(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]*?{_KEYWORD}[A-Za-z0-9_-]{{0,64}}+["']?[ ]?[:=][ ]?"""
_QUOTED = r"""[^\s"'<>]{8,}(?=["'])"""
#: Up to white space, a quote or the next parameter of an address.
_BARE = r"""(?!=|//)(?:(?!&[A-Za-z0-9_.-]*+=)[^\s"'<>]){8,}+"""
CANDIDATE = rf"""{_NAMED}(?:["']{_QUOTED}|{_BARE})|(?<![A-Za-z0-9+/_=~.-])(?:{_RUN})|{ISSUED}"""
#: What stands before the value in a candidate: such a name, or any other (of a few digits at most) and its sign.
_NAME = rf"""^(?:{_NAMED}(?:["']|(?=[^\s"'<>=]))|-{{0,2}}+(?=[A-Za-z_])(?:[A-Za-z_.-]*+[0-9]){{0,3}}+[A-Za-z_.-]*+=(?=[^=]))"""
#: Characters of context before and after a candidate.
BEFORE, AFTER = 64, 32
# Words near real secrets, words near other long strings, a credential's name and sign, paths of examples and of settings.
CREDENTIAL = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer)"
DIGEST = r"(?i)(sha-?\d*|md5|checksum|digest|commit|etag|uuid|guid|revision|hash|version|isbn|phone|tel|call)"
SET = rf"""{_KEYWORD}[A-Za-z0-9_-]*["']?[ ]?[:=][ ]?$"""
EXAMPLE_PATH = r"(?i)(test|example|sample|mock|fixture|doc|demo|tutorial)"
SETTINGS_PATH = r"(?i)(\.env|config|settings|secret|credential|deploy|\.pem|\.ya?ml|\.ini|\.properties)"
#: The documents that make a run of letters a word of the dictionary.
DICTIONARY_DOCS = 3
#: Bound of the training sample (those of the smallest hash), and the forest.
TRAIN_ROWS, TREES, DEPTH, SEED = 20_000, 30, 6, 17
SECRET_FROM = 0.5
MASK = "[SECRET]"

FEATURES = [
    "length", "digit_share", "upper_share", "lower_share", "symbol_share", "hex_only", "variety", "class_changes", "letter_changes",
    "longest_digits", "coverage", "issued", "near_credential", "near_digest", "assigned", "quoted", "example_path", "settings_path", "path_rate",
]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: ``doc``, ``mark`` (hash of the text), ``path``, ``start`` (from 0), ``value``, ``before``, ``after``."""
    t = F.col(text)
    # texts are cut once; the few with a candidate are then read again for the candidates themselves
    cut_once = F.explode(F.array(F.split(t, CANDIDATE, -1))).alias("between")
    read = docs.select(F.col(key).alias("doc"), F.col(path).cast("string").alias("path"), F.xxhash64(t).alias("mark"), t.alias("t"), cut_once).where(F.size("between") > 1)
    read = read.select("doc", "path", "mark", F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(0)).alias("found"), "between").withColumn("row", F.monotonically_increasing_id())
    each = F.arrays_zip(F.col("between").alias("b"), F.col("found").alias("v"), F.slice("between", F.lit(2), F.size("between")).alias("a"))
    # a value that is named in front of it travels with its name up to here
    name = lambda v: F.regexp_extract(v, _NAME, 0)
    short = F.transform(
        each,
        lambda z: F.struct(
            F.length(z["b"]).alias("gap"), F.right(F.concat(F.right(z["b"], F.lit(BEFORE)), name(z["v"])), F.lit(BEFORE)).alias("before"),
            z["v"].alias("match"), F.substring(z["v"], F.length(name(z["v"])) + 1, F.length(z["v"])).alias("value"), F.left(z["a"], F.lit(AFTER)).alias("after"),
        ),
    )
    rows = read.select("doc", "path", "mark", "row", F.posexplode(short).alias("at", "c")).where("c.match IS NOT NULL")
    end = F.sum(F.col("c.gap") + F.length("c.match")).over(Window.partitionBy("row").orderBy("at"))
    return rows.select("doc", "mark", "path", (end - F.length("c.value")).cast("long").alias("start"), "c.value", "c.before", "c.after")


def _parts(found: DataFrame) -> DataFrame:
    """Letter runs of the values, cut between small and capital letters too: ``value``, ``word``."""
    split = F.split(F.lower(F.regexp_replace("value", r"(?<=\p{Ll})(?=\p{Lu})", " ")), r"[^\p{L}]+")
    return found.select("value").distinct().select("value", F.explode(F.array_distinct(split)).alias("word")).where(F.length("word") > 2)


def dictionary(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Of the letter runs in the values, those that are words in so many of all documents."""
    wanted = small(cut(_parts(found).select("word").distinct()))
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(text), r"[\x00-\x60\x7B-\x7F]+"))).alias("word"))
    return words.join(wanted, "word", "left_semi").groupBy("word").agg(F.count("*").alias("docs")).where(F.col("docs") >= DICTIONARY_DOCS)


def _count(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, ""))


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """Add the forest's features: length, character transitions, dictionary coverage, path and neighbouring words."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: _count(v, pattern) / n
    digits = F.array_max(F.transform(F.split(v, "[^0-9]+"), F.length))
    # changes between letters, digits and the rest, and between upper and lower case
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, r"[\p{L}]+", "a"), r"[0-9]+", "9"), r"[^a9]+", ".")
    cases = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, r"[^\p{L}]+", ""), r"\p{Lu}+", "A"), r"[^A]+", "a")
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    out = found.select(
        "*", n.cast("double").alias("length"), share("[^0-9]").alias("digit_share"), share(r"[^\p{Lu}]").alias("upper_share"),
        share(r"[^\p{Ll}]").alias("lower_share"), share(r"[\p{L}0-9]").alias("symbol_share"), yes(v.rlike("^[0-9a-fA-F]+$")).alias("hex_only"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("variety"), ((F.length(kinds) - 1) / n).alias("class_changes"),
        (F.length(cases) / n).alias("letter_changes"), digits.cast("double").alias("longest_digits"), yes(v.rlike(ISSUED)).alias("issued"),
        yes(before.rlike(CREDENTIAL)).alias("near_credential"), yes(before.rlike(DIGEST)).alias("near_digest"),
        yes(before.rlike(r"[:=]\s*[\"'`]?$")).alias("assigned"), yes(before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")).alias("quoted"),
        yes(F.col("path").rlike(EXAMPLE_PATH)).alias("example_path"), yes(F.col("path").rlike(SETTINGS_PATH)).alias("settings_path"),
    )
    # how much of a value's letters are words of the dictionary: the values' parts meet the words, once per distinct value
    parts = _parts(found)
    covered = parts.join(known.select("word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    rates = found.groupBy("path").agg(F.count("*").alias("_at"), F.count_if(F.col("before").rlike(CREDENTIAL)).alias("_near"))
    out = out.join(covered, "value", "left").join(rates, "path", "left")
    return out.withColumn("coverage", F.coalesce(F.col("covered") / n, F.lit(0.0))).withColumn("path_rate", F.coalesce(F.col("_near") / F.col("_at"), F.lit(0.0))).drop("covered", "_at", "_near")


def weak_labels(described: DataFrame) -> DataFrame:
    """Findings with a ``label`` where two plain rules are sure of it: for tables without findings that people labelled.

    1: an issuer's form, or a mixed value that is assigned to something named as a credential, in quotes or right behind the
    name. 0: no such name near, and a number, an address, or mostly words or one kind of characters; or a bare value of words
    alone. All others have no label and are left out.
    """
    number = F.col("digit_share") + F.col("symbol_share") > 0.95
    address = F.col("value").rlike(r"^[\w.-]+\.[A-Za-z]{2,}$") | F.col("before").rlike(r"@$") | F.col("after").rlike("^@")
    bare = F.coalesce(F.col("before").rlike(SET), F.lit(False))
    mixed = (F.col("near_credential") == 1) & (F.col("assigned") == 1) & (F.col("digit_share") > 0.1) & (F.col("digit_share") < 0.9)
    sure = (F.col("issued") == 1) | (mixed & ((F.col("quoted") == 1) | (bare & ~address & ~number & (F.col("coverage") <= 0.5))))
    prose = bare & (F.col("digit_share") == 0) & (F.col("coverage") > 0.5)
    plain = (F.col("near_credential") == 0) & (F.col("issued") == 0) & (number | address | (F.col("coverage") > 0.5) | (F.col("class_changes") < 0.12) | (F.col("assigned") == 0))
    return described.withColumn("label", F.when(sure, 1.0).when(plain | prose, 0.0)).where("label IS NOT NULL")


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (``features`` and a ``label`` of 0 or 1); None if either class has none.

    The sample is bounded: ``rows`` findings, half of either class where there are so many, by a hash of value and context.
    """
    order = F.xxhash64("value", "before", "after", "path", "start")
    columns = [*FEATURES, "label", order.alias("_order")]
    halves = [labelled.where(F.col("label") == c).select(*columns).orderBy("_order").limit(rows // 2) for c in (0.0, 1.0)]
    sample = halves[0].union(halves[1]).repartition(1).sortWithinPartitions("_order", "label")
    if len(sample.select("label").distinct().collect()) < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(sample)
    return RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(ready)


def judge(described: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Add ``score``, the forest's share for a secret; without a forest only known issuers' forms count."""
    if forest is None:
        return described.withColumn("score", F.col("issued"))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(described)
    scored = forest.transform(ready)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: ``doc``, ``mark``, ``path``, ``start``, ``value``, ``score`` and ``secret`` (score of 0.5 or more).

    ``labelled`` holds findings with ``features`` and ``label``; without it the sure cases among the candidates teach the
    forest. Null and empty texts have no candidates; null keys and paths are values like any other; rows that repeat are
    each reported. Texts are read whole, ``start`` counts characters. Other columns are not read; an empty table gives
    no rows.
    """
    found = cut(candidates(docs, key, text, path))
    described = cut(features(found, dictionary(docs, found, text)))
    forest = train(weak_labels(described) if labelled is None else labelled)
    judged = judge(described, forest)
    return judged.select("doc", "mark", "path", "start", "value", "score", (F.col("score") >= SECRET_FROM).alias("secret"))


def redact(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """The documents, columns as they were, with every secret replaced by a mask; no document is dropped."""
    found = scan(docs, labelled, key, text, path).where("secret")
    gone = found.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(F.sort_array(F.collect_set("value"), asc=False).alias("_values"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_id"), F.col(text).alias("_text"))
    met = rows.join(gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("_text") == F.col("_mark")), "left")
    longest = F.array_sort("_values", lambda a, b: F.length(b) - F.length(a))
    clean = F.when(F.col("_values").isNull(), F.col("_text")).otherwise(F.aggregate(longest, F.col("_text"), lambda t, v: F.replace(t, v, F.lit(MASK))))
    return met.select(*[clean.alias(c) if c == text else F.col(f"_row.{c}") for c in docs.columns])
