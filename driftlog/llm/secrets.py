"""Secret scans: candidates by pattern, a random forest to sort out the false ones. DataFrame operations only.

Candidates have two forms. ``RUN``: a run of at least ``MIN_LENGTH`` characters ``[A-Za-z0-9_+/=.~-]``
with a letter or digit in it; four marks or more in front (a ruler) do not belong to it. ``ASSIGNED``: a value of at least ``MIN_ASSIGNED`` characters behind a
credential name and ``=``, ``:``, ``=>`` or ``:=``; quoted, all up to the closing quote on its line, else
all up to a space or quote, without closing punctuation. A run at the place of an assigned value is no
candidate of its own; one that begins before it is.
Each place of a candidate in a document is one finding, described by its length, its character
transitions and shares, how much of it dictionary words cover, its path (the document's source) and
the words beside that place. Every place has its own score; a value is a secret at all its places in a
document if it is one at any of them. The dictionary is the ``DICTIONARY_WORDS`` most frequent runs of
letters in and beside all findings. A random forest trained on labelled findings gives each finding
the probability of being a secret.

Labelled findings come from the caller. ``labelled_by_form`` derives them from the findings
themselves for corpora without reviewed findings: a value assigned to a credential name is a secret if it
has a digit, a capital behind a small letter or a mark in it; the host of a mail address, a dotted host
name, a plain number or a plain word that is assigned to nothing is not; all others stay unlabelled
and are left to the forest, which sees neither rule.

Defined results: null and empty texts have no findings. Rows with a null id and repeated rows have findings like any other
(repeated rows: the same ones). Without labelled findings of both kinds nothing is sorted out: every
finding has score 1.0. Without findings there are no rows. Other columns are ignored by ``findings``
and kept by ``redact``, which changes the text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm.common import cut

MIN_LENGTH, MIN_ASSIGNED = 16, 6
_NAME = r"""(?:key|token|secret|passw|pwd|credential|auth)[\w-]{0,32}["']?\s{0,3}(?:=>|:=|=|:)\s{0,3}"""
CREDENTIAL = r"""(?i)%s["']?$""" % _NAME
# the short lookbehinds before the long one keep most places from it
_AFTER_NAME = r"""(?<=[=:>]\s{0,3}["']{0,1})(?<=(?i:%s["']{0,1}))""" % _NAME
RUN = r"""(?:(?<![A-Za-z0-9_+/=.~-])(?![_+/=.~-]{4})(?=[_+/=.~-]*+[A-Za-z0-9])|(?<=[_+/=.~-]{4})(?=[A-Za-z0-9]))(?!%s)[A-Za-z0-9_+/=.~-]{%d,}+""" % (_AFTER_NAME, MIN_LENGTH)
ASSIGNED = r"""(?<=["'\s=:>])%s(?:(?<=")[^"\r\n]{%d,}+(?=")|(?<=')[^'\r\n]{%d,}+(?=')|[^\s"'=:>][^\s"']{%d,}(?<![,;:.)\]}]))""" % (
    _AFTER_NAME, MIN_ASSIGNED, MIN_ASSIGNED, MIN_ASSIGNED - 1,
)
CONTEXT = 64
DICTIONARY_WORDS = 2_000
#: Labelled findings of each kind that the forest is trained on, at most (by ascending hash).
MAX_LABELLED = 3_000
TREES, DEPTH, SEED = 20, 6, 17
THRESHOLD = 0.5
FEATURES = (
    "length", "distinct_share", "turns", "case_turns", "digit_share", "upper_share", "lower_share", "hex_share", "mark_share",
    "dictionary_share", "test_path", "before_mark", "before_quote", "before_word_length", "before_digit", "after_quote", "after_word_length", "same_before",
)


def places(pattern: str) -> Column:
    """Every match of ``pattern`` in ``text``, in order, as array<struct(value, start)>; start is 0-based, in code points."""
    # parts between the matches: one more than there are matches
    both = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("value"), F.split("text", pattern, -1).alias("part"))
    none = F.array().cast("array<struct<value: string, start: bigint>>")

    def add(done: Column, x: Column) -> Column:
        start = done["end"] + F.length(x["part"])
        place = F.array(F.struct(x["value"].alias("value"), start.alias("start")))
        return F.struct(
            (start + F.coalesce(F.length(x["value"]), F.lit(0))).alias("end"), F.when(x["value"].isNull(), done["found"]).otherwise(F.concat(done["found"], place)).alias("found")
        )

    return F.aggregate(both, F.struct(F.lit(0).cast("long").alias("end"), none.alias("found")), add, lambda done: done["found"])


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """One row for each place of a candidate in a document: doc_id, text_key, path, value, start (0-based, code points), before, after."""
    rows = docs.select("doc_id", F.col(path).cast("string").alias("path"), "text", F.explode(F.concat(places(RUN), places(ASSIGNED))).alias("_place"))
    rows = rows.select("doc_id", "path", "text", "_place.value", "_place.start")
    at = (F.col("start") + 1).cast("int")
    size = F.least(at - 1, F.lit(CONTEXT))
    return rows.select(
        "doc_id", F.xxhash64("text").alias("text_key"), "path", "value", "start",
        F.substr("text", at - size, size).alias("before"), F.substr("text", at + F.length("value"), F.lit(CONTEXT)).alias("after"),
    )


def dictionary(found: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent runs of three letters or more in and beside the findings, hex digits alone not counted."""
    runs = F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "value", "after")), F.lit("[a-z]{3,}"), F.lit(0))
    return found.select(F.explode(runs).alias("word")).where(~F.rlike("word", F.lit("^[a-f]+$"))).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words).select("word")


def described(found: DataFrame) -> DataFrame:
    """``found`` with a double column for each of ``FEATURES``."""
    length = F.length("value")
    share = lambda pattern: F.regexp_count("value", F.lit(pattern)) / length
    last_word = F.regexp_extract("before", r"([^\x20\x09-\x0D=:\"']*)[\x20\x09-\x0D=:\"']*$", 1)
    next_word = F.regexp_extract("after", r"^[\x20\x09-\x0D=:\"']*([^\x20\x09-\x0D=:\"']*)", 1)
    out = found.withColumns(
        {
            "length": length, "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / length,
            "turns": share(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"), "case_turns": share(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
            "digit_share": share("[0-9]"), "upper_share": share("[A-Z]"), "lower_share": share("[a-z]"), "hex_share": share("[0-9a-fA-F]"), "mark_share": share("[^A-Za-z0-9]"),
            "test_path": F.rlike("path", F.lit("(?i)test|example|sample|fixture|mock")), "before_mark": F.rlike("before", F.lit(r"[=:]\s{0,3}[\"']?$")),
            "before_quote": F.rlike("before", F.lit("[\"']$")), "after_quote": F.rlike("after", F.lit("^[\"']")),
            "before_digit": F.rlike("before", F.lit(r"[0-9]\s*$")), "before_word_length": F.length(last_word), "after_word_length": F.length(next_word),
            "same_before": F.contains("before", F.substr("value", F.lit(1), F.lit(6))),
        }
    )
    runs = F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word")
    values = found.select("value").distinct()
    known = values.select("value", runs).join(F.broadcast(dictionary(found)), "word").groupBy("value").agg(F.sum(F.length("word")).alias("_known"))
    out = out.join(known.withColumnRenamed("value", "_value"), F.col("value") == F.col("_value"), "left")
    out = out.withColumn("dictionary_share", F.coalesce("_known", F.lit(0)) / F.col("length")).drop("_known", "_value")
    return out.withColumns({k: F.coalesce(F.col(k).cast("double"), F.lit(0.0)) for k in FEATURES})


def labelled_by_form(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1.0 for a value assigned to a credential name, 0.0 for hosts, numbers and words, else null."""
    assigned = F.rlike("before", F.lit(CREDENTIAL))
    secret = assigned & F.rlike("value", F.lit(r"[0-9]|[a-z][A-Z]|[^\sA-Za-z0-9]"))
    word = ~assigned & F.rlike("value", F.lit(r"^[A-Za-z]?[a-z]+$"))
    other = word | F.endswith("before", F.lit("@")) | F.rlike("value", F.lit(r"^[0-9.+-]+$|^[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,12}$"))
    return found.withColumn("label", F.when(secret, 1.0).when(other, 0.0))


def forest(labelled: DataFrame, max_labelled: int = MAX_LABELLED):
    """A random forest fitted on at most ``max_labelled`` findings of each label, None without both labels.

    The sample is sorted into one partition, so the same findings give the same forest.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled.where("label is not null").select("label", *FEATURES)
    order = [F.xxhash64(*FEATURES), *FEATURES]
    some = lambda label: rows.where(F.col("label") == label).orderBy(*order).limit(max_labelled)
    sample = cut(some(0.0).unionByName(some(1.0)).coalesce(1).sortWithinPartitions("label", *order))
    if {r["label"] for r in sample.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(sample)
    model = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(assembled)
    # the training summary holds the session, which tasks cannot carry once anything in it has observed a query
    model._java_obj.setSummary(sample.sparkSession._jvm.scala.Option.empty())
    return model


def scored(features: DataFrame, model) -> DataFrame:
    """``features`` with ``score``: the forest's probability that the finding is a secret."""
    if model is None:
        return features.withColumn("score", F.lit(1.0))
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_probability")
    out = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(features))
    return out.withColumn("score", vector_to_array("_probability")[1]).drop("_features", "_probability")


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source") -> DataFrame:
    """All findings of ``docs`` with ``score`` and ``secret`` (the value scores ``THRESHOLD`` or more at this
    or another of its places in the document): doc_id, text_key, path, value, start, length, score, secret.

    ``labelled``: findings with FEATURES and ``label`` from reviews; by default derived by form.
    """
    found = cut(findings(docs, path))  # texts are searched once; a few rows a document, with 64 characters of context
    found = cut(described(found))
    model = forest(labelled_by_form(found) if labelled is None else labelled)
    out = scored(found, model)
    highest = F.max("score").over(Window.partitionBy("doc_id", "text_key", "value"))
    return out.select(
        "doc_id", "text_key", "path", "value", "start", F.col("length").cast("long").alias("length"), "score", (highest >= THRESHOLD).alias("secret")
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; all rows and columns stay."""
    found = scan(docs, labelled).where("secret")
    # longest first: a secret inside another is not cut out of it
    per = F.array_distinct(F.transform(F.sort_array(F.collect_set(F.struct((-F.col("length")).alias("n"), "value"))), lambda s: s["value"]))
    found = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(per.alias("_values"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"))  # whatever their names, the columns of docs clash with none of these
    rows = rows.join(found, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_row.text") == F.col("_key")), "left")
    clean = F.aggregate("_values", F.col("_row.text"), lambda t, v: F.replace(t, v, F.lit(mark)))
    rows = rows.select("_row", F.when(F.col("_values").isNull(), F.col("_row.text")).otherwise(clean).alias("_text"), F.col("_values").isNotNull().alias("_changed"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed = F.length("_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("_changed"), changed).otherwise(F.col("_row.n_chars"))
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
