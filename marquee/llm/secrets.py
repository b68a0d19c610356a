"""Secret scan with a random forest that removes false positives — DataFrame functions only.

1. Candidates: values assigned to a name that holds a secret-sounding word, private
   key blocks and runs of 16 or more key characters with a digit ('=' only at their end).  The regex marks them
   in the text; splitting at the marks gives each value, its neighbours and
   its place, without leaving the JVM.
2. The corpus' own language: the counts of all its words give a dictionary (the most frequent ones, at most
   ``DICTIONARY_WORDS``) and the probabilities of letter trigrams (at most 27^3).
3. Features of each candidate: length, character transitions (classes, and the mean log probability of its letter
   trigrams), share covered by dictionary words, its path, how it is written (quoted, at a line's end, in a call,
   before prose), and the words before and after it, each as the share of secrets among labelled findings
   beside the same word.
4. A random forest, fitted on at most ``TRAIN_ROWS`` labelled findings of each
   class (those with the smallest hashes), is turned into CASE expressions;
   candidates at ``THRESHOLD`` or above stay.

Labelled findings can be given; without them ``weak_label`` labels the clear
cases (known formats, keys written as a value, digits only, placeholders, hashes, calls, prose …) of the corpus itself
and the forest decides the rest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import most_frequent, written

TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 15, 6, 11
THRESHOLD = 0.5
CONTEXT = 48
REDACTED = "[SECRET]"
DICTIONARY_WORDS = 20_000
#: Words of the corpus that are counted: runs of letters of 3 to 20.
LONGEST_WORD = 20

# Names, formats and words the scan knows.
NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|client[_-]?secret|auth(?:orization)?|bearer|credential"
KNOWN = (r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{30,}$|^github_pat_|^sk_(?:live|test)_|^sk-[0-9A-Za-z_-]{20,}$"
         r"|^xox[abprs]-|^eyJ[0-9A-Za-z_-]{10,}|^AIza[0-9A-Za-z_-]{30,}$|^glpat-|^-----BEGIN ")
PLACEHOLDER = r"(?i)example|dummy|placeholder|changeme|your[_-]|xxxx|redacted|sample|<[a-z]|\*{4}|test[_-]?(?:key|token)"
NOT_SECRET = r"(?i)(?:sha-?1|sha-?256|md5|commit|hash|checksum|digest|uuid|guid|isbn|order|phone|card|account|revision)\W{0,4}$"
TEST_PATH = r"(?i)test|example|sample|fixture|mock|docs?/"
_KEY_CHARS = "[A-Za-z0-9+/_~-]"
_MARK, _END = "\u0001", "\u0002"
_BLOCK = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[\s\S]+?-----END [A-Z ]{0,20}PRIVATE KEY-----"
_IN_QUERY = r"[?&][\w-]{1,80}="  # a value in an address ends at the next parameter
CANDIDATE = (
    rf"((?i:(?<![\w-])[\w-]*?(?:{NAMES})[\w-]*+[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?))"
    rf"({_BLOCK}|(?<={_IN_QUERY})[^\s\"'&#{_MARK}{_END}]{{6,}}|(?<!{_IN_QUERY})[^\s\"'{_MARK}{_END}]{{6,}})"
    rf"|({_BLOCK})"
    rf"|((?<!{_KEY_CHARS})(?=[A-Za-z+/_~-]*+[0-9])(?:{_KEY_CHARS}{{16,}}+={{0,2}}|{_KEY_CHARS}{{15}}=|{_KEY_CHARS}{{14}}==))")

FEATURES = ("f_length f_transitions f_vowel_steps f_digits f_upper f_hex f_distinct f_dictionary f_test_path "
            "f_path_depth f_named f_assigned f_quoted f_not_secret f_placeholder f_near f_known f_line_end f_call f_prose "
            "f_trigrams f_word_before f_word_after").split()


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``doc_id, row, start, length, value, before, after, path`` of every candidate (start in code points).

    NULL and empty texts have none; a NULL path counts as empty.
    """
    path = F.lit("") if path_col is None else F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    text = F.translate(F.col(text_col), _MARK + _END, "\u0003\u0003")
    src = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       path.alias("path"), F.regexp_replace(text, F.lit(CANDIDATE), F.lit(f"$1{_MARK}$2$3$4{_END}")).alias("t"))
           .where(F.contains("t", F.lit(_MARK)))
           .select("doc_id", "row", "path", F.split("t", _MARK).alias("p")))
    piece = F.transform("p", lambda x, i: F.struct(
        i.alias("i"), F.length(x).cast("long").alias("n"), F.substring_index(x, _END, 1).alias("value"),
        F.translate(F.right(F.when(i > 0, F.get(F.col("p"), i - 1)).otherwise(F.lit("")), F.lit(CONTEXT)), _END, "").alias("before"),
        F.substring(F.substring_index(x, _END, -1), 1, CONTEXT).alias("after")))
    rows = src.select("doc_id", "row", "path", F.explode(piece).alias("c")).select(
        "doc_id", "row", "path", "c.i", F.when(F.col("c.i") > 0, F.col("c.n") - 1).otherwise(F.col("c.n")).alias("n"),
        F.when(F.col("c.i") > 0, F.col("c.value")).alias("value"), "c.before", "c.after")
    before = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("start", F.sum("n").over(before)).where("i > 0")
            .select("doc_id", "row", "start", F.length("value").cast("long").alias("length"), "value", "before", "after", "path"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` of the corpus: runs of 3 to ``LONGEST_WORD`` letters a-z, lower-cased."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("word"))
    return words.where(F.length("word").between(3, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def dictionary(words: DataFrame, most: int = DICTIONARY_WORDS) -> DataFrame:
    """``word``: at most ``most`` frequent words, cut at a level of the count's logarithm (no global sort)."""
    return most_frequent(words, most).select("word")


def _trigrams(word: Column) -> Column:
    """The letter trigrams of a word, ends marked."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(marked, i, F.lit(3)))


def trigram_table(words: DataFrame) -> DataFrame:
    """``gram, p``: log probabilities of the trigrams of all words by their counts (add one; at most 28^3 rows)."""
    grams = words.select(F.explode(_trigrams(F.col("word"))).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("kinds")).first()
    return grams.select("gram", F.log((F.col("n") + 1) / F.lit(float(total["n"] + total["kinds"] + 1))).alias("p"))


def with_language(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``f_dictionary`` (share of its characters in dictionary words) and ``f_trigrams`` (mean log
    probability of its letter trigrams; 0 without letters)."""
    known = dictionary(words).withColumn("_in", F.lit(1))
    table = trigram_table(words)
    unseen = table.agg(F.min("p")).first()[0] or 0.0
    runs = F.regexp_extract_all(F.lower(F.regexp_replace("value", "(?<=[a-z])(?=[A-Z])", " ")), F.lit("([a-z]{3,})"), 1)
    parts = found.select("value").distinct().select("value", F.explode(runs).alias("word"))
    # both tables are bounded: DICTIONARY_WORDS and 28^3 rows
    covered = parts.join(F.broadcast(known), "word", "left").groupBy("value").agg(
        F.sum(F.when(F.col("_in") == 1, F.length("word")).otherwise(0)).alias("_covered"))
    grams = parts.select("value", F.explode(_trigrams(F.col("word"))).alias("gram"))
    likely = grams.join(F.broadcast(table), "gram", "left").groupBy("value").agg(F.avg(F.coalesce("p", F.lit(unseen))).alias("_p"))
    own = covered.join(likely, "value", "full")
    n = F.greatest(F.length("value"), F.lit(1)).cast("double")
    return found.join(own, "value", "left").withColumns({
        "f_dictionary": F.coalesce(F.col("_covered"), F.lit(0)) / n, "f_trigrams": F.coalesce("_p", F.lit(0.0))}).drop("_covered", "_p")


def features(found: DataFrame) -> DataFrame:
    """``found`` with the FEATURES columns that hang on the candidate alone (doubles, never NULL), and ``word_before``, ``word_after``."""
    v, low, n = F.col("value"), F.lower("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")

    def share(pattern: str, c: Column = v) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")

    after = F.coalesce("after", F.lit(""))
    call = v.rlike(r"^[A-Za-z_$][\w.$]*\(") | (v.rlike(r"^[A-Za-z_$][\w.$]*$") & after.rlike(r"^\(")) | v.rlike(r"^[$({]|^process\.|^os\.|^env\b")
    near = F.concat(F.coalesce("before", F.lit("")), v, F.coalesce("after", F.lit("")))
    # the value and what else stands in its quotes
    own = F.concat(v, F.when(F.col("before").rlike(r"[\"']$"),
                             F.regexp_extract(F.coalesce("after", F.lit("")), r"^[^\"'\n]*(?=[\"'])", 0)).otherwise(F.lit("")))
    cols = {
        "f_length": n,
        "f_transitions": share("(?<=[a-z])(?=[A-Z0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Z])(?=[a-z0-9])"),
        "f_vowel_steps": share("[aeiouy](?=[b-df-hj-np-tv-xz])|[b-df-hj-np-tv-xz](?=[aeiouy])", low),
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_hex": flag(low.rlike("^[0-9a-f]+$")),
        "f_distinct": F.size(F.array_distinct(F.split(v, ""))).cast("double"),
        "f_test_path": flag(F.col("path").rlike(TEST_PATH)),
        "f_path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "f_named": flag(F.col("before").rlike(rf"(?i)(?:{NAMES})")),
        "f_assigned": flag(F.col("before").rlike(r"[:=]\s*[\"']?$")),
        "f_quoted": flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")),
        "f_not_secret": flag(F.col("before").rlike(NOT_SECRET)),
        "f_placeholder": flag(own.rlike(PLACEHOLDER)),
        "f_near": flag(near.rlike(PLACEHOLDER)),
        "f_known": flag(v.rlike(KNOWN)),
        "f_line_end": flag(after.rlike(r"^[\"']?[ \t]*(?:$|[\r\n;,&#)\]}])")),
        "f_call": flag(call),
        "f_prose": flag(after.rlike(r"^[,.]? +[a-z]{2,}(?: +[a-z]+|[.,!?])")),
        "word_before": F.lower(F.regexp_extract(F.coalesce("before", F.lit("")), r"([A-Za-z]+)[^A-Za-z]*$", 1)),
        "word_after": F.lower(F.regexp_extract(after, r"^[^A-Za-z]*([A-Za-z]+)", 1)),
    }
    return found.withColumns(cols)


def described(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``found`` (candidates, or labelled findings) with all features but the neighbouring words', by the language of ``docs``."""
    return with_language(features(found), written(word_counts(docs, text_col), "secrets-words"))


def weak_label() -> Column:
    """1 for clear secrets, 0 for clear non-secrets, NULL where the forest is to decide.  Known formats come first;
    words around a value (``f_near``) label nothing."""
    c = F.col
    keyed = (c("f_transitions") >= 0.12) & (c("f_distinct") >= 10)
    long_hex = (c("f_hex") == 1) & (c("f_length") >= 24) & (c("f_digits") > 0) & (c("f_digits") < 1)
    written_out = (c("f_quoted") == 1) | (c("f_line_end") == 1) | ((c("f_prose") == 0) & (c("f_length") >= 16))
    return (F.when(c("f_known") == 1, 1).when((c("f_placeholder") == 1) | (c("f_call") == 1) | (c("f_not_secret") == 1), 0)
            .when((c("f_prose") == 1) & (c("f_quoted") == 0) & ~keyed & ~long_hex, 0)
            .when((c("f_assigned") == 1) & (c("f_named") == 1) & written_out & (keyed | long_hex), 1)
            .when((c("f_digits") >= 0.95) | (c("f_dictionary") >= 0.6), 0)
            .when((c("f_assigned") == 0) & (c("f_named") == 0), 0))


def beside_words(train: DataFrame, side: str) -> DataFrame:
    """``word, _n, _ones`` of the words on one ``side`` (``before`` or ``after``) of the labelled findings (at most 2 * TRAIN_ROWS)."""
    return (train.where(F.col(f"word_{side}") != "").groupBy(F.col(f"word_{side}").alias("_word"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_ones")))


def with_neighbours(rows: DataFrame, tables: dict[str, DataFrame], own: bool) -> DataFrame:
    """``f_word_before, f_word_after``: the share of secrets among the labelled findings beside the same word, pulled
    towards a half by one finding; ``own``: a row of the training set doesn't count itself."""
    for side, table in tables.items():
        less_n, less_one = (F.lit(1), F.col("label")) if own else (F.lit(0), F.lit(0.0))
        rate = (F.col("_ones") - less_one + 0.5) / (F.col("_n") - less_n + 1)
        joined = rows.join(F.broadcast(table), F.col(f"word_{side}") == F.col("_word"), "left")
        rows = joined.withColumn(f"f_word_{side}", F.coalesce(rate, F.lit(0.5)).cast("double")).drop("_word", "_n", "_ones")
    return rows


def training_rows(labelled: DataFrame) -> DataFrame:
    """At most TRAIN_ROWS rows of each label (0 and 1; NULL: passed over), those with the smallest hashes."""
    order = F.xxhash64("value", "word_before", "word_after", "start")
    own = [f for f in FEATURES if not f.startswith("f_word_")]
    parts = [labelled.where(F.col("label") == k).select(*own, "word_before", "word_after", F.lit(float(k)).alias("label"), order.alias("_h"))
             .orderBy("_h", *own).limit(TRAIN_ROWS) for k in (0, 1)]
    return written(parts[0].union(parts[1]).drop("_h"), "secrets-train")


def fit_forest(train: DataFrame):
    """The forest's probability as a Column over FEATURES, from rows with ``label``.

    With one class only (or none) there is nothing to fit: the probability is then that class (none: 0.5).
    """
    kinds = [r["label"] for r in train.select("label").distinct().collect()]
    if len(kinds) < 2:
        return F.lit(kinds[0] if kinds else 0.5)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(train)
    model = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)

    def expression(node) -> Column:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return F.lit(float(stats[1] / max(1e-12, sum(stats))))
        split = node.split()
        return F.when(F.col(FEATURES[split.featureIndex()]) <= F.lit(float(split.threshold())),
                      expression(node.leftChild())).otherwise(expression(node.rightChild()))

    trees = [expression(t._java_obj.rootNode()) for t in model.trees]
    total = trees[0]
    for t in trees[1:]:
        total = total + t
    return total / F.lit(float(len(trees)))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = "source") -> DataFrame:
    """``doc_id, row, start, length, value, probability`` of every secret.

    ``labelled``: findings (columns of ``candidates`` and ``label`` 0/1); None:
    the corpus' own clear cases.  ``row`` tells rows apart that share an id.
    Repeated rows and repeated values each give their findings; NULL ids
    stay NULL.  No candidates, or an empty table: an empty result.
    """
    found = written(described(docs, candidates(docs, id_col, text_col, path_col), text_col), "secrets-candidates")
    train = training_rows(found.withColumn("label", weak_label()) if labelled is None else described(docs, labelled, text_col))
    tables = {side: written(beside_words(train, side), f"secrets-{side}") for side in ("before", "after")}
    probability = fit_forest(written(with_neighbours(train, tables, own=True), "secrets-rows"))
    found = with_neighbours(found, tables, own=False)
    return found.select("doc_id", "row", "start", "length", "value", probability.cast("double").alias("probability")).where(
        F.col("probability") >= THRESHOLD)


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found value of a document replaced by REDACTED in its text; all other columns unchanged.

    Rows that share an id share its values; longer values are replaced first.
    """
    values = found.select(F.col("doc_id").alias("_id"), "value").distinct().groupBy("_id").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct(F.length("value").alias("n"), F.col("value").alias("v"))))).alias("_v"))
    clean = F.aggregate("_v", F.col(text_col), lambda t, x: F.replace(t, x["v"], F.lit(REDACTED)))
    out = docs.join(values, docs[id_col].eqNullSafe(F.col("_id")), "left")
    return out.withColumn(text_col, F.when(F.col("_v").isNull(), F.col(text_col)).otherwise(clean)).select(*docs.columns)
