"""Quality rules as one projection: a threshold table compiled into Spark expressions.

No user function runs. Words are parted by ASCII white space. A text's three-word windows
are numbers, hashes of their words' hashes; most texts have no two equal ones, which one
distinct set of numbers shows. Only where some are equal are the windows sorted with their
places and neighbours compared, by 96 bits, so the work is n log n in the words of a text
and needs no shuffle.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on with as by at from are this be an or his were which "
    "der die das und den von zu mit sich des auf für ist im nicht ein eine als auch es "
    "le la les de des et un une en est que dans qui pour pas sur au par il "
    "el los las y del se por con no una su para lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject where ``scale`` * numerator ``op`` limit * denominator; whole numbers only."""

    name: str
    numerator: str
    op: str
    limit: int
    denominator: str
    scale: int = 100
    #: A second sign without which the rule does not reject.
    only_with: "Rule | None" = None

    def sql(self):
        own = f"{self.scale} * ({self.numerator}) {self.op} {self.limit} * {self.denominator}"
        return f"{own} AND {self.only_with.sql()}" if self.only_with else own


# Fixed by the contract: these make base_failed.
BASE_RULES = (
    Rule("too_short", "n_words", "<", 50, "1", scale=1),
    Rule("repeats_windows", "n_repeat_words", ">", 50, "n_words"),
)
#: The method's own limits on length, symbol, stop-word and line ratios.
RULES = (
    Rule("words_too_short", "word_chars", "<", 2, "n_words", scale=1),
    Rule("words_too_long", "word_chars", ">", 20, "n_words", scale=1),
    Rule("symbols_per_word", "n_symbols", ">", 20, "n_words"),
    Rule("marks_per_word", "n_marks", ">", 60, "n_words"),
    Rule("repeated_lines", "n_dup_lines", ">", 50, "n_lines"),
    # Prose in any language but the listed ones has few of these words, so they never reject alone.
    Rule("few_stop_words", "n_stop_words", "<", 1, "n_words", only_with=Rule("odd", "n_marks + n_dup_lines", ">", 10, "n_words")),
    Rule("few_distinct_words", "n_distinct_words", "<", 12, "least_of_words"),
)
#: Only so many words count against distinct words, as any language repeats its words in time.
DISTINCT_BASE = 400


def _words(text):
    return F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")


def _shifted(column, k):
    """An array without its first ``k`` elements, and as many as ``_spans`` says."""
    return F.slice(column, F.lit(k + 1), F.col("_spans"))


def measured(docs, id_col="doc_id", text_col="text"):
    """The statistics that rules may name, one row per document.

    Sorting, distinct sets and lengths are built-in array functions. Lambdas see only
    fields of their own element, so no array is looked up or built again per element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), _words(text).alias("_words"))
    n = F.size("_words")
    triples = F.arrays_zip(*[_shifted("_hashes", k).alias("abc"[k]) for k in range(3)])
    placed = F.arrays_zip(
        F.col("_windows").alias("h"),
        *[_shifted("_words", k).alias("abc"[k]) for k in range(3)],
        F.sequence(F.lit(0), F.col("_spans") - 1).alias("at"),
    )
    ordered = F.sort_array(
        F.transform(placed, lambda w: F.struct(w["h"].alias("h"), F.hash(w["a"], w["b"], w["c"]).alias("m"), w["at"].alias("at")))
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    lowered = F.transform(F.col("_words"), lambda w: F.lower(w))
    no_places = F.array().cast("array<int>")
    return (
        base.withColumns(
            {
                "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
                "_spans": F.greatest(n - 2, F.lit(0)),
                "_lines": lines,
                "_distinct": F.array_distinct(F.col("_words")),
            }
        )
        .withColumn("_windows", F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])))
        .withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.col("_spans"), ordered))
        .withColumn("_next", F.slice("_sorted", F.lit(2), F.greatest(F.size("_sorted") - 1, F.lit(0))))
        .withColumn("_pairs", F.arrays_zip(F.col("_sorted").alias("x"), F.col("_next").alias("y")))
        .withColumn("_same", F.filter("_pairs", lambda p: (p["x"]["h"] == p["y"]["h"]) & (p["x"]["m"] == p["y"]["m"])))
        .withColumn(
            "_places",
            F.coalesce(
                F.flatten(
                    F.transform("_same", lambda p: F.array(*[p[side]["at"] + F.lit(k) for side in ("x", "y") for k in range(3)]))
                ),
                no_places,
            ),
        )
        .select(
            "doc_id",
            n.cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            _count("_text", SYMBOLS).alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.array_distinct("_places")).cast("long").alias("n_repeat_words"),
            _count("_text", MARKS).alias("n_marks"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.size(F.filter(lowered, lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size("_distinct").cast("long").alias("n_distinct_words"),
            F.least(n, F.lit(DISTINCT_BASE)).cast("long").alias("least_of_words"),
        )
    )


def _count(text, characters):
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def any_of(rules):
    return " OR ".join(f"({r.sql()})" for r in rules)


def _kept(rules):
    """The verdict, which a later filter must not carry below the statistics.

    Spark moves a filter through projections by putting their expressions in its place,
    here the whole work of every statistic once per rule that names it. It does not do so
    past a column that depends on the row's position.
    """
    return F.expr(f"NOT ({any_of(rules)})") & (F.monotonically_increasing_id() >= 0)


def judge(docs, id_col="doc_id", text_col="text", rules=RULES, base_rules=BASE_RULES):
    """Statistics, ``base_failed`` and ``kept`` per document, and the names of broken rules.

    Null and empty texts have no words and fail as too short. Every row is judged on its
    own, so repeated rows give repeated results; other columns of ``docs`` are not read.
    """
    broken = [F.when(F.expr(r.sql()), F.lit(r.name)) for r in (*base_rules, *rules)]
    return measured(docs, id_col, text_col).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr(any_of(base_rules)).alias("base_failed"),
        _kept((*base_rules, *rules)).alias("kept"),
        F.array_compact(F.array(*broken)).alias("broken_rules"),
    )


def passing(docs, text_col="text", rules=RULES, base_rules=BASE_RULES):
    """The rows of ``docs`` that break no rule, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("own_text"))
    judged = measured(rows, "row", "own_text").select("doc_id", _kept((*base_rules, *rules)).alias("kept"))
    return judged.where("kept").select("doc_id.*")
