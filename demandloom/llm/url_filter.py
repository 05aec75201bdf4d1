"""URL filters by host-suffix and path-prefix expressions.

A rule names a host with all its subdomains and the start of a path, written together
like ``example.net/en/``. Each url is expanded into every expression that a rule of the
list could be: its host and the host's suffixes after each dot, with the path's starts.
How many labels and slashes, and which lengths behind the last slash, the rules
themselves say, so a long url gives no more expressions than the list can ask for.

Expressions meet rules in an equi-join on a few digits of their digest, as long lists are
handed out by those digits alone. The whole digest confirms a match, and the longest rule
wins. Where no rule fits, words of the host judge by the same join and lower precedence.

Equal (id, url) rows are judged once and given back as often as they came: every url has
one expression that no rule meets, and its rows are counted. So no row number is needed,
and copies are added up before anything is shuffled.
"""

from pyspark.sql import functions as F

from ..session import shared_folder

PREFIX_DIGITS = 8
# Fixed by the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: The method's own judgement of hosts that no rule names: words of gambling, adult,
#: pharmacy, advertising and link-spam sites, as whole words between dots and hyphens.
BLOCKED_WORDS = (
    "ad ads adserver adult affiliate banner bet bets betting bingo casino casinos cialis clickbait doubleclick escort "
    "escorts gambling jackpot linkfarm lottery nude nudes pharmacy pill pills poker popup porn porno replica roulette "
    "sex sexy slots spam tracker tracking track viagra warez webcam webcams xxx"
).split()

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*)([^?#]*)"


def host_and_path(url):
    """Host and path expressions of a url column; null and urls without ``://`` have neither."""
    return (
        F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER),
        F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit("")),
    )


def rule_table(spark, rules, words=()):
    """(verdict, rule) pairs and blocked host words as one table of rules.

    Rules may also come as a DataFrame with columns verdict and rule. Hosts are lower-cased;
    a rule without a host fits nothing and is left out, and of equal rules a block wins.
    """
    given = rules if hasattr(rules, "select") else spark.createDataFrame(list(rules), "verdict string, rule string")
    host = F.translate(F.regexp_extract("rule", "^[^/]*", 0), UPPER, LOWER)
    path = F.regexp_extract("rule", "^[^/]*(.*)$", 1)
    named = given.where("rule is not null and verdict in ('allow', 'block')").select(
        F.concat(host, path).alias("rule"), "verdict", host.alias("host"), path.alias("path"), F.lit(0).alias("kind")
    )
    own = spark.createDataFrame([(w,) for w in words], "rule string").select(
        "rule", F.lit("block").alias("verdict"), F.col("rule").alias("host"), F.lit("").alias("path"), F.lit(1).alias("kind")
    )
    return (
        named.where("host <> ''")
        .unionByName(own)
        .groupBy("kind", "rule", "host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )


def _key(kind, expression):
    return F.sha2(F.concat(kind.cast("string"), F.lit(" "), expression).cast("binary"), 256)


def _shape(table):
    """Most labels and slashes of a rule, and the lengths that stand behind the last slash.

    A few numbers, bounded by the longest rule however many rules there are.
    """
    slashes = F.size(F.split("path", "/")) - 1
    tail = F.length(F.substring_index("path", "/", -1))
    return table.where("kind = 0").agg(
        F.coalesce(F.max(F.size(F.split("host", "[.]"))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(slashes), F.lit(0)).alias("slashes"),
        F.array_sort(F.collect_set(tail)).alias("tails"),
    ).first()


def _expressions(host, path, labels, slashes, tails):
    """Array of host-suffix and path-prefix expressions of a host and a path."""
    parts, segments = F.split(host, "[.]"), F.split(path, "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))), lambda n: F.call_function("substring_index", host, F.lit("."), -n)
    )

    def starts(depth):
        """The path up to its slash number ``depth``, and pieces of the asked lengths behind it."""
        up_to = F.when(depth == 0, F.lit("")).otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), depth), F.lit("/")))
        behind = F.get(segments, depth)
        pieces = F.array(*[F.when(F.length(behind) >= t, F.concat(up_to, F.substring(behind, 1, t))) for t in tails])
        return F.array_compact(pieces)

    depths = F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(slashes)))
    prefixes = F.array_distinct(F.flatten(F.transform(depths, starts)))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when((host != "") & F.lit(bool(tails)), both).otherwise(F.array().cast("array<string>"))


def judge_urls(pages, rules=RULES, words=BLOCKED_WORDS, id_col="page_id", url_col="url", prefix_digits=PREFIX_DIGITS):
    """page_id, host, path, rule, verdict and the blocked word, one row per row of ``pages``.

    The verdict is that of the longest fitting rule (equal lengths: the longer host, then
    block); else block if the host holds a blocked word, else allow. Null, empty and
    unparsable urls have an empty host and path and are allowed. Null ids stay, repeated
    rows stay repeated, an empty table gives no rows, and other columns are not read.
    ``rules`` may be a DataFrame of any size: a list below Spark's threshold is broadcast, a
    longer one is shuffled by the digits.
    """
    spark = pages.sparkSession
    # Stored, so that Spark knows its size when it picks the join.
    path = shared_folder(spark, "url-rules")
    rule_table(spark, rules, words).write.parquet(path)
    table = spark.read.parquet(path)
    shape = _shape(table)
    known = table.withColumn("digest", _key(F.col("kind"), F.col("rule"))).select(
        F.substring("digest", 1, prefix_digits).alias("_prefix"),
        F.col("digest").alias("_digest"),
        F.struct(
            (-F.col("kind")).alias("named"),
            F.length("rule").alias("length"),
            F.length("host").alias("host_length"),
            "verdict",
            "rule",
        ).alias("_rule"),
    )

    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    named = F.transform(
        _expressions(F.col("host"), F.col("path"), shape["labels"], shape["slashes"], shape["tails"]),
        lambda e: _key(F.lit(0), e),
    )
    spoken = F.array_remove(F.array_distinct(F.split("host", "[^a-z0-9]+")), "")
    worded = F.transform(spoken if words else F.array().cast("array<string>"), lambda w: _key(F.lit(1), w))
    # The null stands for the row itself and meets no rule.
    keys = F.concat(F.array(F.lit(None).cast("string")), named, worded)
    asked = urls.withColumn("_asked", F.explode(keys))
    met = asked.join(known, F.substring("_asked", 1, prefix_digits) == F.col("_prefix"), "left")
    confirmed = F.when(F.col("_asked") == F.col("_digest"), F.col("_rule"))
    judged = met.groupBy("page_id", "host", "path").agg(
        F.max(confirmed).alias("_rule"), F.count_if(F.col("_asked").isNull()).alias("_copies")
    )
    by_rule = F.col("_rule.named") == 0
    return judged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        "page_id",
        "host",
        "path",
        F.when(by_rule, F.col("_rule.rule")).alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.lit("allow")).alias("verdict"),
        F.when(~by_rule, F.col("_rule.rule")).alias("blocked_word"),
    )


def allowed_pages(pages, rules=RULES, words=BLOCKED_WORDS, url_col="url", prefix_digits=PREFIX_DIGITS):
    """The rows of ``pages`` whose url is allowed, with all their columns.

    The verdict hangs on host and path alone, so distinct pairs are judged and only the
    blocked ones are joined back; a null url stays.
    """
    host, path = host_and_path(F.col(url_col))
    row = pages.select(F.struct(*pages.columns).alias("row"), host.alias("_host"), path.alias("_path"))
    distinct = pages.select(F.col(url_col).alias("url"), host.alias("_h"), path.alias("_p")).dropDuplicates(["_h", "_p"])
    judged = judge_urls(distinct, rules, words, "url", "url", prefix_digits).where("verdict = 'block'")
    blocked = judged.select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    return row.join(blocked, ["_host", "_path"], "left_anti").select("row.*")
