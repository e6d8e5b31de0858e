"""One person under several names or addresses: what can be merged, and what people must look at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DISTANCE, LEAST_LENGTH = 2, 4
#: Names up to this length meet by what is left when letters are taken out, longer ones by thirds.
SHORT = 14


def authors(commits: DataFrame) -> DataFrame:
    """(name, email, norm, n) of commits (name, email): addresses lower-cased, names reduced to letters and digits."""
    a = commits.select(F.trim("name").alias("name"), F.lower(F.trim("email")).alias("email")).where("email != ''")
    return a.groupBy("name", "email").agg(F.count("*").alias("n")).withColumn("norm", F.regexp_replace(F.lower(F.coalesce("name", F.lit(""))), "[^a-z0-9]", ""))


def shared_addresses(who: DataFrame) -> DataFrame:
    """(email, names, n): addresses of several names, which are safe to merge."""
    return who.groupBy("email").agg(F.array_sort(F.collect_set("name")).alias("names"), F.sum("n").alias("n")).where(F.size("names") > 1)


def shared_names(who: DataFrame) -> DataFrame:
    """(norm, emails, n): reduced names with several addresses, to be looked at before merging."""
    return who.where("norm != ''").groupBy("norm").agg(F.array_sort(F.collect_set("email")).alias("emails"), F.sum("n").alias("n")).where(F.size("emails") > 1)


def _left_overs(names: DataFrame, name: str) -> DataFrame:
    """(name, key): a hash of each name and of all that is left of it without one letter or two: names
    within two edits share one of these. A row's letters i < j are taken out, where places past the end
    hold none, and of a run of one letter its first are; letter by letter in rows, as arrays of arrays of strings would be built outside compiled code."""
    n = F.length("s")
    rows = names.select("s", F.explode(F.sequence(F.lit(1), n + 1)).alias("i"))
    rows = rows.select("s", "i", F.explode(F.sequence(F.col("i") + 1, F.greatest(n + 1, F.col("i") + 1))).alias("j"))
    cut = lambda at, size: F.substring("s", at, size)
    first = lambda at: cut(F.col(at), F.lit(1)) != cut(F.col(at) - 1, F.lit(1))
    rows = rows.where(((F.col("i") == 1) | first("i")) & ((F.col("j") == F.col("i") + 1) | first("j")))
    left = F.concat(cut(F.lit(1), F.col("i") - 1), cut(F.col("i") + 1, F.col("j") - F.col("i") - 1), cut(F.col("j") + 1, n))
    return rows.select(F.col("s").alias(name), F.xxhash64(left).alias("key"))


def _places(names: DataFrame, name: str, less: int, shift: int) -> DataFrame:
    """(name, key): a hash of the thirds of names that are up to ``less`` letters shorter, or as long, with
    their length and index, wherever within ``shift`` letters they may lie in this one. With 0 and 0 a name's
    own thirds: two edits leave one of them whole."""
    n, span = F.length("s"), 2 * shift + 1
    rows = names.select("s", F.explode(F.sequence(F.lit(0), F.lit(3 * span * (less + 1) - 1))).alias("x"))
    rows = rows.select("s", (n - F.floor(F.col("x") / (3 * span)).cast("int")).alias("m"), F.floor(F.col("x") % (3 * span) / span).cast("int").alias("k"), (F.col("x") % span - shift).alias("by"))
    cut = lambda k: F.floor(F.col("m") * k / 3).cast("int")
    rows = rows.select("s", "m", "k", (cut(F.col("k")) + F.col("by")).alias("at"), (cut(F.col("k") + 1) - cut(F.col("k"))).alias("size"))
    rows = rows.where((F.col("at") >= 0) & (F.col("at") + F.col("size") <= n))
    return rows.select(F.col("s").alias(name), F.xxhash64("m", "k", F.substring("s", F.col("at") + 1, F.col("size"))).alias("key"))


def near_names(who: DataFrame) -> DataFrame:
    """(a, b, distance), a < b: reduced names of four letters or more within two edits, of people who share no address.

    Exact without comparing all pairs: names meet by a key that any two within
    the distance share, and the edit distance decides. What is joined is a name
    once, however often it occurs; joins are sorted shuffles, as Spark takes the keys, up to
    137 a name, for as small as the names and would broadcast them. Short names share keys with many: their number
    is bounded by the alphabet (at most 36^4 names of four letters). Pairs that share an address
    are one person by ``shared_addresses``.
    """
    names = who.where(F.length("norm") >= LEAST_LENGTH).select(F.col("norm").alias("s")).distinct()
    near = F.levenshtein("a", "b", DISTANCE).between(1, DISTANCE)

    short = names.where(F.length("s") <= SHORT + DISTANCE)
    pairs = _left_overs(short, "a").join(_left_overs(short, "b").hint("merge"), "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    long = names.where(F.length("s") > SHORT)
    met = _places(long, "a", 0, 0).join(_places(long, "b", DISTANCE, DISTANCE).hint("merge"), "key").where(near)
    pairs = pairs.union(met.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    mail = who.select("norm", "email").distinct().hint("merge")
    both = pairs.join(mail.withColumnsRenamed({"norm": "a"}), "a").join(mail.withColumnsRenamed({"norm": "b"}).withColumn("shared", F.lit(True)), ["b", "email"], "left")
    apart = both.groupBy("a", "b").agg(F.count("shared").alias("n")).where("n = 0")
    return apart.select("a", "b", F.levenshtein("a", "b").alias("distance"))


def collisions(commits: DataFrame) -> DataFrame:
    """(kind, entity, members, n): all three kinds in one relation; members are in order. Rows without an address are left out."""
    who = authors(commits)
    same = shared_addresses(who).select(F.lit("same address").alias("kind"), F.col("email").alias("entity"), F.array_join("names", ";").alias("members"), "n")
    names = shared_names(who).select(F.lit("same name"), "norm", F.array_join("emails", ";"), "n")
    near = near_names(who).select(F.lit("near names"), "a", F.col("b"), F.col("distance").cast("long"))
    return same.union(names).union(near)
