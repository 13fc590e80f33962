"""Duplicates hidden by formatting differences.

Method: each address is reduced to a canonical key, kept as two 64-bit hashes. Partial counts of the keys (map-side combined) tell exactly
which keys are hot: there are at most `MAX_HOT` of them, as a key is hot from rows / `MAX_HOT` rows on at least, so they are broadcast. Rows of hot keys are
salted into a two-level aggregation, all others take one shuffle. The representative of a group is its smallest identifier.
Every row then learns its group's representative, and the pairs are those of the rows with one representative: of small groups by a
join on it, of large ones by a join that is salted on one side and replicated on the other.

Defined results: a null or blank canonical address falls back to the plain one; where both are null or blank the row is a
group of its own (no two missing addresses are the same); an empty table gives no groups; repeated rows of one identifier
count as copies but never pair with themselves; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed

MAX_HOT = 10_000

# Query fields that only track the reader.
TRACKING = ("source", "ref", "fbclid", "gclid", "mc_cid", "mc_eid", "yptr")
TRACKING_PREFIX = "utm_"

_UNQUOTE = 2  # an escaped percent sign may hide a second escape


def _decoded(c: Column) -> Column:
    """Percent escapes undone where they are valid; `+` is kept, as it is punctuation for the key."""
    for _ in range(_UNQUOTE):
        c = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return c


def _letters(c: Column) -> Column:
    """Letters and digits alone, in lower case."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", "")


def address_key(url_canonical: Column, url: Column) -> Column:
    """Canonical key of an address: null when both spellings are missing."""
    blank = r"^[\s ]*$"
    raw = F.when(url_canonical.isNull() | url_canonical.rlike(blank), url).otherwise(url_canonical)
    raw = F.when(raw.rlike(blank), None).otherwise(raw)
    bare = F.split_part(F.regexp_replace(raw, r"[\s ]+", ""), F.lit("#"), F.lit(1))
    bare = F.regexp_replace(bare, r"^[^\p{L}\p{N}]+", "")
    bare = F.regexp_replace(F.lower(bare), r"^(?:[a-z][a-z0-9+.\-]*:)?/*(?:www\.)?", "")
    place, query = F.split_part(bare, F.lit("?"), F.lit(1)), F.regexp_replace(bare, r"^[^?]*\??", "")
    fields = F.transform(F.split(query, "[&;]"), lambda f: F.struct(_letters_keeping_underscore(_decoded(F.split_part(f, F.lit("="), F.lit(1)))).alias("k"), _letters(_decoded(F.regexp_replace(f, r"^[^=]*=?", ""))).alias("v")))
    kept = F.filter(fields, lambda f: (f["v"] != "") & ~f["k"].isin(*TRACKING) & ~f["k"].startswith(TRACKING_PREFIX))
    words = F.array_sort(F.transform(kept, lambda f: F.concat(_letters(f["k"]), F.lit("="), f["v"])))
    return F.concat(_letters(_decoded(place)), F.lit("?"), F.array_join(words, "&"))


def _letters_keeping_underscore(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}_]+", "")


def keyed(df: DataFrame, *, id_col: str = "id", canonical_col: str = "url_canonical", url_col: str = "url") -> DataFrame:
    """(id, h, g): two independent 64-bit hashes of the key; rows without an address get a key of their own."""
    rows = df.select(F.col(id_col).alias("id"), address_key(F.col(canonical_col), F.col(url_col)).alias("key"))
    key = F.coalesce("key", F.concat(F.lit("\u0000"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    return rows.select("id", key.alias("key")).select("id", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(7), F.col("key")).alias("g"))


def marked(rows: DataFrame, hot: int) -> DataFrame:
    """The keyed rows with `is_hot`: whether their key has more than `hot` rows (or rows / `MAX_HOT`, if that is more).

    The hot keys are at most `MAX_HOT` rows of two numbers, so their broadcast is bounded whatever the table's size.
    """
    least = max(hot, rows.count() // MAX_HOT)
    keys = rows.groupBy("h", "g").agg(F.count("*").alias("n")).filter(F.col("n") > least).select("h", "g", F.lit(True).alias("is_hot"))
    return rows.join(F.broadcast(keys), ["h", "g"], "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False)))


def grouped(rows: DataFrame, salts: int) -> DataFrame:
    """(h, g, id, copies, is_hot) of each key of marked rows: its smallest identifier and its number of rows. Hot keys go through two levels, first by (key, salt)."""
    least, many = F.min("id").alias("id"), F.count("*").alias("copies")
    cold = rows.filter(~F.col("is_hot")).groupBy("h", "g").agg(least, many).withColumn("is_hot", F.lit(False))
    level = rows.filter("is_hot").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts))).groupBy("h", "g", "salt").agg(least, many)
    warm = level.groupBy("h", "g").agg(least, F.sum("copies").alias("copies")).withColumn("is_hot", F.lit(True))
    return cold.unionByName(warm)


def _keyed_once(df: DataFrame, columns: dict) -> DataFrame:
    """The keyed rows, written once: three numbers a row, where the key itself costs many string functions."""
    return checkpointed(keyed(df, **columns))


def collapse(df: DataFrame, *, hot: int = 100_000, salts: int = 64, **columns: str) -> DataFrame:
    """(id, copies): one row per address with its smallest identifier and its number of rows."""
    return grouped(marked(_keyed_once(df, columns), hot), salts).select("id", "copies")


def membership(df: DataFrame, *, hot: int = 100_000, salts: int = 64, **columns: str) -> DataFrame:
    """(id, rep_id, n): each row's group, named by the group's smallest identifier, and the group's number of rows.

    Rows of hot keys meet their representatives (at most `MAX_HOT`) by a broadcast, so that no shuffle brings them together.
    """
    rows = marked(_keyed_once(df, columns), hot)
    groups = grouped(rows, salts).select("h", "g", F.col("id").alias("rep_id"), F.col("copies").alias("n"), "is_hot")
    cold = rows.filter(~F.col("is_hot")).join(groups.filter(~F.col("is_hot")).drop("is_hot"), ["h", "g"])
    warm = rows.filter("is_hot").join(F.broadcast(groups.filter("is_hot").drop("is_hot")), ["h", "g"])
    return cold.select("id", "rep_id", "n").unionByName(warm.select("id", "rep_id", "n"))


def matches(df: DataFrame, *, hot: int = 1_000, salts: int = 64, **columns: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of every two rows with the same representative; a pair may come more than once where ids repeat.

    Groups of one row take no part. Groups of more than `hot` rows have one side of the join salted and the other replicated over
    the salts, in as many partitions as salts, which the adaptive planner doesn't merge as it would by bytes; such a group has more than
    hot / 2 pairs for each of its rows, so the copies are few beside them. The others take a one-level join.
    """
    some = membership(df, hot=hot, salts=salts, **columns).filter(F.col("n") > 1)

    def joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        return a.withColumnRenamed("id", "id_a").join(b.withColumnRenamed("id", "id_b"), on).filter(F.col("id_a") < F.col("id_b")).select("id_a", "id_b")

    cold, warm = (some.filter(c).drop("n") for c in (F.col("n") <= hot, F.col("n") > hot))
    on = ["rep_id", "salt"]
    salted = warm.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).repartition(salts, *on)
    copied = warm.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).repartition(salts, *on)
    return joined(cold, cold, ["rep_id"]).unionByName(joined(salted, copied, on))


def pairs(df: DataFrame, *, hot: int = 1_000, salts: int = 64, **columns: str) -> DataFrame:
    """`matches`, each pair once."""
    return matches(df, hot=hot, salts=salts, **columns).distinct()
