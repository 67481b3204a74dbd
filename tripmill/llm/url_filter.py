"""URL rules by a cascade of Bloom filters, exact over the corpus and without a join.

A rule is a host and the beginning of a path. For each URL the keys that a rule could have
(a suffix of its host and a beginning of its path, of the depths and lengths that occur
among the rules) are looked up in two cascades, one of the allowing and one of the
blocking rules. Level 0 of a cascade holds the listed keys; level 1 the keys of the corpus
that level 0 takes for listed; level 2 the listed keys that level 1 takes for those; and so
on until a level makes no error. For the keys it was built over, which are all keys of the
corpus, the answer is exact. Everything is column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.staging import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of 64 bits in one level, at most: the filters travel in the plan.
MOST_WORDS = 1 << 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _until(text: Column, *marks: str) -> Column:
    for mark in marks:
        text = F.substring_index(text, mark, 1)
    return text


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#``; A-Z in lower case. Never null."""
    found = _until(_rest(url), "/", "?", "#")
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?`` or ``#``. Never null."""
    rest = _rest(url)
    after = F.substring(rest, F.length(_until(rest, "/", "?", "#")) + 1, F.length(rest))
    return F.coalesce(_until(after, "?", "#"), F.lit(""))


def candidates(host: Column, path: Column, rules) -> Column:
    """Keys a rule fitting this URL could have, each once."""
    depths = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    suffixes = [F.substring_index(host, ".", -d) for d in depths]
    beginnings = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    return F.array_distinct(F.array_compact(F.array(*[F.concat(s, b) for s in suffixes for b in beginnings])))


class Bloom:
    """One level: bits as a literal array, so a test is an expression."""

    def __init__(self, keys: DataFrame, level: int, rate: float):
        count = keys.count()
        bits = max(64, math.ceil(count * -math.log(rate) / math.log(2) ** 2))
        self.words = -(-bits // 64)
        if self.words > MOST_WORDS:
            raise ValueError(f"{count} keys need {self.words} words; MOST_WORDS allows {MOST_WORDS}")
        self.hashes = max(1, round(-math.log2(rate)))
        self.level = level
        places = keys.select(F.explode(F.array(*[self._place(F.col("key"), j) for j in range(self.hashes)])).alias("place"))
        word = F.shiftright("place", 6).alias("word")
        mask = F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))")
        filled = {r["word"]: r["mask"] for r in places.groupBy(word).agg(mask.alias("mask")).collect()}
        self._bits = F.array(*[F.lit(filled.get(i, 0)).cast("long") for i in range(self.words)])

    def _place(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(j)), F.lit(self.words * 64))

    def holds(self, key: Column) -> Column:
        test = F.lit(True)
        for j in range(self.hashes):
            place = self._place(key, j)
            word = F.element_at(self._bits, (F.shiftright(place, 6) + 1).cast("int"))
            test = test & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return test


class Cascade:
    """Exact membership of ``listed`` for every key of ``universe`` (and every listed key).

    The levels are built by jobs when the object is made. Only keys taken for listed are
    ever gathered, as tables; the first rate is chosen so that they are about as many as
    the listed keys, later levels halve.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame):
        members = listed.select("key").distinct()
        count = members.count()
        around = universe.agg(F.approx_count_distinct("key")).first()[0]  # only sets the first rate
        inside, outside = members, universe
        self.levels: list[Bloom] = []
        while count:
            rate = min(0.5, count / max(1, around)) if not self.levels else 0.5
            self.levels.append(Bloom(inside, len(self.levels), rate))
            wrong = outside.where(self.levels[-1].holds(F.col("key"))).select("key").distinct()
            if len(self.levels) == 1:
                wrong = wrong.join(F.broadcast(members) if count < 100_000 else members, "key", "left_anti")
            wrong = staged(wrong, "cascade")
            inside, outside, count = wrong, inside, wrong.count()

    def lists(self, key: Column) -> Column:
        """Whether ``key`` is listed: the first level that doesn't hold it decides."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].holds(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def _keys(spark: SparkSession, keys: list[str]) -> DataFrame:
    empty = F.array().cast("array<string>")
    return spark.range(1).select(F.explode(F.array(*map(F.lit, keys)) if keys else empty).alias("key"))


def judge(
    pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """Rows (key, host, path, rule, verdict) for every URL.

    The longest fitting rule decides, of equally long ones that with the longer host; with
    none the rule is null and the verdict ``otherwise`` (a list that doesn't name a URL
    lets it pass). A null URL and one without ``://`` have an empty host and path, which
    no rule fits. Rows are kept as they are, repeated and null keys included; other columns
    are ignored. Runs jobs when called, over the URLs alone.
    """
    spark = pages.sparkSession
    parted = pages.select(F.col(key).alias("_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    keyed = parted.withColumn("_keys", candidates(F.col("host"), F.col("path"), rules) if rules else F.array().cast("array<string>"))
    universe = keyed.select(F.explode("_keys").alias("key"))
    listed = {v: [r.key for r in rules if r.verdict == v] for v in ("allow", "block")}
    cascades = {v: Cascade(_keys(spark, keys), universe) for v, keys in listed.items()}

    def member(verdict: str):
        return lambda k: F.when(
            cascades[verdict].lists(k),
            F.struct(
                F.length(k).alias("length"), F.locate("/", k).alias("host"), k.alias("rule"), F.lit(verdict).alias("verdict")
            ),
        )

    fitting = F.array_max(F.array_compact(F.concat(*[F.transform("_keys", member(v)) for v in cascades])))
    return keyed.withColumn("_fit", fitting).select(
        F.col("_key").alias(key),
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", F.lit(otherwise)).alias("verdict"),
    )
