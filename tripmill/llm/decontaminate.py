"""Benchmark passages in documents, also in other case or with other numbers, names and units.

Words are compared in lower case, and as templates: a number is ``#``, a unit after a
number ``%``, a word that begins with a capital ``@``, any other word itself in lower case.
Windows of ``WINDOW`` words of the documents, as templates all and plain as many as are
enough to meet any run, are joined by hash with those of the benchmark; an item with fewer
words is one plain window, looked for at every place. A hit says
which document, which item and how far the two are shifted; only for those is the text
looked at again. A stretch of ``RUN`` words (the whole item, if shorter) is a passage if its
words are equal, or if their templates are and the values in its slots agree, that is, each
value of the item always stands for one value of the document and the other way round.

Everything is column expressions and joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.sources.staging import staged

WINDOW, RUN = 8, 13
#: Words in a window of templates that must not be slots, so that it says something.
LITERALS = 3
#: Windows of the benchmark up to which they are sent to all tasks (about 40 bytes each);
#: beyond, both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000
#: Hits in all from which a document's are dealt with in several parts.
MOST_HITS = 100_000
TOKEN = r"\p{L}+|[0-9]+(?:[.,][0-9]+)*"
#: Blocks of scripts that put no spaces between words (Thai to Khmer, Tai, kana, Han).
UNSPACED = (
    "\u0e00-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
)
#: As TOKEN, which the SQL has, but each letter of those scripts is a word.
WORD = rf"[\p{{L}}&&[{UNSPACED}]]|[\p{{L}}&&[^{UNSPACED}]]+|[0-9]+(?:[.,][0-9]+)*"
# Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres g kg mg t lb lbs oz gram"
    " grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec min h"
    " hr second seconds minute minutes hour hours day days week weeks month months year years percent degrees dollar dollars"
    " cent cents euro euros mph kmh"
).split()
SLOTS = ("#", "%", "@")


def tokens(text: Column) -> Column:
    """Words and numbers of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def template(words: Column) -> Column:
    def number(w: Column) -> Column:
        return F.substring(w, 1, 1).between("0", "9")

    def one(w: Column, i: Column) -> Column:
        first, low = F.substring(w, 1, 1), F.lower(w)
        unit = F.coalesce(number(F.get(words, i - 1)), F.lit(False)) & low.isin(UNITS)
        return F.when(number(w), "#").when(unit, "%").when(first != F.lower(first), "@").otherwise(low)

    return F.transform(words, one)


def _windows(hashes: str, length: int | Column, kind: int | Column, step: int = 1) -> Column:
    """Hash and place of every ``step``-th window of ``length`` words, of which the hashes
    are given."""
    last = F.size(hashes) - length
    places = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    hashed = F.lit(kind)
    return F.transform(
        places, lambda i: F.struct(F.xxhash64(hashed, F.slice(hashes, i + 1, length)).alias("hash"), i.alias("at"))
    )


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _lower(words: Column) -> Column:
    return F.transform(words, lambda w: F.lower(w))


def _is_slot(word: Column) -> Column:
    return word["kind"].isin(*SLOTS)


def _distinct(words: Column, *fields: str) -> Column:
    return F.size(F.array_distinct(F.transform(words, lambda w: F.struct(*[w[f].alias(f) for f in fields]))))


def _agrees(words: Column) -> Column:
    """Whether each value always stands for the same."""
    slots = F.filter(words, _is_slot)
    both = _distinct(slots, "kind", "theirs", "ours")
    return (_distinct(slots, "kind", "theirs") == both) & (_distinct(slots, "kind", "ours") == both)


def _inside(words: str, m: Column, same: Callable[[Column], Column]) -> Column:
    """Words in runs of a window or more that are the same."""
    size = F.least(F.lit(WINDOW), m)
    starts = F.filter(F.sequence(F.lit(0), m - size), lambda i: F.forall(F.slice(words, i + 1, size), same))
    places = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + size - 1))))
    return F.transform(places, lambda k: F.get(words, k))


def _passage(words: str, m: Column) -> Column:
    """Whether a stretch of ``RUN`` words, or of all if fewer, is equal, or has equal
    templates with slots that agree and a window that says something."""
    need = F.least(F.lit(RUN), m)

    def says(stretch: Column) -> Column:
        windows = F.sequence(F.lit(0), F.greatest(need - WINDOW, F.lit(0)))
        literal = lambda j: F.size(F.filter(F.slice(stretch, j + 1, WINDOW), lambda w: ~_is_slot(w))) >= LITERALS
        return F.exists(windows, literal)

    def found(start: Column) -> Column:
        stretch = F.slice(words, start + 1, need)
        alike = (m >= WINDOW) & F.forall(stretch, lambda w: w["alike"])
        return F.forall(stretch, lambda w: w["equal"]) | (alike & _agrees(stretch) & says(stretch))

    return F.exists(F.sequence(F.lit(0), m - need), found)


def _measured(words: str, m: Column) -> Column:
    """Length of the longest run of words that are equal or have equal templates, and of
    all runs of a window or more; values that differ in those."""

    def same(w: Column) -> Column:
        return w["alike"] | w["equal"]

    def longer(a: Column, w: Column) -> Column:
        now = F.when(same(w), a["now"] + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a["best"], now).alias("best"))

    longest = F.aggregate(words, F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), longer, lambda a: a["best"])
    inside = _inside(words, m, same)
    changed = F.filter(inside, lambda w: _is_slot(w) & (w["theirs"] != w["ours"]))
    return F.struct(
        longest.alias("longest_run"),
        F.size(inside).alias("matched_words"),
        m.alias("item_words"),
        _distinct(changed, "kind", "theirs", "ours").alias("changed_slots"),
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows (key, item, longest_run, matched_words, item_words, changed_slots): every item
    of which a document has a run of ``RUN`` words (or the whole item, if shorter) that are
    equal but for case, or with slots that agree. ``changed_slots`` counts the values that
    differ, 0 for a plain copy.

    Items with fewer than ``WINDOW`` words are found where all their words are equal, as
    with other values they would say too little. Documents and items with a null id or text
    are left out, and items without a word; rows that share an id count as one document,
    with the best of their runs. Empty tables give no rows; other columns are ignored.
    Counts the benchmark when called.
    """
    items = benchmark.select(F.col(item).alias("item"), tokens(F.col(item_text)).alias("item_raw"))
    items = items.withColumn("m", F.size("item_raw")).where(F.col("item").isNotNull() & (F.col("m") > 0))
    items = items.withColumn("item_tpl", template(F.col("item_raw")))
    hashed = items.select("item", "m", "item_tpl", _hashes(_lower(F.col("item_raw"))).alias("low"), _hashes(F.col("item_tpl")).alias("tpl"))
    # windows of templates are of kind 0, plain ones of the kind of their length
    length = F.least(F.lit(WINDOW), F.col("m"))
    plain = hashed.select("item", "m", length.alias("kind"), F.explode(_windows("low", length, length)).alias("w"))
    literal = F.size(F.filter(F.slice("item_tpl", F.col("w.at") + 1, WINDOW), lambda w: ~w.isin(*SLOTS)))
    like = hashed.select("item", "m", "item_tpl", F.lit(0).alias("kind"), F.explode(_windows("tpl", WINDOW, 0)).alias("w"))
    windows = plain.unionByName(like.where(literal >= LITERALS).drop("item_tpl"))
    windows = windows.select(F.col("w.hash").alias("hash"), "item", "m", "kind", F.col("w.at").alias("item_at"))
    long = F.min(F.when(F.col("m") >= WINDOW, F.col("m")))
    count, kinds, shortest = windows.agg(F.count(F.lit(1)), F.collect_set("kind"), long).first()
    windows = windows.drop("kind")
    if count <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)

    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("doc_text")).where(F.col("doc").isNotNull())
    # columns of their own, as expressions within a lambda would be worked out for every word
    templates = source.select("doc", tokens(F.col("doc_text")).alias("raw"))
    templates = templates.select("doc", _hashes(_lower(F.col("raw"))).alias("low"), _hashes(template(F.col("raw"))).alias("tpl"))
    # no plain window of the benchmark is left out, so one in each run is enough; those of
    # templates are all needed, as any of a run may be the only one that says something
    step = max(1, min(RUN, shortest or RUN) - WINDOW + 1)
    strides = {k: step if k == WINDOW else 1 for k in sorted({*kinds, WINDOW} - {0})}
    every = [*(_windows("low", k, k, n) for k, n in strides.items()), *(_windows("tpl", WINDOW, 0, 1) for k in kinds if k == 0)]
    probes = templates.select("doc", F.explode(F.concat(*every)).alias("w"))
    probes = probes.select("doc", F.col("w.hash").alias("hash"), F.col("w.at").alias("at"))
    shifted = probes.join(windows, "hash").select("doc", "item", "m", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    # written, so that their size is known: whole texts are read for a few documents only, and
    # are not shuffled for them unless the hits are too many to send to all tasks
    shifted = staged(shifted, "decontaminate-hits")
    hits = shifted.count()
    # one alignment at a time where a document has very many
    by = ["doc", F.pmod(F.xxhash64("item", "shift"), F.lit(max(1, hits // MOST_HITS))).alias("part")]
    wanted = shifted.groupBy(*by).agg(F.collect_list(F.struct("item", "m", "shift")).alias("wanted")).drop("part")
    if hits <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)

    found = source.join(wanted, "doc").select("doc", "wanted", tokens(F.col("doc_text")).alias("raw"))
    found = found.withColumn("tpl", template(F.col("raw")))

    def part(words: str, c: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), c["m"] - 1), lambda k: F.get(words, c["shift"] + k))

    beside = found.select(
        "doc",
        F.explode(
            F.transform("wanted", lambda c: F.struct(c["item"].alias("item"), part("raw", c).alias("raw"), part("tpl", c).alias("tpl")))
        ).alias("c"),
    ).select("doc", "c.*")

    def pair(k: Column) -> Column:
        ours, theirs = F.lower(F.get("raw", k)), F.lower(F.get("item_raw", k))
        return F.struct(
            F.get("item_tpl", k).alias("kind"),
            theirs.alias("theirs"),
            ours.alias("ours"),
            F.coalesce(F.get("tpl", k) == F.get("item_tpl", k), F.lit(False)).alias("alike"),
            F.coalesce(ours == theirs, F.lit(False)).alias("equal"),
        )

    m = F.col("m")
    # what a generator gives isn't worked out again for every word either
    words = F.explode(F.array(F.transform(F.sequence(F.lit(0), m - 1), pair))).alias("words")
    aligned = beside.join(items, "item").select("doc", "item", "m", words)
    best = aligned.where(_passage("words", m)).select("doc", "item", _measured("words", m).alias("best"))
    return (
        best.groupBy("doc", "item")
        .agg(F.max("best").alias("best"))
        .select(F.col("doc").alias(key), F.col("item").alias(item), "best.*")
    )


def clean(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, whatever their ids. Rows that
    agree in their text go or stay alike; null and empty texts and tables stay as they are,
    and all columns are kept, whatever their names. Takes the arguments of ``leaks`` but ``key``."""
    text = names.pop("text", "text")
    # rows with one text go or stay together, so 128 bits of the text tell them apart
    def digest() -> list[Column]:
        return [F.xxhash64(text).alias("one"), F.xxhash64(F.lit("again"), text).alias("two")]

    texts = docs.select(F.struct(*digest()).alias("digest"), F.col(text).alias("text"))
    found = leaks(texts, benchmark, "digest", "text", **names).select("digest.one", "digest.two").distinct()
    found = staged(found, "decontaminate-found")
    if found.count() <= BROADCAST_WINDOWS:
        found = F.broadcast(found)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *digest())  # no name of the caller's clashes
    return rows.join(found, ["one", "two"], "left_anti").select("row.*")
