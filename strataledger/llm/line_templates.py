"""Line dedup by a log-template tree.

A line's tokens descend a tree of fixed depth: first the token count, then the leading tokens, where tokens with a digit are variable
fields from the start. In a leaf, a token that too few of the leaf's lines have in its place is a variable field as well. What is left is the line's
template; lines whose template recurs in many texts are dropped. Copies of a whole text count once. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, staged, words

WILD = "<*>"
#: A word with a digit; the possessive parts keep the search linear.
NUMBERED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
KEY = ["key1", "key2"]
LINE = ["line1", "line2"]


def _lines(docs: DataFrame, text: str, depth: int, least: int) -> DataFrame:
    """(key1, key2, no, masked, size, leaf, line1, line2) of every line with enough tokens, written once; masked is the tokens joined by spaces."""
    t = F.col(text)
    rows = docs.where(t.isNotNull()).select(F.xxhash64(t).alias("key1"), F.xxhash64(F.lit(1), t).alias("key2"), F.posexplode(F.split(t, "\n")).alias("no", "line"))
    line = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", NUMBERED, WILD)).otherwise(F.col("line"))
    # the one-element explode keeps the filter from being pushed into, and repeating, the split
    rows = rows.select(*KEY, "no", F.explode(F.array(words(line))).alias("tokens")).where(F.size("tokens") >= least)
    leaf = F.concat_ws(" ", F.size("tokens").cast("string"), F.slice("tokens", 1, depth))
    rows = rows.select(*KEY, "no", F.array_join("tokens", " ").alias("masked"), F.size("tokens").alias("size"), leaf.alias("leaf"))
    return staged(rows.select("*", F.xxhash64("masked").alias("line1"), F.xxhash64(F.lit(1), F.col("masked")).alias("line2")))


def templates(docs: DataFrame, depth: int = 2, recurring: int = 10, constant: float = 0.6, least: int = 3, text: str = "text") -> DataFrame:
    """(line1, line2, template, n_texts) of every masked line whose template stands in ``recurring`` texts or more.

    A token is kept where at least ``recurring`` (line, text) pairs of the leaf have it in its place; a template with a smaller share of kept
    tokens than ``constant`` says too little and recurs nowhere. Lines of fewer than ``least`` tokens have no template.
    """
    return _templates(_lines(docs, text, depth, least), recurring, constant)


def _templates(lines: DataFrame, recurring: int, constant: float) -> DataFrame:
    leaves = lines.select("leaf", *KEY).distinct().groupBy("leaf").count().where(F.col("count") >= recurring)
    leaves = staged(leaves.select("leaf"))
    pairs = staged(lines.join(leaves, "leaf").select("leaf", *LINE, *KEY).distinct())  # which text has which line
    known = lines.join(leaves, "leaf").groupBy("leaf", *LINE).agg(F.first("masked").alias("masked"), F.first("size").alias("size"))
    known = staged(known.join(pairs.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n")), LINE))
    places = known.select("leaf", *LINE, "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    support = places.groupBy("leaf", "at", "token").agg(F.sum("n").alias("support")).where(F.col("support") >= recurring)
    support = staged(support)
    kept = places.join(support, ["leaf", "at", "token"]).where(F.col("token") != WILD)
    kept = kept.groupBy(*LINE).agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("kept"))
    whole = known.select("leaf", *LINE, "size").join(kept, LINE)
    whole = whole.where(F.size("kept") >= F.lit(constant) * F.col("size"))
    name = F.concat_ws(" ", "size", F.transform("kept", lambda k: F.concat_ws(":", k["at"].cast("string"), k["token"])))
    named = staged(whole.select(*LINE, name.alias("template")))
    often = pairs.join(named, LINE).select("template", *KEY).distinct().groupBy("template").agg(F.count(F.lit(1)).alias("n_texts"))
    return named.join(staged(often.where(F.col("n_texts") >= recurring)), "template").select(*LINE, "template", "n_texts")


def _generalised(docs: DataFrame, lines: DataFrame, recurring: int, constant: float, text: str) -> DataFrame:
    """(line1, line2) of every masked line of which a generalisation recurs: its j best supported tokens, for every j from the constant share on.

    A template's constant tokens have more support than the values of its fields, at every size of the corpus, so one j gives all its lines one
    name. Lines of one and two tokens are kept whole, numbers as fields. A generalisation recurs if it stands in ``recurring`` documents and in two texts at least.
    """
    t = F.col(text)
    copies = docs.where(t.isNotNull()).groupBy(F.xxhash64(t).alias("key1"), F.xxhash64(F.lit(1), t).alias("key2")).agg(F.count(F.lit(1)).alias("copies"))
    counted = lines.join(copies, KEY)
    pairs = staged(counted.groupBy("leaf", *LINE, *KEY).agg(F.first("copies").alias("copies")))
    leaves = pairs.groupBy("leaf", *KEY).agg(F.first("copies").alias("copies")).groupBy("leaf").agg(F.sum("copies").alias("n")).where(F.col("n") >= recurring)
    leaves = staged(leaves.select("leaf"))
    known = lines.join(leaves, "leaf").groupBy("leaf", *LINE).agg(F.first("masked").alias("masked"), F.first("size").alias("size"))
    known = staged(known.join(pairs.groupBy(*LINE).agg(F.sum("copies").alias("n")), LINE))
    places = known.select("leaf", *LINE, "size", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    support = staged(places.groupBy("leaf", "at", "token").agg(F.sum("n").alias("support")).where(F.col("support") >= recurring))
    fixed = places.join(support, ["leaf", "at", "token"]).where((F.col("token") != WILD) | (F.col("size") < 3))
    ranked = fixed.groupBy("leaf", *LINE, "size").agg(F.sort_array(F.collect_list(F.struct((-F.col("support")).alias("less"), "at", "token"))).alias("kept"))
    least = F.greatest(F.lit(1), F.when(F.col("size") < 3, F.col("size")).otherwise(F.ceil(F.lit(constant) * F.col("size")))).cast("int")
    ranked = ranked.where(F.size("kept") >= least)
    one = ranked.select("leaf", *LINE, "kept", F.explode(F.sequence(least, F.size("kept"))).alias("j"))
    best = F.sort_array(F.transform(F.slice("kept", 1, F.col("j")), lambda k: F.struct(k["at"], k["token"])))
    named = staged(one.select(*LINE, F.xxhash64("leaf", best).alias("name1"), F.xxhash64(F.lit(1), "leaf", best).alias("name2")))
    held = pairs.join(named, LINE).groupBy("name1", "name2", *KEY).agg(F.first("copies").alias("copies"))
    often = held.groupBy("name1", "name2").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).where((F.col("n") >= recurring) & (F.col("texts") > 1))
    return named.join(often, ["name1", "name2"]).select(*LINE).distinct()


def _flags(numbers: Column) -> Column:
    """Binary with a '1' at the place of each number of the ascending array, '0' before and between."""
    steps = F.transform(numbers, lambda x, i: F.concat(F.repeat(F.lit("0"), x - F.coalesce(F.get(numbers, i - 1), F.lit(-1)) - 1), F.lit("1")))
    return F.array_join(steps, "").cast("binary")


def drop_recurring(docs: DataFrame, depth: int = 2, recurring: int = 10, constant: float = 0.6, least: int = 3, text: str = "text", generalise: bool = False) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` is without the lines of recurring templates. Adds ``n_lines`` and ``n_dropped``.

    ``n_lines`` counts lines with a word. A text of which nothing is left is empty; null texts stay null, with 0 lines; repeated rows
    stay and are treated alike; an empty table gives an empty one. Columns named as the new ones are replaced. With ``generalise`` a line
    goes if any generalisation of it recurs, counted by documents, not texts; ``least=1`` then takes the shortest lines in.
    """
    new = ["n_lines", "n_dropped"]
    base = docs.drop(*new)
    every = _lines(docs, text, depth, least)
    bad = staged(_generalised(base, every, recurring, constant, text) if generalise else _templates(every, recurring, constant).select(*LINE))
    hits = every.select(*KEY, "no", *LINE).join(bad, LINE, "left_semi")
    drops = staged(hits.groupBy(*KEY).agg(F.sort_array(F.collect_set("no")).alias("numbers")))
    k1, k2, flags = (fresh(base, n) for n in ("_key1", "_key2", "_flags"))
    t = F.col(text)
    rows = base.withColumn(k1, F.xxhash64(t)).withColumn(k2, F.xxhash64(F.lit(1), t))
    rows = rows.join(drops.select(F.col("key1").alias(k1), F.col("key2").alias(k2), _flags(F.col("numbers")).alias(flags), F.size("numbers").alias("n_dropped")), [k1, k2], "left")
    lines = F.split(t, "\n")
    left = F.filter(lines, lambda x, i: F.coalesce(F.substring(F.col(flags), i + 1, F.lit(1)) != F.lit(b"1"), F.lit(True)))
    rows = rows.withColumn("n_lines", F.coalesce(F.size(F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)), F.lit(0)).cast("long"))
    rows = rows.withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)).cast("long"))
    clean = F.when(F.col(flags).isNull(), t).otherwise(F.array_join(left, "\n"))
    return rows.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in base.columns], *new)
