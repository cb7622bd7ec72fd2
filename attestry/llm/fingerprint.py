"""Document fingerprints by consistent weighted sampling, in DataFrame operations alone.

A text is a weighted set: its words with how often each occurs. Slot k of its fingerprint is
the word and level that ICWS (improved consistent weighted sampling) samples for it: with
r, c ~ Gamma(2, 1) and b ~ U(0, 1) drawn from a hash of the word and k alone,

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b + 1),

and the slot takes (word, t) of the least a. Two texts agree in a slot with a probability
equal to their generalised Jaccard similarity, sum of min(w, w') over sum of max(w, w').

Words of a text and of its edited form are counted together, so that the draws for a word
serve both. All of this happens in the partition that holds the text: texts are dealt once,
by ranges of ids between quantiles, and every later grouping is by range and row.

A likeness is a share of ``SLOTS`` slots: its standard error is sqrt(p (1 - p) / SLOTS), 0.1 at
a half.

Defined cases: a null text counts as empty; an empty text has empty slots, which agree with
each other only; a null id comes after all others; rows that repeat are documents of their
own, next to each other, and rows of one id follow each other by a hash of the text; a sole
document is its own next; texts of any length are taken whole; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestry.llm.spark import cut, few_ids

SLOTS = 24
#: Code points of text in a partition, in the mean, and the most partitions: beyond 400 GB of
#: text partitions grow, to 1 GB each at 100 TB, as a shuffle of more is not to be had.
PART_CHARS, MOST_PARTS = 4_000_000, 100_000
#: Most quantiles of the ids that bound their ranges; wider ones are cut to equal widths.
KNOTS, CHUNK = 8192, 90
_SPACES = r"[\x20\x09-\x0D]+"
_BITS = 21


def _uniform(bits: Column, at: int) -> Column:
    """One of three draws of 21 bits from a 64-bit hash, inside (0, 1)."""
    part = F.shiftrightunsigned(bits, _BITS * at).bitwiseAND((1 << _BITS) - 1)
    return (part.cast("double") + 0.5) / float(1 << _BITS)


def sample(word: Column, weight: Column, slot: int) -> Column:
    """ln a and the sampled (word, t) in one long whose least value is the slot's sample."""
    first, second = F.xxhash64(word, F.lit(2 * slot)), F.xxhash64(word, F.lit(2 * slot + 1))
    r = -F.ln(_uniform(first, 0) * _uniform(first, 1))
    ln_c = F.ln(-F.ln(_uniform(second, 0) * _uniform(second, 1)))
    b = _uniform(first, 2)
    t = F.floor(F.ln(weight) / r + b)
    ln_a = ln_c - r * (t - b + 1)
    rank = F.floor((ln_a + 128) * float(1 << 31))  # ln a is above -128 and below 128
    return F.shiftleft(rank, 24).bitwiseOR(F.xxhash64(word, t, F.lit(slot)).bitwiseAND(0xFFFFFF))


def _slots(prefix: str) -> Column:
    """Slot values of a row of least samples; -1 where the text has no word."""
    return F.array(*(F.coalesce(F.col(f"{prefix}{k}").bitwiseAND(0xFFFFFF), F.lit(-1)).cast("int") for k in range(SLOTS)))


def likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(SLOTS))


def _hex(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda x: F.when(x < 0, "------").otherwise(F.lpad(F.hex(x.cast("long")), 6, "0"))), "")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def _range_of(rows: DataFrame, many: int) -> Column:
    """The range of (at, tie) that a row is in, one of about ``many``; greater ones come later.

    Ranges lie between quantiles of ``at``. An id that spans several quantiles has as many
    ranges, by ``tie``, so rows without an id are spread too.
    """
    knots = min(KNOTS, many)
    fractions = F.array(*(F.lit(k / knots) for k in range(1, knots))) if knots > 1 else F.array(F.lit(0.5))
    found = rows.agg(F.percentile_approx("at", fractions, 20 * knots).alias("q")).first()["q"]
    if not found:
        return F.coalesce(F.col("at") * 0, F.lit(0)).cast("long")
    found = sorted(found)
    chunks = [found[k : k + CHUNK] for k in range(0, len(found), CHUNK)]
    held = F.from_json(F.lit(json.dumps(chunks)), "array<array<bigint>>")
    most = F.from_json(F.lit(json.dumps([c[-1] for c in chunks])), "array<bigint>")
    at = F.col("at")

    def count(below: Callable[[Column], Column]) -> Column:
        """Quantiles for which ``below`` holds; it holds for the first ones only."""
        chunk = F.size(F.filter(most, below))
        inside = F.size(F.filter(F.coalesce(F.get(held, chunk), F.array().cast("array<bigint>")), below))
        return F.least(chunk * CHUNK + inside, F.lit(len(found)))

    less, upto = count(lambda x: x < at), count(lambda x: x <= at)
    tie = F.floor((F.col("tie") / float(1 << 64) + 0.5) * (upto - less))
    wide = -(-many // knots)
    if wide == 1:
        return (less + tie).cast("long")
    flat = F.from_json(F.lit(json.dumps(found)), "array<bigint>")
    low, high = F.get(flat, upto - 1).cast("double"), F.get(flat, upto).cast("double")
    inside = F.when(less == upto, F.least(F.lit(wide - 1), F.floor((at - low) / (high - low) * wide)))
    return ((less + tie) * wide + F.coalesce(inside, F.lit(wide - 1))).cast("long")


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    """Rows with their range of ids, the order of the ranges, partitions, and the text after each range."""
    least = F.lit(-(1 << 63))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), least).alias("at"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, 1 + chars // PART_CHARS)
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # never NULL, so no filter tells the branches apart and texts are dealt once for both
    rows = rows.withColumn("span", F.coalesce(_range_of(rows, 4 * parts), F.lit(0).cast("long")))
    # ranges that have rows, and the range whose first row follows the last of each
    heads = rows.groupBy("span").agg(F.max(F.struct("at", F.col("tie"))).alias("head"))
    every = Window.orderBy(F.desc("span"))
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = cut(heads.select("span", "head", F.coalesce(F.lead("span").over(every), F.first("span").over(whole)).alias("then")))
    few = few_ids(order)
    head = order.select("span", F.col("head.at").alias("at"), F.col("head.tie").alias("tie"))
    # text of each range's first row; rows that repeat have one text
    head_text = rows.select("span", "at", "tie", "text").join(F.broadcast(head) if few else head, ["span", "at", "tie"]).dropDuplicates(["span"])
    after = order.select(F.col("span"), F.col("then")).join(head_text.select(F.col("span").alias("then"), F.col("text").alias("head_text")), "then").drop("then")
    return rows, order.select("span", "then"), parts, after


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_chars, edited_text's sha, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows, order, parts, after = _in_order(docs, id_col, text_col)
    placed = Window.partitionBy("span").orderBy(F.desc("at"), F.desc("tie"))
    # both branches below need the same four columns, so that texts are dealt once for both
    dealt = rows.select("span", "id", "tie", "text").repartition(parts, "span")
    dealt = dealt.withColumn("at", F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63))))
    dealt = dealt.withColumns({"row": F.row_number().over(placed), "following": F.lead("text").over(placed)})
    ends = dealt.join(after, "span", "left")
    base = ends.select("span", "row", "id", "text", edited_text(F.col("text"), F.coalesce("following", "head_text")).alias("edited"))
    info = base.select("span", "row", "id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    both = F.explode(F.array(F.struct(F.lit(1).alias("own"), F.col("text").alias("text")), F.struct(F.lit(0).alias("own"), F.col("edited").alias("text"))))
    words = base.select("span", "row", both.alias("of")).select("span", "row", "of.own", F.explode(F.split("of.text", _SPACES)).alias("word"))
    words = words.where("word <> ''").select("span", "row", "own", F.xxhash64("word").alias("word"))
    counts = words.groupBy("span", "row", "word").agg(F.sum("own").alias("w"), F.sum(1 - F.col("own")).alias("e"))
    least = []
    for k in range(SLOTS):
        for weight in ("w", "e"):
            least.append(F.min(F.when(F.col(weight) > 0, sample(F.col("word"), F.col(weight), k))).alias(f"{weight}{k}"))
    prints = counts.groupBy("span", "row").agg(*least)
    found = info.join(prints, ["span", "row"], "left").select("span", "row", "id", "n_chars", "edited_sha256", _slots("w").alias("own"), _slots("e").alias("other"))
    found = cut(found)
    head = found.where("row = 1").select(F.col("span").alias("then"), F.col("own").alias("head_own"))
    head = order.join(head, "then").drop("then")
    following = F.lead("own").over(Window.partitionBy("span").orderBy("row"))
    out = found.withColumn("following", following).join(head, "span", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        _hex(F.col("own")).alias("fingerprint"),
        _hex(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("following", "head_own")).alias("near_next"),
    )
