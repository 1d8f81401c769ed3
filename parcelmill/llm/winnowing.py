"""Winnowing: rolling k-gram hashes, and the rightmost minimum of each window with its position.

Every step is a DataFrame function. A text is cut into units: runs of characters other than the six ASCII
white-space ones, lower-cased; in scripts that set no blanks each character is a unit. A unit hashes to the first
60 bits of its MD5. The hash of k units in a row is their cyclic polynomial (rotate by one, then XOR the next unit),
built by doubling: two neighbouring hashes of m units give one of 2m. Window minima are built by doubling too.

Match guarantee: an equal stretch of `GRAM + WINDOW - 1` units (20) in two texts puts at least one equal hash into
both fingerprints; none is shorter than `GRAM` units, but for texts that are shorter as a whole.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 5, 16
BITS = 60
#: Thai and Lao, Burmese, Khmer, kana, Han.
ALONE = "\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\U00020000-\U0003FFFF"
UNIT = rf"[{ALONE}]|[^\x20\x09-\x0D{ALONE}]+"
#: Buckets of neighbouring rows for each shuffle partition, and the most that are made: the bound of all that meets on the driver.
BUCKETS_PER_PARTITION, MOST_BUCKETS = 8, 8192


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _rotated(x: Column, by: int) -> Column:
    by %= BITS
    low = F.shiftleft(x.bitwiseAND(F.lit((1 << (BITS - by)) - 1)), by)
    return low.bitwiseOR(F.shiftrightunsigned(x, BITS - by)) if by else x


def _joined(left: Column, right: Column, shift: int, combine: Callable[[Column, Column], Column]) -> Column:
    """combine(left[i], right[i + shift]) for each i; what lies past the end of `right` is null. `right` must be computed already."""
    return F.transform(left, lambda x, i: combine(x, F.get(right, i + shift)))


def unit_hashes(text: Column) -> Column:
    units = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(UNIT), 0)
    return F.transform(units, lambda u: F.conv(F.substring(F.md5(u.cast("binary")), 1, BITS // 4), 16, 10).cast("long"))


def gram_hashes(hashes: Column, k: int = GRAM) -> Column:
    """Hash of each k units in a row; of all units, where there are fewer."""

    def after(width: int) -> Callable[[Column, Column], Column]:
        """Hash of what `a` hashes and then the `width` units that `b` hashes."""
        return lambda a, b: _rotated(a, width).bitwiseXOR(b)

    def grown(doubled: Column, m: int, done: Column | None, width: int) -> Column:
        """`doubled`: hashes of m units; `done`: of `width` units, what lower bits of k have given."""
        if k & m:
            done = doubled if done is None else _joined(doubled, done, m, after(width))
            width += m
        if 2 * m > k:
            return done
        twice = _joined(doubled, doubled, m, after(m))
        if done is None:
            return _let(twice, lambda d: grown(d, 2 * m, None, 0))
        return _let(done, lambda kept: _let(twice, lambda d: grown(d, 2 * m, kept, width)))

    whole = F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, x: _rotated(acc, 1).bitwiseXOR(x))
    every = F.slice(grown(hashes, 1, None, 0), F.lit(1), F.size(hashes) - (k - 1))  # the others reach past the end
    return F.when(F.size(hashes) >= k, every).when(F.size(hashes) > 0, F.array(whole)).otherwise(hashes)


def minimum_places(grams: Column, window: int = WINDOW) -> Column:
    """Places (from 0) of the rightmost minimum of each window, ascending, once each; with fewer grams, of all of them."""

    def smaller(a: Column, b: Column) -> Column:
        return F.when(F.get(grams, a) < F.get(grams, b), a).otherwise(b)

    def grown(places: Column, m: int) -> Column:
        if m == window:
            return F.array_distinct(F.slice(places, F.lit(1), F.size(grams) - (window - 1)))  # the others reach past the end
        step = min(m, window - m)
        return _let(_joined(places, places, step, smaller), lambda p: grown(p, m + step))

    every = F.sequence(F.lit(0), F.size(grams) - 1)
    few = F.array(F.size(grams) - F.array_position(F.reverse(grams), F.array_min(grams)).cast("int"))
    return F.when(F.size(grams) >= window, _let(every, lambda e: grown(e, 1))).when(F.size(grams) > 0, few).otherwise(F.array().cast("array<int>"))


def fingerprint(text: Column, k: int = GRAM, window: int = WINDOW) -> Column:
    """Array of (place of the gram's first unit, hash), by place. A null text is empty and gives none."""
    return _let(
        unit_hashes(text),
        lambda h: _let(
            gram_hashes(h, k),
            lambda g: F.transform(minimum_places(g, window), lambda p: F.struct(p.alias("place"), F.get(g, p).alias("hash"))),
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes of two fingerprints; 1 if both are empty."""
    both = F.size(F.array_intersect(a["hash"], b["hash"]))
    either = F.size(F.array_union(a["hash"], b["hash"]))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(print_: Column) -> Column:
    """`place:hash` of each entry, the hash in 15 hex digits."""
    entry = lambda e: F.concat(e["place"].cast("string"), F.lit(":"), F.lower(F.lpad(F.hex(e["hash"]), 15, "0")))
    return F.array_join(F.transform(print_, entry), " ")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row. Null texts are empty; repeated rows stay; no shuffle; other columns are ignored."""
    return docs.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


def beside_next(docs: DataFrame, values: dict[str, Column]) -> DataFrame:
    """`values` of every row, and as `next_…` those of the next row by descending doc_id; the first row follows the last.

    A null id comes last; rows of one id are ordered by a hash of their text, then by the text. Rows move once, to
    buckets of neighbours: quantiles of the id, and parts of the hash for an id that fills a bucket by itself. The
    first row of a bucket also goes to the bucket before it, as a guest.
    """
    tie = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    buckets = min(MOST_BUCKETS, BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.select(F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 10 * buckets)).first()[0] or []
    bounds = sorted(set(cuts))
    hot = sorted({c for c, d in zip(cuts, cuts[1:]) if c == d})

    step = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))]) if bounds else F.array().cast("array<int>")
    edges = F.lit(bounds).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    below = F.aggregate(
        step,
        F.lit(0),
        lambda at, by: F.when((at + by <= len(bounds)) & (F.try_element_at(edges, at + by) <= F.col("_id")), at + by).otherwise(at),
    )  # how many bounds are at or below the id, by halving
    crowded = F.col("_id").isNull() | F.col("_id").isin(hot)
    part = F.when(crowded, F.shiftright(F.col("_tie"), 55)).otherwise(F.lit(0).cast("long"))
    bucket = F.struct(F.when(F.col("_id").isNull(), 1).otherwise(-below).alias("at"), part.alias("part"))
    keys = [F.col("doc_id").cast("long").alias("_id"), tie.alias("_tie")]
    placed = docs.select(*keys, "text", *[v.alias(k) for k, v in values.items()]).withColumn("_bucket", bucket)
    ids = docs.select(*keys).withColumn("_bucket", bucket)
    order = [F.col("_id").desc_nulls_last(), F.col("_tie")]
    first = F.min(F.struct(F.bitwise_not("_id").alias("down"), F.col("_tie").alias("tie")))
    rounds = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (
        ids.groupBy("_bucket").agg(first.alias("first"))
        .select(
            F.col("_bucket").alias("_of"),
            "first",
            F.coalesce(F.lag("_bucket").over(Window.orderBy("_bucket")), F.last("_bucket").over(rounds)).alias("_before"),
        )
    )  # at most MOST_BUCKETS + 256 * (buckets that one id fills) rows of fixed size
    joined = placed.join(F.broadcast(firsts), placed["_bucket"] == firsts["_of"])
    is_first = F.bitwise_not("_id").eqNullSafe(F.col("first.down")) & (F.col("_tie") == F.col("first.tie"))
    own, guest = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest")), F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))).alias("_seat")
    seated = joined.select("_id", "_tie", "text", *values, seats)
    following = Window.partitionBy("_seat.bucket").orderBy("_seat.guest", *order, "text")
    return (
        seated.select("_id", "text", *values, "_seat", *[F.lead(k).over(following).alias(f"next_{k}") for k in ("text", *values)])
        .filter(~F.col("_seat.guest"))
        .select(F.col("_id").alias("doc_id"), "text", *values, "next_text", *[f"next_{k}" for k in values])
    )


def edited_documents(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text and of the next document.

    The edited text has the next document's first floor(n_chars / 3) code points (or all) in place of its own last
    ones. Columns: doc_id, text (null: empty), n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.
    Repeated rows stay, each with its own next row; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = beside_next(texts, {"fingerprint": fingerprint(F.col("text"))})
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).select("*", edited.alias("edited"))
    return rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"))).select(
        "doc_id", "text", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
