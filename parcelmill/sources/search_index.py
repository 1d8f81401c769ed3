"""Search index over records: postings of words, and of the three-character pieces of text fields with their places.

A posting names a record by its key. Postings lie in parts by a hash of their term, sorted by term, so a search reads
the parts of its terms alone. A part is written by several tasks, dealt by record, so that a term which very many
records have is not one task's work. Searches answer from postings: no record is read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS, SALTS = 64, 8
GRAM = 3
#: Stands after the last character, so that a piece begins at every character.
END = "\u0000"


def _part(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(PARTS)).cast("int")


def _write(postings: DataFrame, path: str) -> None:
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    dealt = postings.withColumn("part", _part(F.col("term"))).repartition(F.col("part"), salt)
    dealt.sortWithinPartitions("part", "term").write.partitionBy("part").parquet(path)


def build_word_index(records: DataFrame, key: str, columns: list[Column], path: str) -> None:
    """Postings of the distinct words (runs of a-z and 0-9, lower-cased) of the columns. `key` tells records apart."""
    words = F.array_distinct(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^a-z0-9]+"))
    _write(records.select(F.col(key).alias("key"), F.explode(words).alias("term")).filter("term <> ''"), path)


def build_text_index(records: DataFrame, key: str, columns: list[Column], path: str) -> None:
    """Postings (term, key, field, place) of the pieces of each column, lower-cased; an absent text has none."""
    texts = F.array(*[F.struct(F.lit(i).alias("field"), F.lower(F.coalesce(c, F.lit(""))).alias("text")) for i, c in enumerate(columns)])
    rows = records.select(F.col(key).alias("key"), F.inline(texts)).filter("text <> ''")
    signs = F.split(F.concat("text", F.lit(END * (GRAM - 1))), "")
    places = F.sequence(F.lit(0), F.length("text") - 1)
    # inside a lambda over one element, so that the text is cut into characters once
    pieces = F.flatten(F.transform(F.array(signs), lambda c: F.transform(places, lambda i: F.array_join(F.slice(c, i + 1, GRAM), ""))))
    _write(rows.select("key", "field", F.posexplode(pieces).alias("place", "term")), path)


def _postings(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    wanted = F.lit(False)
    for t in terms:
        wanted = wanted | ((F.col("part") == _part(F.lit(t))) & (F.col("term") == t))
    return spark.read.parquet(path).filter(wanted)


def word_search(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """(key, score): records with at least one of the words, and how many of them they have."""
    wanted = sorted({t.lower() for t in terms if t})
    return _postings(spark, path, wanted).groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("score"))


def containing(spark: SparkSession, path: str, term: str) -> DataFrame | None:
    """(key): records with the term in one of the fields, whatever the case; None if it is blank, which all have.

    A term of three characters or more is found where its pieces stand at places that fit: such a place is a hit, no text
    has to be looked at. A shorter one is the beginning of a piece; all parts are asked for it, which the sorting narrows.
    """
    needle = term.strip().lower()
    if not needle:
        return None
    if len(needle) < GRAM:
        return spark.read.parquet(path).filter(F.col("term").startswith(needle)).select("key").distinct()
    offsets: dict[str, list[int]] = {}
    for i in range(len(needle) - GRAM + 1):
        offsets.setdefault(needle[i : i + GRAM], []).append(i)
    found = _postings(spark, path, list(offsets))
    at = F.create_map(*[x for t, where in offsets.items() for x in (F.lit(t), F.array(*map(F.lit, where)))])
    starts = found.select("key", "field", "place", F.explode(F.try_element_at(at, F.col("term"))).alias("offset"))
    fits = starts.groupBy("key", "field", (F.col("place") - F.col("offset")).alias("start")).agg(F.count(F.lit(1)).alias("n"))
    return fits.filter(F.col("n") == len(needle) - GRAM + 1).select("key").distinct()


def matching(records: DataFrame, key: str, hits: DataFrame | None) -> DataFrame:
    """The records that a search found."""
    if hits is None:
        return records
    return records.join(hits.select(F.col("key").alias(key)), key, "left_semi").select(*records.columns)
