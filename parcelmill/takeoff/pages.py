"""Best text per plan page, and the running floor of a page."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.text import strip
from parcelmill.operators.keyed import carry_forward, top_per_key
from parcelmill.takeoff.rules import FLOOR_NAME, FLOOR_NUMBER, PAGE_TERMS, PAGE_TERMS_LONG

SMALLEST_HEADING = 100
PAGES_PER_SPAN = 20_000


def _share(c: Column, removed: str) -> Column:
    """Share of the characters that stay after removing a character class."""
    kept = F.length(F.regexp_replace(c, removed, ""))
    return F.try_divide(kept.cast("double"), F.length(c))


def page_score(c: Column, detailed: bool = False) -> Column:
    """Quality of a page text; blank texts score 0. `detailed` is the version with more terms."""
    terms = PAGE_TERMS_LONG if detailed else PAGE_TERMS
    points, shortest, longest, worst, penalty = (
        (10, 100, 3000, 0.4, 15) if detailed else (5, 50, 5000, 0.3, 20)
    )
    size = F.length(strip(c))
    upper = F.upper(c)
    hits = sum((F.contains(upper, F.lit(t)).cast("int") for t in terms), F.lit(0))
    score = (
        _share(c, r"[^\p{L}\p{N}]") * 30
        + F.when(size.between(shortest, longest), 20).when(size > longest, 10).otherwise(0)
        + hits * points
        - F.when(_share(c, r"[\p{L}\p{N}\s]") > worst, penalty).otherwise(0)
    )
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.lit(0.0)).otherwise(score)


def best_pages(pages: DataFrame, detailed: bool = False) -> DataFrame:
    """One text per plan and page: the best score, the first method among equals."""
    scored = pages.withColumn("score", page_score(F.col("text"), detailed))
    order = [F.col("score").desc(), F.col("method").asc()]
    return top_per_key(scored, ["plan_id", "page_no"], order)


def with_running_floor(pages: DataFrame) -> DataFrame:
    """`floor`: the last floor heading on earlier pages, else the first floor named on them.

    A heading is a floor name with an area of at least 100.
    """
    names = F.regexp_extract_all("text", F.lit("(?i)" + FLOOR_NUMBER), F.lit(1))
    areas = F.regexp_extract_all("text", F.lit("(?i)" + FLOOR_NUMBER), F.lit(2))
    named = pages.withColumns({"_names": names, "_areas": areas})
    large = F.filter(
        F.arrays_zip("_names", "_areas"),
        lambda x: x["_areas"].try_cast("bigint") >= SMALLEST_HEADING,
    )
    heading = F.try_element_at(large, F.lit(-1)).getField("_names")
    mention = F.nullif(F.regexp_extract("text", "(?i)" + FLOOR_NAME, 1), F.lit(""))
    marked = named.select(
        "plan_id", "page_no", "text", heading.alias("_heading"), mention.alias("_mention")
    )
    first = marked.groupBy("plan_id").agg(
        F.min_by("_mention", F.when(F.col("_mention").isNotNull(), F.col("page_no"))).alias("_first"),
        F.min(F.when(F.col("_mention").isNotNull(), F.col("page_no"))).alias("_first_page"),
    )
    carried = carry_forward(
        marked, ["plan_id"], "page_no", "_heading", "_last", span=PAGES_PER_SPAN
    )
    earlier = F.when(F.col("_first_page") < F.col("page_no"), F.col("_first"))
    name = F.coalesce("_last", earlier)
    floor = F.coalesce(F.concat(F.lower(name), F.lit("_floor")), F.lit("unknown"))
    return carried.join(first, "plan_id").select("plan_id", "page_no", "text", floor.alias("floor"))
