"""Document manifests, and the marks that rules leave on printed text."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.functions.urls import resolve

#: Points: a rule's largest height, tolerance, margins that are cropped.
RULE, TOLERANCE, TOP, BOTTOM = 5, 2, 90, 80
#: A bin's width in points, and the most bins that a page is wide.
BIN, BINS = 36.0, 256


def manifest(records: DataFrame, base: str, session: str = "session_code", bill: str = "bill_no", documents: str = "documents") -> DataFrame:
    """(session, bill, kind, index, url, path) of map<kind, urls>; the path is session/category/bill/bill_kind_index.pdf."""
    rows = records.select(session, bill, F.explode(documents).alias("kind", "_urls")).select(session, bill, "kind", F.posexplode("_urls").alias("index", "_url"))
    category = F.regexp_extract(bill, "^([a-zA-Z]+)", 1)
    name = F.concat(F.concat_ws("_", F.col(bill), F.col("kind"), F.col("index").cast("string")), F.lit(".pdf"))
    return rows.select(session, bill, "kind", "index", resolve(F.lit(base), F.col("_url")).alias("url"), F.concat_ws("/", F.col(session), category, F.col(bill), name).alias("path"))


def not_stored(manifest_rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose path is not in a listing (path)."""
    return manifest_rows.join(stored.select("path"), "path", "left_anti")


def _bins(low, high, width) -> Column:
    """The bins that an interval touches."""
    return F.sequence(F.floor(F.least(low, high) / width), F.floor(F.greatest(low, high) / width))


def marked_chars(chars: DataFrame, rects: DataFrame, page_height: float | None = None) -> DataFrame:
    """chars(doc, page, ord, text, x0, x1, top, bottom) with mark: underline, strike or null.

    A thin rule that overlaps a character strikes it through if it is nearer to
    the middle and underlines it if nearer to the bottom, within the tolerance;
    the last rule in order counts. With a page height, margins are cropped.

    Rules without a doc are those of a page in every document: they are never repeated for each,
    and of rules at one place only the last is kept.

    Characters and rules meet in bins of their x and of their height on the page, and a pair
    counts in the bin where its overlap begins only, so a page of many lines is no
    product of its characters and rules. Bins are wider on pages wider than BIN * BINS, and
    both are cut to the stretch of x where there are characters and rules, so neither touches more
    than BINS + 2; what lies beside it meets nothing.
    Places that are null or not finite overlap nothing.
    """
    if page_height:
        chars = chars.where((F.col("top") >= TOP) & (F.col("bottom") <= page_height - BOTTOM))
    sound = lambda *names: reduce(and_, [F.abs(F.col(c).cast("double")) < F.lit(float("inf")) for c in names])
    x, _x = ("x0", "x1"), ("_x0", "_x1")
    on = [c for c in ("doc", "page") if c in rects.columns]
    placed = chars.where(sound(*x, "top", "bottom")).select("doc", "page", "ord", *[F.col(c).cast("double").alias(c) for c in (*x, "top", "bottom")])
    thin = rects.where(sound(*x, "top", "bottom") & (F.col("bottom") - F.col("top") <= RULE))
    thin = thin.select(*on, F.col("ord").alias("_ord"), F.col("x0").cast("double").alias("_x0"), F.col("x1").cast("double").alias("_x1"), ((F.col("top") + F.col("bottom")) / 2).cast("double").alias("_y"))
    if "doc" not in on:
        thin = thin.groupBy(*on, *_x, "_y").agg(F.max("_ord").alias("_ord"))
    ends = lambda df, x: df.groupBy(*on).agg(F.min(F.least(*x)).alias("_low"), F.max(F.greatest(*x)).alias("_high"))
    # Sizes are guessed from tables before they are exploded, so that all would be broadcast: these joins are by shuffle.
    both = ends(placed, x).join(ends(thin, _x).toDF(*on, "_low2", "_high2").hint("merge"), on)
    both = both.select(*on, F.greatest("_low", "_low2").alias("_low"), F.least("_high", "_high2").alias("_high")).where("_low <= _high")
    both = both.withColumn("_width", F.greatest(F.lit(BIN), (F.col("_high") - F.col("_low")) / BINS))

    def binned(df: DataFrame, x: tuple[str, str]) -> DataFrame:
        cut = [F.least(F.greatest(F.col(c), F.col("_low")), F.col("_high")) - F.col("_low") for c in x]
        within = (F.least(*x) <= F.col("_high")) & (F.greatest(*x) >= F.col("_low"))
        return df.join(both.hint("merge"), on).where(within).withColumn("_x", F.explode(_bins(*cut, F.col("_width"))))

    middle, bottom = (F.col("top") + F.col("bottom")) / 2, F.col("bottom")
    # A rule that marks is near the middle or the bottom: those two are looked up, not all between.
    near = F.array_distinct(F.flatten(F.array(*[_bins(y - TOLERANCE, y + TOLERANCE, F.lit(2.0 * TOLERANCE)) for y in (middle, bottom)])))
    here = binned(placed, x).withColumn("_y_bin", F.explode(near))
    rules = binned(thin, _x).withColumn("_y_bin", F.floor(F.col("_y") / (2.0 * TOLERANCE))).drop("_low", "_high", "_width")

    over = here.join(rules.hint("merge"), [*on, "_x", "_y_bin"]).where((F.col("x0") < F.col("_x1")) & (F.col("x1") > F.col("_x0")))
    over = over.where(F.floor((F.greatest("x0", "_x0") - F.col("_low")) / F.col("_width")) == F.col("_x"))
    to_middle, to_bottom = F.abs(F.col("_y") - middle), F.abs(F.col("_y") - bottom)
    # A mark is a number until the end: pairs of numbers are tallied by hash, without sorting them.
    mark = F.when((to_middle <= to_bottom) & (to_middle <= TOLERANCE), 1).when((to_bottom < to_middle) & (to_bottom <= TOLERANCE), 2)
    best = over.withColumn("_mark", mark).where(F.col("_mark").isNotNull()).groupBy("doc", "page", "ord").agg(F.max_by("_mark", "_ord").alias("_mark"))
    best = best.select("doc", "page", "ord", F.when(F.col("_mark") == 1, "strike").when(F.col("_mark") == 2, "underline").alias("mark"))
    return chars.join(best.hint("merge"), ["doc", "page", "ord"], "left")


def marked_lines(chars: DataFrame) -> DataFrame:
    """(doc, page, line, text): lines of marked chars (with top), runs wrapped in _ or ~.

    A space never begins or ends a run of its own: it takes the mark before it.
    """
    line = Window.partitionBy("doc", "page").orderBy("ord")
    inside = Window.partitionBy("doc", "page", "line").orderBy("ord")
    rows = chars.withColumn("line", F.sum(F.when(F.abs(F.col("top") - F.lag("top").over(line)) > TOLERANCE, 1).otherwise(0)).over(line))
    own = F.when(F.trim("text") != "", F.coalesce("mark", F.lit("plain")))
    rows = rows.withColumn("kind", F.coalesce(F.last(own, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.lit("plain")))
    rows = rows.withColumn("run", F.sum(F.when(F.col("kind").eqNullSafe(F.lag("kind").over(inside)), 0).otherwise(1)).over(inside))
    runs = rows.groupBy("doc", "page", "line", "run", "kind").agg(F.array_join(F.array_sort(F.collect_list(F.struct("ord", "text")))["text"], "").alias("t"))
    sign = F.when(F.col("kind") == "underline", "_").when(F.col("kind") == "strike", "~").otherwise("")
    text = F.concat(sign, F.rtrim("t"), sign, F.substr(F.col("t"), F.length(F.rtrim("t")) + 1))
    marked = runs.withColumn("m", F.when(F.col("kind") == "plain", F.col("t")).otherwise(text))
    return marked.groupBy("doc", "page", "line").agg(F.array_join(F.array_sort(F.collect_list(F.struct("run", "m")))["m"], "").alias("text"))
