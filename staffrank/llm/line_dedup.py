"""Line dedup: distinct-site spread of lines by HyperLogLog sketches.

1. every line gets a 128-bit key; per key, partial aggregates merge into one HyperLogLog sketch of
   the sites that have it (a very common line is one sketch per task, then one in all);
2. lines whose estimate is clearly under the limit are dropped, those clearly over it are
   boilerplate; for lines *near* the limit the distinct sites are counted exactly;
3. boilerplate lines leave every document but the first (smallest ``doc_id``) that has them: the
   *places* of a row's lost lines come together and are taken out of the row's array of lines.

The first document keeps its lines so that a text which was copied to many sites survives once.
Joins of lines with keys send the few lines that hold over a ``HOT``-th of all lines each past the
exchange: there are at most ``HOT`` such keys, so these are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffrank.session import ensure_checkpoint_dir

MIN_SITES = 10   # distinct sites from which on a line is boilerplate
LG_K = 10        # 2**10 registers: a standard error of about 3 %
NEAR = 0.25      # estimates within this share of the limit are counted exactly (eight standard errors)
HOT = 1024       # a line with over this part of all lines is joined by broadcast; no more such lines can be


def _keyed_lines(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, place, k1, k2: the lines with a word, as keys of two independent 64-bit hashes."""
    lines = docs.select(*columns, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.select(*columns, "place", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))


def _matched(lines: DataFrame, keys: DataFrame, hot: DataFrame) -> DataFrame:
    """Inner join of lines with keys (one row a key); ``hot``: the keys of the at most ``HOT`` frequent lines."""
    hot = F.broadcast(hot.select("k1", "k2"))
    rare = lines.join(hot, ["k1", "k2"], "left_anti").join(keys, ["k1", "k2"])
    return rare.unionByName(lines.join(F.broadcast(keys.join(hot, ["k1", "k2"], "left_semi")), ["k1", "k2"]))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, first_id): keys of lines on ``min_sites`` or more distinct sites; and the frequent keys."""
    ensure_checkpoint_dir(docs.sparkSession)
    total = docs.agg(F.sum(F.size(F.split("text", "\n")).cast("long"))).first()[0] or 0
    lines = _keyed_lines(docs, "doc_id", "site")
    spread = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    spread = spread.select("k1", "k2", "first_id", F.hll_sketch_estimate("sketch").alias("sites"), (F.col("n") * HOT > total).alias("hot"))
    spread = spread.where(F.col("hot") | (F.col("sites") >= F.floor(F.lit(min_sites * (1 - NEAR))))).checkpoint()
    hot = spread.where("hot")
    clear = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("k1", "k2", "first_id")
    near = spread.where((F.col("sites") <= min_sites * (1 + NEAR)) & (F.col("sites") >= F.floor(F.lit(min_sites * (1 - NEAR)))))
    exact = (_matched(lines, near.select("k1", "k2", "first_id"), hot).groupBy("k1", "k2", "first_id", "site").agg(F.lit(1).alias("one"))
             .groupBy("k1", "k2", "first_id").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites))
    return clear.unionByName(exact.select("k1", "k2", "first_id")), hot


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` (doc_id, text, a site column, any others) with ``text`` without its boilerplate lines,
    and ``n_lines`` / ``n_removed`` (lines with a word; replaced if ``docs`` has such columns).

    Kept lines are joined by one \\n in their order; lines without a word are kept as they are.
    Defined cases: a null text stays null and has no lines; a null site is no site; lines repeated in
    a document go or stay together; a null ``doc_id`` is never the first document, unless all
    holders of a line are without an id, when the line goes everywhere; rows that repeat a
    ``doc_id`` are one document; an empty table gives an empty table.  Work on a text is in
    proportion to its lines.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # other columns travel in a struct, so that no name of theirs can clash
    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col(site).cast("string").alias("site"),
        F.struct(F.col(f"`{site}`"), *[F.col(f"`{c}`") for c in keep if c not in ("doc_id", "text", site)]).alias("other"))
    found, hot = boilerplate(rows.select("doc_id", "text", "site"), min_sites)
    # a row is known by its id and text, with or without an id: rows alike in both lose the same places
    rows = rows.drop("site").withColumns({"r1": F.xxhash64("doc_id", "text"), "r2": F.xxhash64(F.lit(1), "doc_id", "text")})
    lost = (_matched(_keyed_lines(rows, "doc_id", "r1", "r2"), found, hot)
            .where((F.col("doc_id") != F.col("first_id")) | F.col("doc_id").isNull() | F.col("first_id").isNull())
            .groupBy("r1", "r2").agg(F.collect_set("place").alias("lost")))
    joined = rows.join(lost, ["r1", "r2"], "left").withColumn("lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))  # by a hash set, in order
    joined = joined.withColumn("kept", F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i))))
    column = {"doc_id": F.col("doc_id"), "text": F.array_join("kept", "\n")}
    return joined.select(
        *[column.get(c, F.col("other").getField(c)).alias(c) for c in keep],
        F.coalesce(F.size(F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"))
