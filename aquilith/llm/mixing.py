"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words: the total is shared by weight, a target
stops at ``cap`` times the source's size, and the excess is shared again by
weight. A source with target r times its size first takes floor(r) whole copies
of every document; the rest is a sample of fixed size in words. In it a document's
inclusion probability is in proportion to the bit length of its size, so a long
text is likelier than a short one; those that reach 1 are certain, and the
others' share is raised so that the expected words equal the rest. Documents are
ranked by their random odds u / (1 - u) over their inclusion odds p / (1 - p) and
taken in that order up to the rest's words, and one more document, the one
nearest to what is still missing, closes the gap.

Rows repeated (equal source, id and text) are one unit of several rows, of which
any number is taken. Only DataFrame functions are used. A source's ranking is cut by counting words
in ``BUCKETS`` ranges of the rank first, so that only the range in which the
rest ends is ever sorted; a hot source meets in no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Workspace, row_key

BUCKETS = 4096


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(id_: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) from the seed and the row, by 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources by code point, null last, take the weights in turn, repeating. The
    sources that reach their cap are those of least cap over weight.
    """
    n = len(weights)
    sized = sizes.withColumn("at", F.expr("row_number() over (order by source nulls last) - 1"))
    sized = sized.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % n + 1).cast("int")))
    sized = sized.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    before = "over (order by most / weight, at rows between unbounded preceding and 1 preceding)"
    filled = sized.selectExpr(
        "*",
        f"coalesce(sum(most) {before}, 0d) as full",
        f"coalesce(sum(weight) {before}, 0d) as gone",
        "sum(source_size) over () as total",
        "sum(weight) over () as all_weight",
    )
    filled = filled.withColumn("capped", F.expr("most <= (total - full) / (all_weight - gone) * weight"))
    filled = filled.selectExpr("*", "sum(if(capped, most, 0d)) over () as taken_out", "sum(if(capped, weight, 0d)) over () as weight_out")
    return filled.selectExpr("source", "source_size", "case when capped then most else (total - taken_out) / (all_weight - weight_out) * weight end as target")


def inclusion(classes: DataFrame) -> DataFrame:
    """(source, bits, chance) from (source, bits, words, rest): chances in proportion to bits, at most 1, that expect rest words.

    Classes saturate from the greatest down, so one pass in that order finds those that do.
    """
    upto = "over (partition by source order by bits desc rows between unbounded preceding and 1 preceding)"
    below = "over (partition by source order by bits desc rows between current row and unbounded following)"
    share = classes.selectExpr("*", f"rest - coalesce(sum(words) {upto}, 0) as open", f"sum(words * bits) {below} as pull")
    share = share.selectExpr("*", "bits * open >= pull as certain")
    # all classes under the first that is not certain share what that one saw
    first = share.filter("not certain").groupBy("source").agg(F.max(F.struct("bits", "open", "pull")).alias("f"))
    first = first.select(F.col("source").alias("_s"), F.col("f.bits").alias("from"), F.col("f.open").alias("left"), F.col("f.pull").alias("all"))
    joined = share.join(first, F.col("source").eqNullSafe(F.col("_s")), "left")
    return joined.selectExpr("source", "bits", "if(`from` is null or bits > `from`, 1d, greatest(0d, bits * left / all)) as chance")


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with the Pareto rank q, and its bucket, by u and their inclusion chance; a certain row ranks 0."""
    odds = F.when((F.col("chance") > 0) & (F.col("chance") < 1), F.col("chance") / (1 - F.col("chance")))
    rank = F.when(F.col("chance") >= 1, F.lit(0.0)).otherwise(F.col("u") / (1 - F.col("u")) / odds)
    return rows.withColumn("q", rank).withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * BUCKETS).cast("int"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _rows(docs: DataFrame, *, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    return [F.col(f"`{source_col}`").cast("string").alias("source"), id_.alias("id"), row_key(id_col, text_col).alias("key"), size_of(text).alias("size"), uniform(id_, text, seed).alias("u")]


_BITS = "length(bin(size))"


def plan(docs: DataFrame, *, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], cap: float, seed: int, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, chances, special).

    sources: one row a source, its target, whole copies, and where its sample
    ends; chances: inclusion by source and bit length of the size; special: at
    most two units a source (id, key), of whose rows only so many (``more``) are taken.
    """
    rows = docs.select(*_rows(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed))
    units = work.put(rows.groupBy("source", "id", "key", "size", "u").agg(F.count("*").alias("m")).withColumn("words", F.col("size") * F.col("m")))
    shares = targets(units.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    shares = shares.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    shares = shares.withColumn("whole", F.floor("ratio").cast("long")).withColumn("part", F.col("ratio") - F.col("whole"))
    shares = work.put(shares.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))

    drawn = shares.filter("part > 0").select(F.col("source").alias("s"), "rest")
    classes = units.filter("size > 0").groupBy("source", F.expr(_BITS).alias("bits")).agg(F.sum("words").alias("words"))
    chances = work.put(inclusion(classes.join(drawn, _same("source", "s")).drop("s")))
    ranked = _ranked(_with_chance(units.filter("size > 0"), chances)).filter("q is not null").join(drawn, _same("source", "s")).drop("s")
    counted = ranked.groupBy("source", "bucket").agg(F.sum("words").alias("words"), F.first("rest").alias("rest"))
    upto = counted.selectExpr("source", "bucket", "rest", "words", "sum(words) over (partition by source order by bucket) as upto")
    # the first range that does not fit whole; none if all fit
    ends = work.put(upto.filter("upto > rest").groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("e")).select(F.col("source").alias("s"), F.col("e.bucket").alias("end"), F.col("e.before").alias("before")))

    last = ranked.join(ends, _same("source", "s") & (F.col("bucket") == F.col("end")))
    last = last.selectExpr("*", "before + sum(words) over (partition by source order by q, id nulls last, key) as upto")
    mine = F.struct("q", F.col("id").isNull().alias("null"), "id", "key")
    whole = last.filter("upto <= rest").groupBy("source").agg(F.max(mine).alias("cut"), F.max("upto").alias("upto"))
    # the unit in which the rest ends: as many of its rows as fit
    cut = last.filter("upto > rest").groupBy("source").agg(F.min(F.struct(mine, "size", F.floor((F.col("rest") - F.col("upto") + F.col("words")) / F.col("size")).cast("long").alias("more"))).alias("c"))
    ends = ends.join(whole.select(F.col("source").alias("w"), "cut", "upto"), _same("s", "w"), "left").join(cut.select(F.col("source").alias("x"), "c"), _same("s", "x"), "left")
    ends = work.put(ends.selectExpr("s", "end", "cut", "c.col1.id as part_id", "c.col1.key as part_key", "c.more as more", "coalesce(upto, before) + c.more * c.size as filled"))

    open_ = ranked.join(ends, _same("source", "s")).filter(~_inside())
    open_ = open_.filter(~((F.col("key") == F.col("part_key")) & _same("id", "part_id") & (F.col("m") <= F.col("more"))))
    open_ = open_.withColumn("off", F.abs(F.col("size") - (F.col("rest") - F.col("filled")))).filter("off < rest - filled")
    extra = open_.groupBy("source").agg(F.min(F.struct("off", "q", F.col("id").isNull().alias("null"), "id", "key")).alias("extra"))
    special = ends.selectExpr("s", "part_id as i", "part_key as k", "more").unionByName(extra.selectExpr("source as s", "extra.id as i", "extra.key as k", "1L as more"))
    special = work.put(special.groupBy("s", "i", "k").agg(F.sum("more").alias("more")).filter("more > 0"))
    out = shares.select(F.col("source").alias("_source"), "source_size", "target", "whole", "part")
    out = work.put(out.join(ends.select("s", "end", "cut"), _same("_source", "s"), "left").drop("s"))
    work.only(out, chances, special)
    return out, chances, special


def _with_chance(rows: DataFrame, chances: DataFrame) -> DataFrame:
    of = chances.select(F.col("source").alias("_cs"), F.col("bits").alias("_cb"), "chance")
    return rows.join(of, _same("source", "_cs") & (F.expr(_BITS) == F.col("_cb")), "left").drop("_cs", "_cb")


def _inside() -> Column:
    """Whether a ranked row lies before the end of its source's sample."""
    mine = F.struct(F.col("q").alias("q"), F.col("id").isNull().alias("null"), F.col("id").alias("id"), F.col("key").alias("key"))
    return F.col("end").isNull() | (F.col("bucket") < F.col("end")) | ((F.col("bucket") == F.col("end")) & F.coalesce(mine <= F.col("cut"), F.lit(False)))


def _with_copies(docs: DataFrame, *, id_col: str, text_col: str, source_col: str, seed: int, planned: tuple[DataFrame, DataFrame, DataFrame], work: Workspace) -> DataFrame:
    """``docs`` as struct column row, with id, size, source_size, target and copies."""
    cuts, chances, special = planned
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_rows(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed))
    ranked = _ranked(_with_chance(rows.join(cuts, _same("source", "_source")), chances))
    unit = _same("source", "s") & _same("id", "i") & (F.col("key") == F.col("k"))
    columns = ["row", "id", "size", "source_size", "target", "whole"]
    sample = (F.col("part") > 0) & (F.col("size") > 0) & F.col("q").isNotNull() & _inside()
    plain = ranked.join(special, unit, "left_anti").select(*columns, F.coalesce(sample, F.lit(False)).alias("taken"))
    # rows of a special unit are numbered: by the part they were read in, then across parts
    some = work.put(ranked.join(special, unit).select(*columns, "s", "i", "k", "more", F.spark_partition_id().alias("p")))
    parts = some.groupBy("s", "i", "k", "p").agg(F.count("*").alias("rows"))
    parts = parts.selectExpr("s as s_", "i as i_", "k as k_", "p as p_", "sum(rows) over (partition by s, i, k order by p) - rows as before")
    numbered = some.withColumn("at", F.expr("row_number() over (partition by s, i, k, p order by size)"))
    numbered = numbered.join(parts, _same("s", "s_") & _same("i", "i_") & (F.col("k") == F.col("k_")) & (F.col("p") == F.col("p_")))
    both = plain.unionByName(numbered.select(*columns, (F.col("before") + F.col("at") <= F.col("more")).alias("taken")))
    return both.withColumn("copies", F.col("whole") + F.col("taken").cast("long"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = 3.0,
    seed: int = 20,
) -> DataFrame:
    """(id, size, source_size, target, taken) for every row.

    size is the number of words (null text: 0), taken the words that the mix
    takes, repeats counted: size times the row's copies. Rows are told apart by
    source, id and text; of rows repeated any number may take one copy more than
    the others. Rows of size 0 take nothing. Null ids and sources are values like
    others, ids ranked last among ties. ``cap`` is a whole number. Whole texts are
    counted, however long. Reruns agree. Other columns are ignored, whatever their
    names; an empty table gives an empty one.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, text_col, source_col])])
    work = Workspace(docs.sparkSession, "mixing")
    planned = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, cap=cap, seed=seed, work=work)
    rows = _with_copies(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, planned=planned, work=work)
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0, seed: int = 20, copy_col: str | None = None) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken.

    ``copy_col`` names a column to add, which numbers the copies of a row from 1.
    Nulls, repeats, long texts, clashing names and empty tables are as for ``mix``. Of
    rows repeated with id, text and source, which of them are taken once more follows from
    where they are read, so where these differ in other columns, those columns may
    differ between reruns; ids, texts and sources do not.
    """
    work = Workspace(docs.sparkSession, "mixing")
    planned = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, cap=cap, seed=seed, work=work)
    rows = _with_copies(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, planned=planned, work=work)
    copies = rows.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return copies.select("row.*", *([] if copy_col is None else [F.col("copy").alias(copy_col)]))
