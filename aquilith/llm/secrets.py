"""Secret scan with corpus-wide ownership frequency.

Three kinds of candidates are found in every whole text: assignments of a long
value to a telling name, access keys, and long hexadecimal runs. Each
candidate's value is hashed, and over the whole corpus the hash's distinct
repositories and owners are counted. A value that ``many_owners`` or more owners
or ``many_repos`` or more repositories hold is a widely copied example, even
where all its copies are one owner's; one that stays with fewer and looks live (enough
different characters, letters and digits, no placeholder word) adds a span of
kind ``live`` over the value itself.

Only DataFrame functions are used. The scan is written once, without texts;
counting is by (hash, owner, repository) first, so a hash that a third of all
rows hold is counted in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, hot_keys, row_key, spread_join


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_HEAD = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?"""
ASSIGN = rf"{_HEAD}[A-Za-z0-9+/_.=-]+"
#: Runs are maximal from their start, so a least length in the pattern drops the
#: same matches as a filter behind it.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "live")
#: Matches whose places are added up in one go.
STRETCH = 256
#: Parts of values that are placeholders.
PLACEHOLDERS = r"example|sample|changeme|placeholder|your|dummy|test|xxxx|1234567"


_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, kind, end, value>> of the pattern's matches, in code points.

    ``split`` gives what lies between the matches that ``regexp_extract_all``
    gives, so lengths add up to places. They are added up in stretches, then over
    stretches, as an array that grows by one element is copied for each.
    """
    none = F.expr(f"cast(array() as {_SPANS})")

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + F.length(m["text"])
        row = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["text"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    def stretches(pairs: Column) -> Column:
        begin = F.expr(f"named_struct('at', 0, 'out', cast(array() as {_SPANS}))")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / STRETCH).cast("int")), lambda i: F.aggregate(F.slice(pairs, i * STRETCH + 1, STRETCH), begin, step))

    def places(parts: Column) -> Column:
        begin = F.expr("named_struct('at', 0, 'out', cast(array() as array<int>))")
        return F.aggregate(parts, begin, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def moved(part: Column, by: Column) -> Column:
        return F.transform(part["out"], lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"), s["value"].alias("value")))

    def spans(matches: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("text"), g.alias("gap")))
        parts = lambda p: _let(stretches(p), lambda x: F.flatten(F.zip_with(x, places(x), moved)))
        return F.when(F.size(matches) == 0, none).otherwise(_let(pairs, parts))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def _written(spans: Column) -> Column:
    """kind:start:end of spans in order of start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def looks_live(value: Column) -> Column:
    """Eight or more different characters, with a letter and a digit, and no placeholder in it."""
    return (
        (F.size(F.array_distinct(F.split(value, ""))) >= 8)
        & value.rlike("[A-Za-z]")
        & value.rlike("[0-9]")
        & ~F.lower(value).rlike(PLACEHOLDERS)
    )


def scan(docs: DataFrame, *, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(id, key, repo, owner, base): the base candidates of every row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        row_key(id_col, text_col).alias("key"),
        F.col(f"`{repo_col}`").cast("string").alias("repo"),
        F.col(f"`{owner_col}`").cast("string").alias("owner"),
        text.alias("text"),
    )
    assigned = F.filter(
        F.transform(_found(F.col("text"), ASSIGN, 0), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.regexp_replace(s["value"], f"^{_HEAD}", "").alias("value"))),
        lambda s: F.length(s["value"]) >= 12,
    )
    base = F.concat(assigned, _found(F.col("text"), ACCESS, 1), _found(F.col("text"), HEX, 2))
    return rows.select("id", "key", "repo", "owner", base.alias("base"))


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners, n_rows) of every candidate value; a null repository or owner counts as one."""
    held = found.select("digest", F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"))
    repos = held.groupBy("digest", "repo").agg(F.count("*").alias("rows")).groupBy("digest").agg(F.count("*").alias("n_repos"), F.sum("rows").alias("n_rows"))
    owners = held.groupBy("digest", "owner").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count("*").alias("n_owners"))
    return repos.join(owners, "digest").select("digest", "n_repos", "n_owners", "n_rows")


def find_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    many_owners: int = 3,
    many_repos: int = 10,
) -> DataFrame:
    """Spans of every row: (id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, held_by).

    Places are code points, ends exclusive; base_sha256 digests the base spans,
    spans lists those and the added ``live`` ones. A null text is empty; texts are
    scanned whole, in time in proportion to their length and matches. Equal
    rows get equal results; rows repeated count as one repository, null
    repositories and owners as one each. n_example is the number of base candidates
    that are widely copied; held_by gives, for every base span in order, its value's
    repositories and owners as repositories/owners. Other columns are ignored,
    whatever their names; an empty table gives an empty one.
    """
    work = Workspace(docs.sparkSession, "secrets")
    rows = work.put(scan(docs, id_col=id_col, text_col=text_col, repo_col=repo_col, owner_col=owner_col))
    each = rows.filter(F.size("base") > 0).select("id", "key", "repo", "owner", F.explode("base").alias("s"))
    each = each.select("id", "key", "repo", "owner", "s.start", "s.kind", "s.end", "s.value").withColumn("digest", F.sha2("value", 256))
    held = work.put(ownership(each))
    # a value that very many rows hold stays where its rows are
    judged = spread_join(each, held.drop("n_rows"), "digest", hot_keys(held, "digest", "n_rows"))
    common = (F.col("n_owners") >= many_owners) | (F.col("n_repos") >= many_repos)
    live = ~common & looks_live(F.col("value"))
    added = F.struct((F.col("end") - F.length("value")).alias("start"), F.lit(3).alias("kind"), F.col("end").alias("end"))
    holders = F.concat_ws("/", F.col("n_repos").cast("string"), F.col("n_owners").cast("string"))
    by_row = judged.groupBy("id", "key").agg(
        F.collect_set(F.when(live, added)).alias("live"),
        F.size(F.collect_set(F.when(common, F.struct("start", "kind")))).cast("long").alias("n_example"),
        F.collect_set(F.struct("start", "kind", holders.alias("by"))).alias("held"),
    )
    by_row = by_row.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "live", "n_example", F.array_join(F.transform(F.array_sort("held"), lambda h: h["by"]), ",").alias("held_by"))
    out = rows.join(by_row, rows.id.eqNullSafe(F.col("_id")) & (rows.key == F.col("_key")), "left")
    base = _bare(F.col("base"))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        F.col("id").alias(id_col),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, F.coalesce("live", none))).alias("spans"),
        F.coalesce(F.size("live"), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        F.coalesce("held_by", F.lit("")).alias("held_by"),
    )
