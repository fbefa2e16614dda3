"""Secret-looking strings, and how far each of them is spread over repositories and owners.

Positions come from cutting a text at its matches: the pieces between and the matches themselves give every
offset in code points, without leaving the engine's expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import id_and_text, stage, text_key

#: Kinds in their order, with pattern, the group that holds the value, and its least length.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: A text without this can hold no match that is long enough.
MAY_HOLD = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
}
#: From so many owners on, a value is an example that people copy.
COPIED_OWNERS = 3
#: From so many repositories on, a value is one too, even where few owners hold them.
COPIED_REPOSITORIES = 10
#: A value by one owner looks live if its characters are mixed like a generated one's: sixteen random hexadecimal
#: digits have 3.3 bits a character on average, words and repeated digits less than 3.
LIVE_BITS = 3.0

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


#: Matches whose places are added up one after the other. An array grows by copying, so a long text's matches go in
#: blocks of so many, and only the blocks' beginnings are one growing array.
BLOCK = 256
MATCH = "array<struct<piece:string,whole:string,value:string>>"


def _matches(text: Column, rank: int) -> Column:
    """Matches of one kind, leftmost and without overlap, each with the piece of text before it."""
    kind, pattern, group, least = KINDS[rank]
    if kind == "hex":
        pattern = rf"[0-9a-f]{{{least},}}"  # a match is always a whole run, so short runs need not be cut out
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("piece"), whole.alias("whole"), values.alias("value"))
    return F.when(text.rlike(MAY_HOLD[kind]), found.cast(MATCH)).otherwise(F.array().cast(MATCH))


def _length(m: Column) -> Column:
    return F.length(m["piece"]) + F.length(m["whole"])


def _spans(block: Column, at: Column, rank: int) -> Column:
    """Spans of the matches of a block that begins at a place; short ones are dropped."""
    kind, _, _, least = KINDS[rank]

    def step(state: Column, m: Column) -> Column:
        begin, end = state["at"] + F.length(m["piece"]), state["at"] + _length(m)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), m["value"].alias("value"))
        out = F.when(F.length(m["value"]) >= least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.cast(SPAN).alias("out"))

    start = F.struct(at.alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(block, start, step, lambda s: s["out"])


def base_spans(df: DataFrame) -> DataFrame:
    """``df`` (with ``text``) and its ``base`` spans by start, then kind.

    Each column is a step of its own, so that a step is evaluated once for a text.
    """
    ranks = range(len(KINDS))
    out = df.withColumns({f"_m{r}": _matches(F.col("text"), r) for r in ranks})
    last = lambda r: F.floor((F.size(f"_m{r}") - 1) / BLOCK).cast("int")
    block = lambda r: lambda i: F.slice(F.col(f"_m{r}"), i * BLOCK + 1, BLOCK)
    none = F.array().cast(f"array<{MATCH}>")
    out = out.withColumns({f"_b{r}": F.when(F.size(f"_m{r}") > 0, F.transform(F.sequence(F.lit(0), last(r)), block(r))).otherwise(none) for r in ranks})
    size = lambda b: F.aggregate(b, F.lit(0), lambda n, m: n + _length(m))
    out = out.withColumns({f"_n{r}": F.transform(f"_b{r}", size) for r in ranks})
    begins = lambda r: F.aggregate(f"_n{r}", F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))
    out = out.withColumns({f"_a{r}": begins(r) for r in ranks})
    spans = lambda r: F.flatten(F.transform(f"_b{r}", lambda b, i: _spans(b, F.col(f"_a{r}")[i], r)))
    out = out.withColumn("base", F.array_sort(reduce(lambda a, b: F.concat(a, b), [spans(r) for r in ranks])))
    return out.drop(*[f"_{c}{r}" for c in "mbna" for r in ranks])


def _bits(value: Column) -> Column:
    """Entropy of the characters of a value, in bits a character. The patterns leave some sixty different ones."""
    chars = F.split(value, "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
    return F.aggregate(F.transform(F.array_distinct(chars), share), F.lit(0.0), lambda n, p: n - p * F.log2(p))


def ownership(
    spans: DataFrame, copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES, live_bits: float = LIVE_BITS
) -> DataFrame:
    """``value_hash, repositories, owners, verdict`` for each value found; ``verdict`` is copied, live or plain.

    ``spans`` has one row per span with ``value, repository, owner``. Values are first reduced to one row per
    repository and owner in the map tasks, so a value that a third of all rows hold moves a few rows per task.
    """
    each = spans.select("value_hash", "repository", "owner", "bits").distinct()
    counted = each.groupBy("value_hash").agg(
        F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners"), F.max("bits").alias("bits")
    )
    copied = (F.col("owners") >= copied_owners) | (F.col("repositories") >= copied_repositories)
    verdict = F.when(copied, "copied").when((F.col("owners") == 1) & (F.col("bits") >= live_bits), "live").otherwise("plain")
    return counted.select("value_hash", "repositories", "owners", verdict.alias("verdict"))


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "source",
    owner_col: str = "source",
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
    live_bits: float = LIVE_BITS,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, base, added``, spans as structs of start, kind and end.

    ``base`` has the spans of :data:`KINDS`. ``added`` marks the value of every base span that the corpus shows to
    be ``live`` (one owner, mixed characters) or ``copied`` (many owners or repositories); others get no mark. Null
    texts are empty and have no spans, null repositories and owners count as one each, texts of any length are
    read whole. Rows that repeat an id with the same text have the same spans.
    """
    own = df.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(named(repository_col).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(named(owner_col).cast("string"), F.lit("")).alias("owner"),
    )
    found = base_spans(own).select("doc_id", text_key(F.col("text")).alias("key"), "repository", "owner", "base")
    found, _ = stage(found, "secret-spans")
    flat = found.filter(F.size("base") > 0).select("doc_id", "key", "repository", "owner", F.explode("base").alias("s"))
    flat = flat.select("doc_id", "key", "repository", "owner", "s", F.sha2(F.col("s.value"), 256).alias("value_hash"), _bits(F.col("s.value")).alias("bits"))
    verdicts = ownership(flat, copied_owners, copied_repositories, live_bits).filter("verdict <> 'plain'")
    value_start = F.col("s.end") - F.length("s.value")
    mark = F.struct(value_start.alias("start"), F.lit(len(KINDS)).alias("rank"), F.col("verdict").alias("kind"), F.col("s.end").alias("end"))
    marks = flat.join(verdicts, "value_hash").groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(mark)).alias("added"))
    marks = marks.withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    joined = found.join(marks, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k")), "left")
    bare = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return joined.select("doc_id", bare.alias("base"), F.coalesce("added", none).alias("added"))


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined with commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
