"""Chat formatting by quotation linking: quoted passages find the messages they come from; replies follow them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import free_name, let, lower_ascii, ranked, save

_MARK = r"^[ \t]*(?:>[ \t]?)+"
# How mail programs announce a quote, at the end of the line before it.
_SAYS = r"(?i)(?:wrote|writes|said|schrieb|a écrit|escribió) ?:[ \t]*$"
RUN = 5  # words in a run


def _depth(line: Column) -> Column:
    mark = F.regexp_extract(line, _MARK, 0)
    return F.length(mark) - F.length(F.replace(mark, F.lit(">"), F.lit("")))


def _lines(text: Column) -> Column:
    """array<struct<depth, body>>: how deep each line is quoted, and what it says."""
    return F.transform(F.split(text, "\r?\n"), lambda x: F.struct(
        _depth(x).cast("int").alias("depth"), F.regexp_replace(x, _MARK, "").alias("body")))


def _passages(lines: Column) -> Column:
    """Runs of lines of one depth above 0 without blank ones, in order; a blank quoted line ends a passage.

    Each line whose depth differs from that of the line before opens a part, named by a control character and the depth;
    the joined lines are split there, so that the time grows with the text. Such characters in a text are no parts of words."""
    plain = lambda body: F.translate(body, "\x01\x02", "  ")
    blank = lambda x: F.trim(F.translate(x["body"], "\t\r", "  ")) == ""
    parts = F.transform(lines, lambda x: F.struct(F.when(blank(x), 0).otherwise(x["depth"]).alias("depth"), plain(x["body"]).alias("body")))

    def opened(x: Column, before: Column) -> Column:
        opens = F.concat(F.lit("\x01"), x["depth"].cast("string"), F.lit("\x02"))
        return F.concat(F.when(x["depth"] == before, "").otherwise(opens), x["body"])

    def cut(parts: Column) -> Column:
        marked = F.transform(parts, lambda x, i: opened(x, F.coalesce(F.get(parts, i - 1)["depth"], F.lit(0))))
        return F.split(F.array_join(marked, "\n"), "\x01", -1)

    read = F.transform(let(parts, cut), lambda p: F.struct(
        F.coalesce(F.substring_index(p, "\x02", 1).try_cast("int"), F.lit(0)).alias("depth"), p.alias("text")))
    quoted = F.filter(read, lambda p, i: (i > 0) & (p["depth"] > 0))  # before the first part nothing is quoted
    return F.transform(quoted, lambda p: F.struct(p["depth"].alias("depth"), F.split(
        F.rtrim(F.substring(p["text"], F.instr(p["text"], "\x02") + 1, F.length(p["text"])), F.lit("\n")), "\n", -1).alias("lines")))


def _own(lines: Column) -> Column:
    """What the message itself says: unquoted lines without those that announce a quote."""
    def stays(x: Column, i: Column) -> Column:
        announces = x["body"].rlike(_SAYS) & (F.coalesce(F.get(lines, i + 1)["depth"], F.lit(0)) > 0)
        return (x["depth"] == 0) & ~announces

    return F.trim(F.array_join(F.filter(lines, stays)["body"], "\n"), F.lit("\n"))


def _normal(text: Column) -> Column:
    """Words, lower-cased, with single spaces."""
    return F.trim(F.regexp_replace(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _words(lines: Column) -> Column:
    return F.filter(F.split(_normal(F.array_join(lines, " ")), " "), lambda w: w != "")


def _pieces(lines: Column) -> Column:
    """array<struct<n, key, size>>: hashes and weights of the normalised whole and of each normalised line, without empty ones; n is 0."""
    parts = F.concat(F.array(_normal(F.array_join(lines, " "))), F.transform(lines, _normal))
    return F.transform(F.array_distinct(F.filter(parts, lambda p: p != "")), lambda p: F.struct(
        F.lit(0).alias("n"), F.xxhash64(F.lit("piece"), p).alias("key"), (RUN * F.length(p)).alias("size")))


def _runs(words: Column, n: Column) -> Column:
    """The same of all runs of n words, wherever lines break; a character weighs as much in all its runs as it does once in a piece."""
    whole = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    # distinct as strings, which are hashed; structs would be compared all with all
    all_runs = F.transform(F.array_distinct(whole), lambda r: F.struct(
        n.alias("n"), F.xxhash64(F.lit("run"), r).alias("key"), F.length(r).alias("size")))
    none = F.array().cast("array<struct<n:int,key:bigint,size:int>>")
    return F.when((n > 0) & (F.size(words) >= n), all_runs).otherwise(none)


def _quoted_keys(lines: Column) -> Column:
    """Pieces, and runs of RUN words; a shorter passage is one run."""
    return F.concat(_pieces(lines), let(_words(lines), lambda w: _runs(w, F.least(F.lit(RUN), F.size(w)))))


def link_quotes(messages: DataFrame) -> DataFrame:
    """Adds own_text, n_quotes, quote_depth, reply_to, thread and position to (conv_id, turn, text) rows.

    Lines that begin with `>` are quoted, as deep as they have marks; a run of lines of one depth is a
    passage. own_text is the message without passages and without the line that announces one; a text
    without quotes stays as it is. Normalised passages, whole and line by line, are hashed and joined to
    the unquoted lines and whole texts of the same conversation; a hash belongs to the first turn that
    says it. reply_to is the earlier turn from which the message's least deep passages have the most
    characters (then the earliest turn). thread is the turn in which the chain of replies begins, and
    position (from 0) orders the conversation's turns by thread and turn, so that each reply comes after
    what it answers and threads stay together.

    Rows of the same conv_id and turn are one turn: they share reply_to, thread and position. Null
    conv_id: one conversation like any other. Null turn: a turn before all others. Null text: null
    own_text, no quotes. Empty table: no rows. Columns with the names that are added are replaced.

    One conversation, one line or one message that everybody quotes may have any share of the rows:
    hashes are reduced to their first turn before the join, and positions come from a range shuffle.
    """
    messages = messages.drop("own_text", "n_quotes", "quote_depth", "reply_to", "thread", "position")
    at, conv = free_name(messages, "at"), "conv_id"
    known = messages.withColumn(at, F.coalesce("turn", F.lit(-(1 << 63))).cast("bigint"))
    slim = known.select(F.col(conv).alias("c"), F.col(at).alias("t"), "text")
    quoting = slim.where(F.col("text").rlike(r"(?m)^[ \t]*>")).select("c", "t", _lines(F.col("text")).alias("lines"))
    asked = quoting.select("c", "t", F.posexplode(_passages(F.col("lines"))).alias("n", "p")).select(
        "c", "t", "p.depth", F.explode(let(F.col("p.lines"), _quoted_keys)).alias("k")).select(
        "c", "t", "depth", "k.n", "k.key", "k.size")
    asked = save(asked, "asked")
    lengths = [r["n"] for r in asked.where("n > 0").select("n").distinct().collect()]  # RUN numbers at most
    wanted = asked.select("c", "key").distinct()
    said = slim.where("text is not null").select("c", "t", F.when(
        F.col("text").rlike(r"(?m)^[ \t]*>"), let(_lines(F.col("text")), _own)).otherwise(F.col("text")).alias("own"))
    keys = lambda own: F.concat(_pieces(own)["key"], let(_words(own), lambda w: F.concat(
        F.array().cast("array<bigint>"), *[_runs(w, F.lit(n))["key"] for n in lengths])))
    said = said.select("c", "t", F.explode(F.array_distinct(let(F.split("own", "\r?\n"), keys))).alias("key"))
    match = lambda a, b: a["c"].eqNullSafe(b["c"]) & (a["key"] == b["key"])
    said = said.join(wanted, match(said, wanted), "left_semi").groupBy("c", "key").agg(F.min("t").alias("first"))
    found = asked.join(said, match(asked, said)).where(F.col("first") < F.col("t")).select(
        asked["c"], "t", "depth", "size", "first")
    scored = found.groupBy("c", "t", "depth", "first").agg(F.sum("size").alias("size"))
    links = scored.groupBy("c", "t").agg(F.min(F.struct("depth", (-F.col("size")).alias("size"), "first")).alias("best")).select(
        "c", "t", F.col("best.first").alias("reply"))
    links = save(links, "links")
    roots = _roots(links)
    turns = slim.select("c", "t").distinct()
    same = lambda a, b: a["c"].eqNullSafe(b["c"]) & (a["t"] == b["t"])
    turns = turns.join(roots, same(turns, roots), "left").select(turns["c"], turns["t"], "reply", F.coalesce("root", turns["t"]).alias("root"))
    placed = ranked(turns, ["c"], ["root", "t"], "position", "turns").drop("turns")
    lines, joined = free_name(messages, "lines"), known.join(
        placed, known[conv].eqNullSafe(placed["c"]) & (known[at] == placed["t"]))
    has = F.coalesce(F.col("text").rlike(r"(?m)^[ \t]*>"), F.lit(False))
    joined = joined.withColumn(lines, F.when(has, _lines(F.col("text"))))
    passages = F.when(F.col(lines).isNotNull(), _passages(F.col(lines)))
    back = lambda c: F.when(F.col(c) != -(1 << 63), F.col(c))
    return joined.select(
        *[known[f"`{c}`"] for c in messages.columns], F.when(has, let(F.col(lines), _own)).otherwise(F.col("text")).alias("own_text"),
        F.coalesce(F.size(passages), F.lit(0)).alias("n_quotes"),
        F.coalesce(F.array_max(F.col(lines)["depth"]), F.lit(0)).alias("quote_depth"),
        back("reply").alias("reply_to"), back("root").alias("thread"), "position")


def _roots(links: DataFrame) -> DataFrame:
    """Adds to (c, t, reply) the first turn of the chain; the way to it doubles in every round."""
    jumps = links.withColumn("root", F.col("reply"))
    while True:
        a, b = jumps, jumps.select(F.col("c").alias("bc"), F.col("t").alias("bt"), F.col("root").alias("further"))
        jumped = a.join(b, a["c"].eqNullSafe(b["bc"]) & (a["root"] == b["bt"]), "left").select(
            "c", "t", "reply", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumped = save(jumped, "jumped")
        jumps = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return jumps
