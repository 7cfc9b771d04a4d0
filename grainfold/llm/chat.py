"""Quotation linking: messages that quote others become conversations in reply order.

Lines that begin with ``>`` marks are quotes of that level. Every run of lines of one level is a passage; its
words, normalised and hashed, are looked up among the passages that other messages wrote
themselves, and else those of its paragraphs, or of its lines, among their paragraphs and lines.
The message that wrote it is the one replied to. Conversations are the trees
of these links, each message without its quotes. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.llm.words import words
from grainfold.session import written

MARKS = r"^(?:[ \t]*>)+"
LEAST_WORDS = 3
PARAGRAPHS = r"\n[\x20\x09-\x0D]*\n"
#: Turns of one search range: sources and quotes of a set of hashes are sorted within such ranges.
RANGE = 64


def _lines(text: Column) -> Column:
    """Lines as struct (level, body): the number of quote marks, and what follows them."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r\n|\r|\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[ \t]", "")).alias("level"),
        F.regexp_replace(line, MARKS + " ?", "").alias("body"),
    ))


def _passages(lines: Column) -> Column:
    """Runs of lines of one level: struct (level, body). Blank lines end no run, but stay in its body."""
    def add(done: Column, line: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["level"].alias("level"), F.concat_ws("\n", last["body"], line["body"]).alias("body"))))
        blank = F.trim(line["body"]) == ""
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["level"].alias("level"), F.concat(last["body"], F.lit("\n")).alias("body"))))
        start_new = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["level"] != line["level"])
        return F.when(blank & (F.size(done) == 0), done).when(blank, longer).when(
            start_new, F.concat(done, F.array(line))).otherwise(joined)

    return F.aggregate(lines, F.array().cast("array<struct<level:int,body:string>>"), add)


def _normal(body: Column) -> Column:
    return F.sha2(F.array_join(words(body), " ").cast("binary"), 256)


def _hashes(body: Column, breaks: str) -> Column:
    """Distinct hashes of the parts of a body that have words, in order."""
    parts = F.filter(F.split(body, breaks), lambda part: F.size(words(part)) > 0)
    return F.array_sort(F.array_distinct(F.transform(parts, _normal)))


def own_text(text: Column) -> Column:
    """The text without quoted lines."""
    own = F.filter(_lines(text), lambda line: line["level"] == 0)
    return F.regexp_replace(F.array_join(F.transform(own, lambda line: line["body"]), "\n"), r"^\s+|\s+$", "")


def _parts(rows: DataFrame, level: Column) -> DataFrame:
    """Passages of some levels: conv_id, turn, level, hash, size, and the hashes of their paragraphs and lines."""
    named = rows.where("conv_id is not null and turn is not null")
    each = named.select("conv_id", "turn", F.explode(_passages(_lines(F.col("text")))).alias("p")).where(level)
    body = F.col("p.body")
    return each.select(
        "conv_id", "turn", F.col("p.level").alias("level"), _normal(body).alias("hash"), F.size(words(body)).alias("size"),
        _hashes(body, PARAGRAPHS).alias("paragraphs"), _hashes(body, "\n").alias("lines"),
    ).where("size > 0")


def _holders(sets: DataFrame, sources: DataFrame) -> DataFrame:
    """(conv_id, key, turn) of every message that wrote all parts of a set (conv_id, key, parts).

    Looked up by the part that the fewest messages wrote; the others are only compared there.
    """
    sources = sources.select("conv_id", "turn", "hash")
    each = sets.select("conv_id", "key", F.size("parts").alias("of"), F.explode("parts").alias("hash"))
    counts = sources.groupBy("conv_id", "hash").agg(F.count(F.lit(1)).alias("n"))
    rarest = each.join(counts, ["conv_id", "hash"], "left").groupBy("conv_id", "key", "of").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash")).alias("least"))
    rarest = rarest.where("least.n > 0").select("conv_id", "key", "of", F.col("least.hash").alias("hash"))
    found = rarest.join(sources, ["conv_id", "hash"]).select("conv_id", "key", "of", "turn")
    several = found.where("of > 1").join(each.select("conv_id", "key", "hash"), ["conv_id", "key"])
    whole = several.join(sources, ["conv_id", "turn", "hash"]).groupBy("conv_id", "key", "of", "turn").agg(
        F.count(F.lit(1)).alias("n")).where("n = of")
    columns = ["conv_id", "key", "turn"]
    return found.where("of = 1").select(columns).unionByName(whole.select(columns))


def _before(asked: DataFrame, holders: DataFrame) -> DataFrame:
    """(conv_id, key, at, first, latest): the first and the latest holder of a set before each ``at``.

    Sought within ranges of ``RANGE`` turns, and then over the ranges, so that a set which many messages of a
    long conversation quote is not sorted in one place.
    """
    key = ["conv_id", "key"]
    none = F.lit(None).cast("long")
    events = asked.select(*key, F.col("at").alias("turn"), none.alias("source")).unionByName(
        holders.select(*key, "turn", F.col("turn").alias("source")))
    events = written(events.withColumn("range", F.floor(F.col("turn") / RANGE)), "quotes")
    within = Window.partitionBy(*key, "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = events.groupBy(*key, "range").agg(F.min("source").alias("least"), F.max("source").alias("most"))
    ranges = ranges.select(*key, "range", F.min("least").over(over).alias("first_range"), F.max("most").over(over).alias("last_range"))
    near = events.select(*key, "range", "turn", "source", F.min("source").over(within).alias("first_near"),
                         F.max("source").over(within).alias("last_near")).where("source is null")
    return near.join(ranges, [*key, "range"]).select(
        *key, F.col("turn").alias("at"), F.coalesce("first_range", "first_near").alias("first"),
        F.coalesce("last_near", "last_range").alias("latest"),
    )


def _replies(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages with a known source."""
    quotes = written(_parts(rows, F.col("p.level") > 0).withColumnRenamed("turn", "at").distinct(), "quotes")
    quoting = rows.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi")
    units = F.concat(
        F.array(F.struct("hash", F.lit(True).alias("run"))),
        F.transform(F.array_union("paragraphs", "lines"), lambda h: F.struct(h.alias("hash"), F.lit(False).alias("run"))),
    )
    sources = _parts(quoting, F.col("p.level") == 0).select("conv_id", "turn", F.explode(units).alias("unit"))
    sources = written(sources.groupBy("conv_id", "turn", F.col("unit.hash").alias("hash")).agg(
        F.max("unit.run").alias("run")), "passages")
    # whole passages first
    firsts = sources.where("run").groupBy("conv_id", "hash").agg(F.min("turn").alias("turn"))
    quotes = quotes.join(firsts, ["conv_id", "hash"], "left")
    known = (F.col("size") >= LEAST_WORDS) & (F.col("turn") < F.col("at"))
    quotes = written(quotes.withColumn("turn", F.when(known, F.col("turn"))), "quotes")
    # then those of which one message has all paragraphs, or else all lines
    sets = quotes.where("turn is null").select(
        "conv_id", "at", "level", "size", F.xxhash64("paragraphs", "lines").alias("passage"),
        F.posexplode(F.array("paragraphs", "lines")).alias("kind", "parts"),
    )
    sets = sets.withColumn("key", F.sha2(F.array_join("parts", "").cast("binary"), 256))
    holders = _holders(sets.select("conv_id", "key", "parts").distinct(), sources)
    found = sets.drop("parts").join(
        _before(sets.select("conv_id", "key", "at").distinct(), holders), ["conv_id", "key", "at"])
    # a few words only tell their source if one message wrote them
    found = found.where((F.col("size") >= LEAST_WORDS) | (F.col("first") == F.col("latest"))).where("latest is not null")
    partly = found.groupBy("conv_id", "at", "level", "passage").agg(
        F.min(F.struct("kind", "latest"))["latest"].alias("turn"))
    linked = quotes.where("turn is not null").select("conv_id", "at", "level", "turn").unionByName(
        partly.select("conv_id", "at", "level", "turn"))
    return linked.groupBy("conv_id", F.col("at").alias("turn")).agg(
        F.max(F.struct((-F.col("level")).alias("l"), "turn"))["turn"].alias("reply_to"))


def _paths(links: DataFrame) -> DataFrame:
    """(conv_id, turn, path) of every message with a reply_to: the turns from the first of its thread to its own.

    Each round puts the path of the message above in front, so that known stretches double, until all
    begin with a message that replies to none.
    """
    done = None
    front = links.select("conv_id", "turn", F.col("reply_to").alias("up"), F.array("turn").alias("path"))
    while True:
        known = front if done is None else front.unionByName(done)
        above = known.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"))
        # nothing above: a message that replies to none, the first of the thread
        longer = front.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.col("next").alias("up"), F.concat(F.coalesce("head", F.array("up")), "path").alias("path"))
        longer = written(longer, "paths")
        ended = longer.where("up is null")
        done = ended if done is None else done.unionByName(ended)
        front = longer.where("up is not null")
        if front.isEmpty():
            return done.select("conv_id", "turn", "path")


def conversations(messages: DataFrame) -> DataFrame:
    """Messages in reply order: conv_id, turn, role, reply_to, thread, depth, path, text, n_quotes.

    ``messages`` has conv_id, turn, role and text. reply_to is the turn of the message, of the same
    conversation and before this one, that wrote a passage this one quotes: of the least deep quote with a known
    source, the latest such message. The source of a quote is the first message that wrote it as a whole passage, or else
    the latest that wrote all its paragraphs, or else all its lines. A message that quotes nothing known, but follows another one, begins a
    thread of its own. thread is its first turn, depth the number of replies above, and path the
    turns from there to this one: ordered by conv_id and path, conversations read in reply order.

    A passage of under ``LEAST_WORDS`` words links only if a single message before it wrote it. Null texts are empty; rows without conv_id or
    turn are kept as threads of their own, with no links. Equal rows count once; of several texts for one turn each keeps
    its row, and replies go to the turn. Threads may be of any depth: paths double in each round, which is written, and runs when this is called.
    """
    said = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "text")
    links = written(_replies(said), "replies")
    paths = written(_paths(links), "threads")
    placed = paths.join(links, ["conv_id", "turn"])
    rows = said.distinct().withColumn("passages", _passages(_lines(F.col("text"))))
    result = rows.join(placed, ["conv_id", "turn"], "left")
    n_quotes = F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long")
    return result.select(
        "conv_id", "turn", "role", "reply_to", F.coalesce(F.col("path")[0], "turn").alias("thread"),
        F.coalesce(F.size("path") - 1, F.lit(0)).cast("long").alias("depth"),
        F.coalesce("path", F.array("turn")).alias("path"), own_text(F.col("text")).alias("text"), n_quotes.alias("n_quotes"),
    )
