"""Chat formatting (op2): quotation linking, in column expressions and joins only.

Messages are cut into runs of lines of one quote depth (leading ``>`` signs).  A quoted run is
normalised (A-Z and other letters lower-cased, white space collapsed) and hashed, and so is every
message's own text and each of its paragraphs.  A run of depth 1 finds the message it quotes: the
latest earlier one of the same conversation whose text, or a paragraph of it, has the hash.  If
no run of depth 1 finds one, those of depth 2 are tried, and so on.
What the quoted text itself quotes, if anything, must be what the original quoted, if such an
original is there.  Replies are then followed up to the message that started the thread,
in rounds that double the distance, and conversations come out in reply order without quotes.

Originals and quotes are put in order by hash and turn and each quote takes the last original
before it, with no pairs of them, so the same text said very often costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.store import table, written
from rollcall.llm.text import let



def signs(line: Column) -> Column:
    """A line's quote signs, each with at most one blank after it.

    No repeated group: that recurses once per sign, and a line may hold any number of them.
    """
    run = F.regexp_extract(line, r"^[> \t]*", 0)
    two = F.regexp_instr(run, F.lit(r"[ \t][ \t]"))  # what follows the first of two blanks is text
    return F.when(line.startswith(">"), F.when(two > 0, F.left(run, two)).otherwise(run)).otherwise("")


def runs(text: Column) -> Column:
    """``array<struct<depth, lines>>``: maximal runs of lines of one quote depth, in order."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")


    def parse(x: Column) -> Column:
        return let(signs(x), lambda s: F.struct((F.length(s) - F.length(F.replace(s, F.lit(">"), F.lit("")))).alias("depth"), F.substr(x, F.length(s) + 1).alias("line")))

    parsed = F.transform(lines, parse)

    def grouped(rows: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["depth"] != F.get(rows, i - 1)["depth"]))

        def cut(at: Column) -> Column:
            def one(a: Column, k: Column) -> Column:
                stop = F.coalesce(F.get(at, k + 1), F.size(rows))
                return F.struct(F.get(rows, a)["depth"].alias("depth"), F.transform(F.slice(rows, a + 1, stop - a), lambda r: r["line"]).alias("lines"))

            return F.transform(at, one)

        return let(starts, cut)

    return let(parsed, grouped)


def own_text(parts: Column) -> Column:
    """The message without its quotes."""
    own = F.filter(parts, lambda p: p["depth"] == 0)
    return F.array_join(F.flatten(F.transform(own, lambda p: p["lines"])), "\n")


def normalised(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def key(text: Column) -> Column:
    """Hash of the normalised text; null where nothing is left."""
    return let(normalised(text), lambda n: F.when(n != "", F.xxhash64(n)))


def quoted(parts: Column) -> Column:
    """``array<struct<depth, k, deeper>>``: hashes of the quoted runs, each with that of the run just inside it."""

    def one(p: Column, i: Column) -> Column:
        before, after = F.get(parts, i - 1), F.get(parts, i + 1)
        inner = F.when(before["depth"] == p["depth"] + 1, before).when(after["depth"] == p["depth"] + 1, after)
        return F.struct(p["depth"].alias("depth"), key(F.array_join(p["lines"], "\n")).alias("k"), key(F.array_join(inner["lines"], "\n")).alias("deeper"))

    return F.filter(F.transform(parts, one), lambda q: (q["depth"] > 0) & q["k"].isNotNull())


def messages(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``id, conv, turn, role, content, quotes, k, deeper`` per distinct row."""
    plain = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).distinct()
    plain = plain.withColumn("id", F.xxhash64("conv", "turn", F.coalesce("role", F.lit("\0")), F.coalesce("text", F.lit("\0"))))
    made = plain.withColumn("m", let(runs(F.col("text")), lambda p: F.struct(own_text(p).alias("content"), quoted(p).alias("quotes"))))
    return made.select("id", "conv", "turn", "role", "m.content", "m.quotes", key(F.col("m.content")).alias("k"), F.get(F.filter("m.quotes", lambda q: q["depth"] == 1), F.lit(0))["k"].alias("first"))


def _latest(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: ``(turn, id)`` of the last original of the same ``by`` at an earlier turn.

    Rows are cut into ranges of ``by`` and turn, so a key said very often lies in several, and each
    range takes over the last original of those before: only a range's first key can go on from them.
    """
    cut = rows.repartitionByRange(*by, "turn", "original", "id").withColumn("part", F.spark_partition_id())
    cut = written(cut, "ranges")
    found = F.when(F.col("original"), F.struct("turn", "id"))
    ends = cut.groupBy(*by, "part").agg(F.max(found).alias("end"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.max("end").over(earlier)).where("carried is not null")
    carried = carried.select("part", "carried", *(F.col(c).alias(f"_{c}") for c in by))  # at most one row per range
    # at one turn the asks come first, so what is found lies at an earlier one
    inside = Window.partitionBy(*by, "part").orderBy("turn", "original").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.withColumn(name, F.last(found, ignorenulls=True).over(inside)).alias("o")
    same = F.col("o.part") == F.col("c.part")
    for c in by:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"c._{c}"))
    joined = out.join(F.broadcast(carried.alias("c")), same, "left")
    return joined.select(*(F.col(f"o.{c}") for c in rows.columns), F.coalesce(F.col(f"o.{name}"), F.col("c.carried")).alias(name))


def parents(sent: DataFrame) -> DataFrame:
    """``id, parent``: the latest message that a message quotes, at the least depth of which one is found."""
    paragraphs = F.filter(F.transform(F.split("content", r"\n[ \t]*\n"), key), lambda k: k.isNotNull())
    said = sent.where("conv is not null and turn is not null")
    texts = said.select("conv", "turn", "id", F.col("first").alias("deeper"), F.explode(F.array_union(F.filter(F.array("k"), lambda k: k.isNotNull()), paragraphs)).alias("k"))
    texts = texts.groupBy("conv", "k", "deeper", "turn").agg(F.min("id").alias("id")).withColumns({"original": F.lit(True), "depth": F.lit(0)})
    asks = said.select("conv", "turn", "id", F.explode("quotes").alias("q")).select("conv", "q.k", "q.deeper", "turn", "id", F.lit(False).alias("original"), "q.depth")
    rows = _latest(texts.unionByName(asks.distinct()), ["conv", "k"], "any")
    rows = _latest(rows, ["conv", "k", "deeper"], "exact")
    best = F.coalesce("exact", "any")
    found = rows.where(~F.col("original") & best.isNotNull()).groupBy("id").agg(F.max(F.struct(-F.col("depth"), best.alias("p"))).alias("m"))
    return found.select("id", F.col("m.p.id").alias("parent"))


def threads(sent: DataFrame, links: DataFrame) -> DataFrame:
    """``id, parent, root, steps``: the message that started the thread and how many replies lie between."""
    start = sent.select("id").join(links, "id", "left")
    starts = F.col("parent").isNull()
    now = written(start.select("id", "parent", F.coalesce("parent", "id").alias("root"), F.when(starts, 0).otherwise(1).cast("long").alias("steps"), starts.alias("done")), "threads")
    while now.where("not done").limit(1).count():
        up = now.select(F.col("id").alias("root"), F.col("root").alias("above"), F.col("steps").alias("more"), F.col("done").alias("there"))
        moved = now.where("not done").join(up, "root")  # messages that have arrived aren't joined again
        moved = moved.select("id", "parent", F.col("above").alias("root"), (F.col("steps") + F.col("more")).alias("steps"), F.col("there").alias("done"))
        now = written(now.where("done").unionByName(moved), "threads")
    return now.drop("done")


def link_quotes(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: ``conv_id, turn, role, content, parent_turn, root_turn, reply_depth``.

    Sorted by ``conv_id, root_turn, reply_depth, turn`` every reply follows what it quotes.
    ``content`` has no quoted lines.  A message that quotes nothing, or nothing that was said
    earlier in its conversation, starts a thread.  Of equal originals the latest before the message
    is taken, and of several quoted messages the latest is the parent.  A null conversation or turn links with
    nothing; a null text is empty.  Repeated rows are one message.  No rows give no rows.
    """
    sent = written(messages(rows, conv, turn, role, text), "messages")
    tree = threads(sent, parents(sent))
    turns = sent.select("id", "turn")
    tree = tree.join(turns.select(F.col("id").alias("root"), F.col("turn").alias("root_turn")), "root")
    tree = tree.join(turns.select(F.col("id").alias("parent"), F.col("turn").alias("parent_turn")), "parent", "left")
    out = sent.join(tree, "id")
    return out.select(F.col("conv").alias("conv_id"), "turn", "role", "content", "parent_turn", "root_turn", F.col("steps").alias("reply_depth"))


def mailed(turns: DataFrame) -> DataFrame:
    """Conversations as mail: each message follows a quote of the one before, and that one's own quote.

    Repeated rows are one message.  Of different texts at one turn all are sent, and the one that
    sorts first is quoted.
    """
    sent = turns.select("conv_id", "turn", "role", "text").distinct()
    told = sent.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    before = lambda k, name: told.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(name))
    quote = lambda name, signs: F.regexp_replace(name, r"(?m)^", signs)
    rows = sent.join(before(1, "last"), ["conv_id", "turn"], "left").join(before(2, "older"), ["conv_id", "turn"], "left")
    return rows.select("conv_id", "turn", "role", F.concat_ws("\n", quote("older", ">> "), quote("last", "> "), "text").alias("text"))


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations`` as mail, linked back: the replies must come out in the order of turns."""
    out = link_quotes(mailed(table(spark, sf_dir, "conversations")))
    return out.select("conv_id", "turn", "role", "parent_turn", "root_turn", "reply_depth", F.md5(F.col("content").cast("binary")).alias("content_md5"))
